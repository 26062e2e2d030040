"""Z-order clustering, boxes beside the antimeridian and the poles, and paging by cursor."""

import datetime as dt
import glob
import math
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus.functions import geo
from domus.functions.zorder import BITS, z_key
from domus.operators import search
from domus.sinks.tables import write_snapshot

R = geo.EARTH_RADIUS_M


def metres(lat, lon, lat0, lon0):
    a = math.sin(math.radians(lat - lat0) / 2) ** 2 + math.cos(math.radians(lat0)) * math.cos(math.radians(lat)) * \
        math.sin(math.radians(lon - lon0) / 2) ** 2
    return 2 * R * math.asin(min(1.0, math.sqrt(a)))


def test_key_interleaves_the_bits(spark):
    rng = random.Random(4)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [
        (90.0, 180.0), (-90.0, -180.0), (91.0, -190.0), (None, 1.0), (1.0, float("nan"))]
    got = spark.createDataFrame(rows, "lat double, lon double").select("lat", "lon", z_key("lat", "lon").alias("z")).collect()
    for lat, lon, z in got:
        if lat is None or math.isnan(lon):
            assert z is None
            continue
        cells = [math.floor(min(max((x - lo) / w, 0.0), 1.0) * float((1 << BITS) - 1)) for x, lo, w in ((lat, -90.0, 180.0), (lon, -180.0, 360.0))]
        assert z == sum(((cells[0] >> b & 1) << 2 * b + 1) | ((cells[1] >> b & 1) << 2 * b) for b in range(BITS))


def _met(path, boxes):
    """(row groups whose statistics meet a box, all row groups)"""
    met = total = 0
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            lat, lon = (meta.row_group(g).column(at[c]).statistics for c in ("latitude", "longitude"))
            total += 1
            met += any(lat.min <= b[1] and lat.max >= b[0] and lon.min <= b[3] and lon.max >= b[2] for b in boxes)
    return met, total


def test_a_search_meets_few_row_groups(spark, tmp):
    """Points over a square of 20 degrees in 256 files: (lat, lon) order cuts it into bands, Z-order into tiles."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("propertycode"), (F.lit(30.0) + F.rand(1) * 20).alias("latitude"), (F.rand(2) * 20).alias("longitude"))
    rows = rows.cache()
    write_snapshot(rows, tmp + "/z", partitions=256)
    rows.repartitionByRange(256, "latitude", "longitude").sortWithinPartitions("latitude", "longitude").write.parquet(tmp + "/bands")
    boxes = geo.bounding_boxes(40.3, 9.7, 200_000.0)
    z, bands = _met(tmp + "/z", boxes), _met(tmp + "/bands", boxes)
    assert z[1] >= 250 and bands[1] >= 250
    assert z[0] * 1.8 <= bands[0]  # a box of 3.6 x 4.7 of 20 degrees: 18 % of the bands, 4 x 5 of 16 x 16 tiles and their edges
    req = search.SearchRequest(center=(40.3, 9.7), distance_m=200_000.0)
    near = lambda df: {r[0] for r in search.search_filter(df, req).select("propertycode").collect()}
    assert near(spark.read.parquet(tmp + "/z")) == near(rows) != set()


@settings(max_examples=8, deadline=None)
@given(st.sampled_from([(0.0, 179.99), (38.0, -179.995), (89.95, 10.0), (-89.99, -170.0), (60.0, 180.0), (10.0, -180.0), (0.0, 181.0), (38.4, -0.4)]),
       st.sampled_from([4500.0, 60_000.0, 1_500_000.0, 12_000_000.0]), st.integers(0, 10**6))
def test_boxes_lose_nothing(spark, center, radius, seed):
    rng = random.Random(seed)
    spread = math.degrees(radius / R) * 1.5
    rows = [(i, max(-90.0, min(90.0, center[0] + rng.uniform(-spread, spread))), (center[1] + rng.uniform(-spread, spread) * 3 + 180) % 360 - 180)
            for i in range(200)] + [(i, rng.uniform(-90, 90), rng.uniform(-200, 200)) for i in range(200, 300)]
    df = spark.createDataFrame(rows, "i long, lat double, lon double")
    got = {r.i for r in df.filter(geo.within_radius("lat", "lon", *center, radius)).collect()}
    for i, lat, lon in rows:
        d = metres(lat, lon, *center)
        if abs(d - radius) > 1e-3:
            assert (i in got) == (d <= radius), (i, lat, lon, d)


def test_both_boxes_reach_the_scan(spark, tmp):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.createDataFrame([(1.0, 179.9)], "lat double, lon double").write.parquet(tmp + "/p")
    plan = spark.read.parquet(tmp + "/p").filter(geo.within_radius("lat", "lon", 1.0, 179.99, 4500.0))._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(lat" in pushed and "LessThanOrEqual(lat" in pushed and "Or(" in pushed


ORDERED = [(k, t, k % 3) for k, t in zip(range(230), [None if k % 9 == 0 else dt.datetime(2024, 1, 1 + k % 4, k % 2) for k in range(230)])]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("size", [1, 50, 400])
def test_pages_by_cursor_equal_pages_by_offset(spark, descending, size):
    df = spark.createDataFrame(ORDERED, "k long, t timestamp, x int").filter("k < 40" if size == 1 else "true").cache()
    cursor, n = None, 0
    while True:
        n += 1
        page = search.seek_page(df, "t", "k", cursor, descending, size)
        rows = page.collect()
        assert rows == search.order_and_page(df, "t", "k", descending, size, n).collect()
        cursor = search.cursor_of(page, "t", "k", descending)
        if cursor is None:
            assert rows == []
            break
        if size == 1 and n == 6:
            break


def test_a_deep_page_needs_one_page_of_memory_and_prunes_the_scan(spark, tmp):
    spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") * 7 % 1000).cast("double").alias("price")).write.parquet(tmp + "/t")
    req = search.SearchRequest(order_by="price", max_items=50, after=("300.0", "2900"))
    page = search.search(spark.read.parquet(tmp + "/t"), req, search.ListingColumns(key="k"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=50" in plan and "offset" not in plan
    assert "LessThanOrEqual(price,300.0)" in plan
    assert page.first().price <= 300.0 and page.count() == 50
