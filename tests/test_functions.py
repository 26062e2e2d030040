"""Geo distance, elapsed days, recency buckets and file names."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from domus.functions import geo, names, timefn


# Coordinates and the distances that the search service reported for them.
@pytest.mark.parametrize("lat,lon,expected", [
    (38.382912, -0.4134749, "1594"),
    (38.3651024, -0.4197595, "845"),
    (38.366923, -0.4154927, "961"),
])
def test_distance_matches_payload(spark, lat, lon, expected):
    lat0, lon0 = geo.DEFAULT_CENTER
    df = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    got = df.select(geo.distance_text(geo.haversine_m("latitude", "longitude", lat0, lon0))).first()[0]
    assert got == expected


def _hav_py(lat, lon, lat0, lon0):
    p1, p2 = math.radians(lat0), math.radians(lat)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon - lon0) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(a))


@pytest.mark.parametrize("radius", [4500.0, 60_000.0, 1_500_000.0])
def test_box_never_drops_a_row(spark, radius):
    rnd = random.Random(7)
    lat0, lon0 = geo.DEFAULT_CENTER
    pts = [(lat0 + rnd.uniform(-20, 20), lon0 + rnd.uniform(-25, 25)) for _ in range(3000)]
    pts += [(lat0 + rnd.uniform(-0.1, 0.1), lon0 + rnd.uniform(-0.1, 0.1)) for _ in range(3000)]
    df = spark.createDataFrame(pts, "latitude double, longitude double")
    boxed = df.filter(geo.within_radius("latitude", "longitude", lat0, lon0, radius)).count()
    exact = df.filter(geo.haversine_m("latitude", "longitude", lat0, lon0) <= radius).count()
    brute = sum(1 for a, b in pts if _hav_py(a, b, lat0, lon0) <= radius)
    assert boxed == exact
    assert abs(exact - brute) <= 1  # float ulps at the boundary only


def test_box_absent_near_pole_and_antimeridian():
    assert geo.bounding_box(89.99, 0.0, 5000) is None
    assert geo.bounding_box(0.0, 179.99, 5000) is None
    assert geo.bounding_box(38.0, 0.0, 4500) is not None


def test_box_predicate_reaches_scan(spark, tmp):
    lat0, lon0 = geo.DEFAULT_CENTER
    spark.createDataFrame([(lat0, lon0)], "latitude double, longitude double").write.parquet(tmp + "/p")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df = spark.read.parquet(tmp + "/p").filter(geo.within_radius("latitude", "longitude", lat0, lon0, 4500))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(latitude" in plan


# Elapsed whole days -> bucket (first match wins; <= -2 falls into Y; > 30 has no bucket).
BUCKETS = [(-2, "Y"), (-1, "AllTime"), (0, "NoPull"), (1, "T"), (2, "Y"), (3, "W"), (7, "W"),
           (8, "M"), (30, "M"), (31, None)]


@pytest.mark.parametrize("days,bucket", BUCKETS)
def test_since_bucket(spark, days, bucket):
    got = spark.range(1).select(timefn.since_bucket(F.lit(days))).first()[0]
    assert got == bucket


@pytest.mark.parametrize("then,now,days", [
    ("2024-05-20 23:00:00", "2024-05-21 01:00:00", 0),   # 2 h over midnight
    ("2024-05-21 01:00:00", "2024-05-21 00:00:00", -1),  # clock went back 1 h
    ("2024-05-20 00:00:00", "2024-05-22 00:00:00", 2),
    ("2024-05-20 00:00:00.000001", "2024-05-22 00:00:00", 1),
    ("2024-05-20 12:00:00", "2024-05-18 12:00:00", -2),
])
def test_elapsed_days_floors_24h_periods(spark, then, now, days):
    df = spark.createDataFrame([(then, now)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert df.select(timefn.elapsed_days("b", "a")).first()[0] == days
    py = (dt.datetime.fromisoformat(now) - dt.datetime.fromisoformat(then)).days
    assert py == days


def test_marker_roundtrip(spark):
    df = spark.createDataFrame([("2024-05-28 18:29:05",), ("garbage",)], "t string")
    rows = df.select(timefn.parse_marker("t").alias("ts")).select(timefn.format_marker("ts").alias("t")).collect()
    assert rows[0]["t"] == "2024-05-28 18:29:05" and rows[1]["t"] is None


def test_bucket_days():
    assert [timefn.bucket_days(b) for b in ("T", "Y", "W", "M", "AllTime")] == [1, 2, 7, 30, None]
    with pytest.raises(ValueError):
        timefn.bucket_days("X")


def test_file_name_build_and_parse(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 21), 3)], "d date, n int")
    name = df.select(names.page_file_name("d", "n")).first()[0]
    assert name == "response2024_05_21_p_3.json"
    df2 = spark.createDataFrame([(name,), ("processed_files",), ("response2024_13_40_p_1.json",),
                                 ("response2024_05_21_p_.json",)], "f string")
    d, n = names.parse_page_file_name("f")
    rows = df2.select(d.alias("d"), n.alias("n")).collect()
    assert (rows[0]["d"], rows[0]["n"]) == (dt.date(2024, 5, 21), 3)
    assert all(r["d"] is None for r in rows[1:])
    assert rows[1]["n"] is None and rows[3]["n"] is None


def test_elapsed_days_ignores_session_zone_and_dst(spark):
    # 2024-03-10 is a DST change in New York: 24 wall-clock hours are 23 real hours there.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-09 12:00:00", "2024-03-10 12:00:00")], "a string, b string").select(
            F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        assert df.select(timefn.elapsed_days("b", "a")).first()[0] == 1
        lit_days = df.select(timefn.elapsed_days(dt.datetime(2024, 3, 10, 12), "a")).first()[0]
        assert lit_days == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_elapsed_days_and_bucket_match_python_on_random_pairs(spark):
    # The upstream semantics are Python's: (now - last).days, then the bucket chain. Random
    # pairs around every bucket edge, both directions, microsecond offsets; one Spark job.
    rng = random.Random(11)
    base = dt.datetime(2024, 3, 1)
    pairs = []
    for _ in range(3000):
        then = base + dt.timedelta(seconds=rng.randint(0, 86400 * 60), microseconds=rng.randint(0, 999999))
        edge = rng.choice([-3, -2, -1, 0, 1, 2, 3, 7, 8, 30, 31, 45])
        now = then + dt.timedelta(days=edge, seconds=rng.randint(-3600, 3600), microseconds=rng.randint(-999, 999))
        pairs.append((then, now))
    df = spark.createDataFrame([(t.isoformat(sep=" "), n.isoformat(sep=" ")) for t, n in pairs], "then string, now string")
    days = timefn.elapsed_days(F.col("now").cast("timestamp_ntz"), F.col("then").cast("timestamp_ntz"))
    got = df.select(days.alias("d"), timefn.since_bucket(days).alias("b")).collect()
    want = [((n - t) // dt.timedelta(days=1)) for t, n in pairs]
    assert [r["d"] for r in got] == want
    bounds = [(1, 1, "T"), (3, 7, "W"), (8, 30, "M")]
    for r, d in zip(got, want):
        named = next((b for lo, hi, b in bounds if lo <= d <= hi), None)
        assert r["b"] == ({-1: "AllTime", 0: "NoPull"}.get(d) or named or ("Y" if d <= 2 else None))


def test_haversine_and_distance_text_match_python_on_random_points(spark):
    rng = random.Random(21)
    lat0, lon0 = geo.DEFAULT_CENTER
    pts = [(lat0 + rng.uniform(-s, s), lon0 + rng.uniform(-s, s)) for s in (0.05, 1.0, 30.0) for _ in range(700)]

    def hav(lat, lon):
        p1, p2 = math.radians(lat0), math.radians(lat)
        a = (math.sin((p2 - p1) / 2) ** 2
             + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon) - math.radians(lon0)) / 2) ** 2)
        return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(a))

    df = spark.createDataFrame(pts, "latitude double, longitude double")
    m = geo.haversine_m("latitude", "longitude", lat0, lon0)
    got = df.select(m.alias("m"), geo.distance_text(m).alias("t")).collect()
    for (lat, lon), r in zip(pts, got):
        want = hav(lat, lon)
        assert abs(r["m"] - want) <= 1e-6 * max(1.0, want)
        if abs(want - round(want)) > 1e-6:  # away from a whole metre, the floored text is exact
            assert r["t"] == str(math.floor(want))
