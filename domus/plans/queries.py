"""Registered queries: each runs library operators over the driver tables (whole tables).

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` is the same result
stated in plain SQL over the raw tables, for the DuckDB cross-check.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.functions import geo, names, timefn
from domus.operators import decode, field_report, incremental, search, upsert
from domus.operators import pages as pages_op
from domus import schemas as S
from domus.plans import derive
from domus.session import shared_dir
from domus.sinks.changelog import ChangeLog
from domus.sinks.named_pages import write_named_pages
from domus.sinks.tables import (advance_marker, append_manifest_bitmaps, append_page_runs, create_table, insert_into, read_marker,
                                write_landing, write_messages, write_snapshot)
from domus.sources.endpoints import MESSAGE_ORDER, admission_bytes, arrived, read_message_files
from domus.sources.pages import read_pages
from domus.sources.tables import read_external, read_state, read_table, spread
from domus.streaming import job, jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def _dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as input of CPU-heavy work: as Spark splits it, or dealt over as many tasks as the
    caller set in ``spark.domus.inputPartitions`` (the test tables are one row group each)."""
    n = spark.conf.get("spark.domus.inputPartitions", None)
    return spread(read_table(spark, sf_dir, name), int(n) if n else None)


def _over_tasks(df: DataFrame) -> DataFrame:
    """Narrow rows whose messages cost far more CPU than their bytes tell, dealt round robin over as many
    tasks as an exchange has, or as Spark's splits if those are more: a table of a few MB is one split."""
    return spread(df, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions()))


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


LAT0, LON0, STEP = derive.LAT0, derive.LON0, derive.STEP_DEG


# ---------------------------------------------------------------------------------------
# Binary message -> text -> from_json(declared 38-field schema) ->
# struct expansion -> 17-column published projection with map lookups and int narrowing.
# ---------------------------------------------------------------------------------------
@register(
    "listing_decode",
    f"""
SELECT p_name AS address,
       CAST(p_size AS DOUBLE) AS size,
       p_retailprice AS price,
       p_retailprice / CAST(p_size AS DOUBLE) AS pricebyarea,
       CAST(p_size % 5 AS INTEGER) AS rooms,
       CAST(p_size % 3 + 1 AS INTEGER) AS bathrooms,
       p_brand AS floor,
       (p_size % 3 = 0) AS haslift,
       lower(p_type) AS propertytype,
       (p_size % 2 = 0) AS parkingspace,
       (p_partkey % 2 = 0) AS exterior,
       {_dbl(LAT0)} + CAST(p_partkey % 201 - 100 AS DOUBLE) * {_dbl(STEP)} AS latitude,
       {_dbl(LON0)} + CAST(p_partkey % 199 - 99 AS DOUBLE) * {_dbl(STEP)} AS longitude,
       p_name || ' ' || p_brand AS description,
       lower(p_type) AS typology,
       'listing/' || CAST(p_partkey AS VARCHAR) || '/' AS url,
       CAST(p_partkey AS VARCHAR) AS propertycode
FROM part
""",
)
def listing_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = derive.listing_messages_from_part(_dealt(spark, sf_dir, "part"))
    return decode.decode_and_publish(messages.select("value"))


@register(
    "decode_lineitem",
    f"""
SELECT l_returnflag || ' ' || l_linestatus AS address,
       l_quantity AS size,
       l_extendedprice AS price,
       l_extendedprice / l_quantity AS pricebyarea,
       l_linenumber AS rooms,
       CAST(l_partkey % 4 AS INTEGER) AS bathrooms,
       l_returnflag AS floor,
       (l_discount > {_dbl(0.05)}) AS haslift,
       l_linestatus AS propertytype,
       (l_tax > {_dbl(0.04)}) AS parkingspace,
       (l_suppkey % 2 = 0) AS exterior,
       {_dbl(LAT0)} + CAST(l_partkey % 201 - 100 AS DOUBLE) * {_dbl(STEP)} AS latitude,
       {_dbl(LON0)} + CAST(l_suppkey % 199 - 99 AS DOUBLE) * {_dbl(STEP)} AS longitude,
       l_returnflag || ' ' || l_linestatus || ' ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS description,
       l_returnflag AS typology,
       'listing/' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '/' AS url,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS propertycode
FROM lineitem
""",
)
def decode_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decode/publish transform over the largest table (one message per line item)."""
    messages = derive.listing_messages_from_lineitem(_dealt(spark, sf_dir, "lineitem"))
    return decode.decode_and_publish(messages)


# ---------------------------------------------------------------------------------------
# Map lookups (present key, missing key) on decoded JSON maps.
# ---------------------------------------------------------------------------------------
@register(
    "props_map_lookup",
    """
SELECT event_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.missing') AS BIGINT) AS missing_key
FROM events
""",
)
def props_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    m_long = F.from_json("props", "map<string,bigint>")
    m_text = F.from_json("props", "map<string,string>")
    return ev.select(
        "event_id",
        m_long.getItem("k").alias("k"),
        m_text.getItem("k").alias("k_text"),
        m_long.getItem("missing").alias("missing_key"),
    )


# ---------------------------------------------------------------------------------------
# H1-H3: last write wins per key; the newest row replaces the older one in full.
# ---------------------------------------------------------------------------------------
@register(
    "upsert_latest",
    """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return upsert.latest_per_key(ev, "user_id", ["ts", "event_id"])


# ---------------------------------------------------------------------------------------
# Skip what the manifest lists (exact anti join; NULL names are kept).
# ---------------------------------------------------------------------------------------
@register(
    "unprocessed_anti",
    """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
)
def unprocessed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    manifest = read_table(spark, sf_dir, "lineitem")
    return incremental.exclude_processed(pages, manifest, on="o_orderkey", manifest_col="l_orderkey")


# ---------------------------------------------------------------------------------------
# Page envelopes -> one row per element with (page, position) provenance.
# Pages are blocks of 50 consecutive event ids, dated by their first event.
# ---------------------------------------------------------------------------------------
_PAGES_SQL = """
WITH blk AS (
  SELECT event_id // 50 AS block, min(ts) AS first_ts FROM events GROUP BY 1),
dated AS (SELECT block, CAST(first_ts AS DATE) AS page_date FROM blk),
bounds AS (SELECT page_date, min(block) AS fb, max(block) AS lb FROM dated GROUP BY 1),
pg AS (
  SELECT d.block, d.page_date, d.block - b.fb + 1 AS page_no, b.lb - b.fb + 1 AS total_pages
  FROM dated d JOIN bounds b USING (page_date))
"""


@register(
    "page_explode",
    _PAGES_SQL
    + """
SELECT pg.page_date, pg.page_no,
       CAST(row_number() OVER (PARTITION BY e.event_id // 50 ORDER BY e.event_id) - 1 AS INTEGER) AS pos,
       e.event_id, e.event_type, e.value
FROM events e JOIN pg ON pg.block = e.event_id // 50
""",
)
def page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = derive.envelopes_from_events(read_table(spark, sf_dir, "events"))
    pages = pages_op.decode_envelope(env.select("page_date", "page_no", "value"))
    rows = pages_op.explode_pages(pages, keep=["page_date", "page_no"])
    el = F.from_json("element", "eventId BIGINT, eventType STRING, value DOUBLE")
    return rows.select(
        "page_date", "page_no", "pos",
        el["eventId"].alias("event_id"), el["eventType"].alias("event_type"), el["value"].alias("value"),
    )


# ---------------------------------------------------------------------------------------
# Page-set completeness per pull date.
# ---------------------------------------------------------------------------------------
@register(
    "envelope_complete",
    _PAGES_SQL
    + """,
items AS (SELECT event_id // 50 AS block, count(*) AS n FROM events GROUP BY 1)
SELECT pg.page_date, count(*) AS pages, count(DISTINCT pg.page_no) AS distinct_pages,
       CAST(sum(items.n) AS BIGINT) AS items, max(pg.total_pages) AS total_pages,
       (count(DISTINCT pg.page_no) = max(pg.total_pages) AND min(pg.page_no) = 1
        AND max(pg.page_no) = max(pg.total_pages)) AS complete
FROM pg JOIN items USING (block)
GROUP BY pg.page_date
""",
)
def envelope_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = derive.envelopes_from_events(read_table(spark, sf_dir, "events"))
    pages = pages_op.decode_envelope(env.select("page_date", "value"))
    return pages_op.page_set_status(pages, "page_date")


# ---------------------------------------------------------------------------------------
# Search (D2-D7, C16, F1-F2) over orders viewed as listings.
# ---------------------------------------------------------------------------------------
def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.listings_from_orders(read_table(spark, sf_dir, "orders"))


_LISTINGS_SQL = f"""
WITH listings AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS propertycode, o_totalprice AS price,
         o_orderstatus AS operation, o_orderpriority AS propertytype, 'es' AS country,
         {_dbl(LAT0)} + CAST((o_orderkey * 7919) % 2003 - 1001 AS DOUBLE) * {_dbl(STEP)} * {_dbl(0.1)} AS latitude,
         {_dbl(LON0)} + CAST((o_orderkey * 104729) % 1999 - 999 AS DOUBLE) * {_dbl(STEP)} * {_dbl(0.1)} AS longitude,
         o_orderdate AS published_at
  FROM orders)
"""


def _haversine_sql(lat: str, lon: str) -> str:
    r = geo.EARTH_RADIUS_M
    return (
        f"(2 * {_dbl(r)} * asin(sqrt(pow(sin((radians({lat}) - radians({_dbl(LAT0)})) / 2), 2)"
        f" + cos(radians({_dbl(LAT0)})) * cos(radians({lat}))"
        f" * pow(sin((radians({lon}) - radians({_dbl(LON0)})) / 2), 2))))"
    )


RADIUS = geo.DEFAULT_RADIUS_M


@register(
    "radius_search",
    _LISTINGS_SQL
    + f"""
SELECT propertycode, CAST(CAST(floor({_haversine_sql('latitude', 'longitude')}) AS BIGINT) AS VARCHAR) AS distance
FROM listings WHERE {_haversine_sql('latitude', 'longitude')} <= {_dbl(RADIUS)}
""",
)
def radius_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = search.SearchRequest(center=(LAT0, LON0), distance_m=RADIUS)
    hits = search.search_filter(_listings(spark, sf_dir), req)
    return search.with_distance(hits, (LAT0, LON0)).select("propertycode", "distance")


PRICE_REQ = search.SearchRequest(
    country="es", operation="O", property_types=("1-URGENT", "2-HIGH"),
    min_price=100000.0, max_price=200000.0,
)


@register(
    "price_range",
    _LISTINGS_SQL
    + """
SELECT propertycode, price, propertytype FROM listings
WHERE country = 'es' AND operation = 'O' AND propertytype IN ('1-URGENT', '2-HIGH')
  AND price BETWEEN 100000.0 AND 200000.0
""",
)
def price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search.search_filter(_listings(spark, sf_dir), PRICE_REQ)
    return hits.select("propertycode", "price", "propertytype")


@register(
    "newest_page",
    _LISTINGS_SQL
    + """
SELECT o_orderkey, published_at, price FROM listings
ORDER BY published_at DESC, o_orderkey DESC LIMIT 50 OFFSET 50
""",
)
def newest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = search.order_and_page(_listings(spark, sf_dir), "published_at", "o_orderkey",
                                 descending=True, max_items=50, num_page=2)
    return page.select("o_orderkey", "published_at", "price")


# F1/F2 + E3 over the whole result: every listing's page (of 50, newest first), as paging
# through all pages of the search until actualPage == totalPages would assign them.
@register(
    "result_pages",
    _LISTINGS_SQL
    + """
SELECT o_orderkey, published_at,
       CAST((row_number() OVER w - 1) // 50 + 1 AS BIGINT) AS page_no,
       CAST((row_number() OVER w - 1) % 50 AS INTEGER) AS pos
FROM listings WHERE country = 'es'
WINDOW w AS (ORDER BY published_at DESC, o_orderkey DESC)
""",
)
def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search.search_filter(_listings(spark, sf_dir), search.SearchRequest(country="es"))
    paged = search.paginate(hits.select("o_orderkey", "published_at"), "published_at", "o_orderkey",
                            descending=True, max_items=50)
    return paged.select("o_orderkey", "published_at", "page_no", "pos")


# The pull step end to end (B5, E1-E4, F1, F2): every page of a search, newest first, 50 per
# page, landed as one envelope per page under the pull's date (one date holds every page),
# read back from the landing folder and exploded with its provenance.
PULL_DATE = dt.date(2024, 5, 21)
SEARCH_LANDING_REQ = search.SearchRequest(country="es", operation="F")


@register(
    "search_landing",
    _LISTINGS_SQL
    + """,
r AS (
  SELECT propertycode, price, row_number() OVER (ORDER BY published_at DESC, o_orderkey DESC) AS rn,
         count(*) OVER () AS n
  FROM listings WHERE country = 'es' AND operation = 'F')
SELECT CAST((rn - 1) // 50 + 1 AS BIGINT) AS page_no, CAST((rn - 1) % 50 AS INTEGER) AS pos,
       propertycode, price, CAST(ceil(n / 50.0) AS BIGINT) AS total_pages
FROM r
""",
)
def search_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = f"{shared_dir(spark, 'search-landing')}/landing"
    hits = search.search_filter(_listings(spark, sf_dir), SEARCH_LANDING_REQ)
    narrow = hits.select("o_orderkey", "published_at", "propertycode", "price")
    paged = search.paginate(narrow, "published_at", "o_orderkey", max_items=50, with_total=True)
    # columns are numbered and stored; their JSON is built after that
    paged = paged.select("page_no", "pos", "total", F.to_json(F.struct(
        F.col("propertycode").alias("propertyCode"), F.col("price").alias("price"))).alias("element"))
    write_landing(pages_op.page_envelopes(paged, F.lit(PULL_DATE), max_items=50), landing)
    landed = read_pages(spark, landing, layout="lines")
    rows = pages_op.explode_pages(landed, keep=["page_no", "envelope"])
    el = F.from_json("element", "propertyCode STRING, price DOUBLE")
    return rows.select("page_no", "pos", el["propertyCode"].alias("propertycode"), el["price"].alias("price"),
                       F.col("envelope.totalPages").alias("total_pages"))


FULL_AS_OF = dt.datetime(1998, 8, 2)
FULL_REQ = search.SearchRequest(
    country="es", operation="F", property_types=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    min_price=50000.0, max_price=400000.0, center=(LAT0, LON0), distance_m=RADIUS,
    since="M", as_of=FULL_AS_OF, max_items=50, num_page=1,
)


@register(
    "full_search",
    _LISTINGS_SQL
    + f"""
SELECT o_orderkey, propertycode, published_at, price,
       CAST(CAST(floor({_haversine_sql('latitude', 'longitude')}) AS BIGINT) AS VARCHAR) AS distance
FROM listings
WHERE country = 'es' AND operation = 'F' AND propertytype IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND price BETWEEN 50000.0 AND 400000.0
  AND {_haversine_sql('latitude', 'longitude')} <= {_dbl(RADIUS)}
  AND published_at >= TIMESTAMP '1998-07-03 00:00:00'
ORDER BY published_at DESC, o_orderkey DESC LIMIT 50
""",
)
def full_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = search.ListingColumns(key="o_orderkey")
    page = search.search(_listings(spark, sf_dir), FULL_REQ, cols)
    page = search.with_distance(page, (LAT0, LON0))
    return page.select("o_orderkey", "propertycode", "published_at", "price", "distance")


# The same search over listings stored as a location-clustered snapshot: the radius box,
# price range, equality, IN and recency predicates reach the Parquet scan.
@register("snapshot_search", ORACLE_SQL["full_search"])
def snapshot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark, 'snapshot-search')}/listings"
    write_snapshot(_listings(spark, sf_dir), path, key="o_orderkey")
    cols = search.ListingColumns(key="o_orderkey")
    page = search.search(spark.read.parquet(path), FULL_REQ, cols)
    page = search.with_distance(page, (LAT0, LON0))
    return page.select("o_orderkey", "propertycode", "published_at", "price", "distance")


# ---------------------------------------------------------------------------------------
# Whole elapsed days and the recency bucket, with a clock in the middle of the
# data (negative and small deltas) and one after it (month and beyond).
# ---------------------------------------------------------------------------------------
AS_OF_MID = dt.datetime(2024, 1, 16, 6, 0, 0)
AS_OF_LATE = dt.datetime(2024, 2, 20, 0, 0, 0)


def _bucket_sql(days: str) -> str:
    return (
        f"CASE WHEN {days} = -1 THEN 'AllTime' WHEN {days} = 0 THEN 'NoPull' "
        f"WHEN {days} = 1 THEN 'T' WHEN {days} <= 2 THEN 'Y' WHEN {days} <= 7 THEN 'W' "
        f"WHEN {days} <= 30 THEN 'M' END"
    )


def _days_sql(as_of: dt.datetime, col: str = "ts") -> str:
    return (f"CAST(floor((epoch_us(TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}') - epoch_us({col}))"
            f" / 86400000000) AS BIGINT)")


@register(
    "since_bucket",
    f"""
SELECT event_id, days, {_bucket_sql('days')} AS bucket, days_late, {_bucket_sql('days_late')} AS bucket_late
FROM (SELECT event_id, {_days_sql(AS_OF_MID)} AS days, {_days_sql(AS_OF_LATE)} AS days_late FROM events)
""",
)
def since_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    ev = incremental.with_since_bucket(ev, "ts", AS_OF_MID, "days", "bucket")
    ev = incremental.with_since_bucket(ev, "ts", AS_OF_LATE, "days_late", "bucket_late")
    return ev.select("event_id", "days", "bucket", "days_late", "bucket_late")


# ---------------------------------------------------------------------------------------
# D8 over many sources: each user's latest event is its last pull; decide per user whether
# a pull is due at a fixed clock, and how far back it should look.
# ---------------------------------------------------------------------------------------
GATE_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@register(
    "pull_gate",
    f"""
SELECT user_id, last_pull, days, bucket,
       (bucket IS NOT NULL AND bucket <> 'NoPull') AS pull
FROM (SELECT user_id, last_pull, days, {_bucket_sql('days')} AS bucket
      FROM (SELECT user_id, max(ts) AS last_pull,
                   CAST(floor((epoch_us(TIMESTAMP '{GATE_AS_OF:%Y-%m-%d %H:%M:%S}') - epoch_us(max(ts)))
                        / 86400000000) AS BIGINT) AS days
            FROM events GROUP BY user_id))
""",
)
def pull_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_pull"))
    gated = incremental.with_since_bucket(last, "last_pull", GATE_AS_OF, "days", "bucket")
    return gated.withColumn("pull", incremental.pull_gate("bucket"))


# ---------------------------------------------------------------------------------------
# Last-pull marker text ('yyyy-MM-dd HH:mm:ss') written and parsed back.
# ---------------------------------------------------------------------------------------
@register(
    "marker_text",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS marker,
       CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS pulled_at
FROM events
""",
)
def marker_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", timefn.format_marker("ts").alias("marker"))
    return ev.withColumn("pulled_at", timefn.parse_marker("marker").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------------------
# Recency window from a bucket (W = 7 days before as_of).
# ---------------------------------------------------------------------------------------
RECENCY_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@register(
    "recency_window",
    """
SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'
""",
)
def recency_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    req = search.SearchRequest(since="W", as_of=RECENCY_AS_OF)
    return search.search_filter(ev, req, search.ListingColumns(published_at="ts"))


# ---------------------------------------------------------------------------------------
# the sink probe's limit(1).
# ---------------------------------------------------------------------------------------
@register("limit_one", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1)")
def limit_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = search.limit_one(read_table(spark, sf_dir, "orders"))
    return one.agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------
# The last-pull marker over two commits. The first commit holds the
# events before the 16th, the second all of them; after each, the marker is read back as
# text and the next pull is decided at a fixed clock.
# ---------------------------------------------------------------------------------------
MARKER_SPLIT = dt.datetime(2024, 1, 16, 0, 0, 0)
MARKER_AS_OF = dt.datetime(2024, 2, 3, 12, 0, 0)


@register(
    "marker_cycle",
    f"""
WITH m AS (
  SELECT 'first' AS stage, max(ts) AS t FROM events WHERE ts < TIMESTAMP '{MARKER_SPLIT:%Y-%m-%d %H:%M:%S}'
  UNION ALL SELECT 'final' AS stage, max(ts) AS t FROM events),
p AS (
  SELECT stage, strftime(t, '%Y-%m-%d %H:%M:%S') AS marker,
         CAST(strptime(strftime(t, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS pulled_at
  FROM m),
d AS (SELECT *, {_days_sql(MARKER_AS_OF, 'pulled_at')} AS days FROM p),
b AS (SELECT *, {_bucket_sql('days')} AS bucket FROM d)
SELECT stage, marker, pulled_at, days, bucket, (bucket IS NOT NULL AND bucket <> 'NoPull') AS pull FROM b
""",
)
def marker_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("ts")
    path = f"{shared_dir(spark, 'marker-cycle')}/marker"
    stages = []
    for stage, committed in (("first", ev.filter(F.col("ts") < timefn.ts_literal(MARKER_SPLIT))), ("final", ev)):
        advance_marker(committed, path, "ts")
        # persisted state, re-read after each commit: later stages never change it
        stages.append(read_marker(spark, path).select(F.lit(stage).alias("stage"), "pulled_at").checkpoint())
    m = stages[0].unionByName(stages[1])
    m = m.select("stage", timefn.format_marker("pulled_at").alias("marker"))
    m = m.withColumn("pulled_at", timefn.parse_marker("marker").cast("timestamp_ntz"))
    m = incremental.with_since_bucket(m, "pulled_at", MARKER_AS_OF, "days", "bucket")
    return m.withColumn("pull", incremental.pull_gate("bucket"))


# ---------------------------------------------------------------------------------------
# Has anything arrived after a point in time? One cut-off inside the data, one after.
# ---------------------------------------------------------------------------------------
ARRIVAL_CUTOFFS = (dt.datetime(2024, 1, 15, 0, 0, 0), dt.datetime(2024, 2, 1, 0, 0, 0))


@register(
    "data_arrived",
    " UNION ALL ".join(
        f"SELECT TIMESTAMP '{c:%Y-%m-%d %H:%M:%S}' AS since, "
        f"EXISTS (SELECT 1 FROM events WHERE ts > TIMESTAMP '{c:%Y-%m-%d %H:%M:%S}') AS arrived"
        for c in ARRIVAL_CUTOFFS
    ),
)
def data_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("ts")
    checks = [arrived(ev, F.col("ts") > timefn.ts_literal(c)).select(timefn.ts_literal(c).alias("since"), "arrived")
              for c in ARRIVAL_CUTOFFS]
    return checks[0].unionByName(checks[1])


# ---------------------------------------------------------------------------------------
# Create the keyed sink table (idempotent DDL), append the decoded listings
# into it through the catalog, and read it back by format + options.
# ---------------------------------------------------------------------------------------
@register("table_ddl_append", ORACLE_SQL["listing_decode"])
def table_ddl_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = f"{shared_dir(spark, 'published-table')}/published"
    name = f"published_{uuid.uuid4().hex[:12]}"
    create_table(spark, name, location)
    create_table(spark, name, location)  # IF NOT EXISTS: a rerun of the job is harmless
    published = listing_decode(spark, sf_dir)
    insert_into(published.filter(F.col(S.PUBLISHED_KEY).isNotNull()), name)
    return read_external(spark, "parquet", path=location)


# ---------------------------------------------------------------------------------------
# Landed file names built from (date, page) and parsed back.
# ---------------------------------------------------------------------------------------
@register(
    "file_name_parse",
    """
SELECT o_orderkey,
       'response' || strftime(o_orderdate, '%Y_%m_%d') || '_p_' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || '.json' AS file_name,
       CAST(o_orderdate AS DATE) AS page_date,
       CAST(o_orderkey % 9 + 1 AS BIGINT) AS page_no
FROM orders
""",
)
def file_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    named = o.select("o_orderkey", names.page_file_name("o_orderdate", F.col("o_orderkey") % 9 + 1).alias("file_name"))
    page_date, page_no = names.parse_page_file_name("file_name")
    return named.select("o_orderkey", "file_name", page_date.alias("page_date"), page_no.alias("page_no"))


# ---------------------------------------------------------------------------------------
# G8 + section 1.4: malformed messages. Every 10th key's message is cut in half (not JSON),
# every 11th has its price sent as a string. Each message still yields one row: the cut
# ones lose their key and are quarantined; the string price becomes NULL, the rest stays,
# and decode flags the row.
# ---------------------------------------------------------------------------------------
@register(
    "quarantine_split",
    """
SELECT CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS propertycode,
       CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_name END AS address,
       CASE WHEN p_partkey % 10 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS price,
       (p_partkey % 10 = 0) AS quarantined,
       (p_partkey % 10 = 0 OR p_partkey % 11 = 0) AS flagged
FROM part
""",
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = derive.listing_messages_from_part(_dealt(spark, sf_dir, "part"))
    text = F.col("value").cast("string")
    k = F.col("p_partkey")
    bad = (
        F.when(k % 10 == 0, F.substring(text, 1, (F.length(text) / 2).cast("int")))
        .when(k % 11 == 0, F.regexp_replace(text, r'"price":([-0-9.Ee+]+)', '"price":"$1"'))
        .otherwise(text)
    )
    published = decode.decode_and_publish(msgs.select(bad.alias("value")), keep_corrupt=True)
    flagged = decode.quarantine_flags(published)
    return flagged.select("propertycode", "address", "price", "quarantined", "flagged")


# ---------------------------------------------------------------------------------------
# Streaming (A1/A4, G1-G4, G9, B2/B3, H1-H3). Each query runs a Structured Streaming job to
# completion (availableNow) into a change log under the shared checkpoint folder, then
# returns the keyed table read back from the log.
# ---------------------------------------------------------------------------------------
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# Seconds without progress before the watchdog stops a processing-time query.
WATCHDOG_TIMEOUT_S = 1.5


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, admitted by bytes (about one split per core per
    micro-batch), so a folder of many files is read in a few large batches, not one file
    per batch."""
    schema = read_table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", "events.parquet")
            .option("maxBytesPerTrigger", str(admission_bytes(spark)))
            .parquet(sf_dir))


@register("stream_events", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "stream-events")
    log = ChangeLog(f"{work}/log", key="event_id", order=["ts"])
    job.run_stream(spark, _event_stream(spark, sf_dir), log.write_batch, f"{work}/checkpoint")
    return log.latest(spark).select(*EVENT_COLS)


@register("stream_upsert", ORACLE_SQL["upsert_latest"])
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "stream-upsert")
    log = ChangeLog(f"{work}/log", key="user_id", order=["ts", "event_id"])
    job.run_stream(spark, _event_stream(spark, sf_dir), log.write_batch, f"{work}/checkpoint")
    return log.latest(spark).select("user_id", "event_id", "ts", "event_type", "value", "props")


@register("compacted_upsert", ORACLE_SQL["upsert_latest"])
def compacted_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 beside compaction: events reach the keyed table in four batches. One compaction runs after
    the first, and another one that began before the third was committed ends after it; the table
    is then read from the bucketed base and the batches that no compaction covers."""
    events, log = read_table(spark, sf_dir, "events"), ChangeLog(f"{shared_dir(spark, 'compacted')}/table", "user_id", ["ts", "event_id"])
    for batch in range(4):
        began = log.snapshot(spark) if batch == 2 else None
        log.write_batch(events.filter(F.col("event_id") % 4 == batch), batch, "one")
        if batch in (0, 2):
            log.compact_in_place(spark, began)
    return log.latest(spark).select("user_id", "event_id", "ts", "event_type", "value", "props")


@register("stream_listings", ORACLE_SQL["listing_decode"])
def stream_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upstream job end to end: listing messages land as files (B1), a file stream
    reads them four files per trigger-group (G9), decode + publish (C1-C11), quarantine
    split (G8), per-batch dedupe and change-log upsert (H1-H3), latest view (B3)."""
    work = shared_dir(spark, "stream-listings")
    msgs = derive.listing_messages_from_part(read_table(spark, sf_dir, "part"))
    write_messages(msgs.select("value"), path=f"{work}/messages")
    jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/checkpoint", f"{work}/quarantine"),
                     files=f"{work}/messages")
    return jobs.published_table(spark, f"{work}/table")


@register("stream_watchdog", ORACLE_SQL["upsert_latest"])
def stream_watchdog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 processing-time trigger with G5-G7: the query runs until the listener has seen no
    progress for the inactivity timeout, the watchdog stops it by id, the listener is
    removed; then the keyed table is read back."""
    work = shared_dir(spark, "stream-watchdog")
    log = ChangeLog(f"{work}/log", key="user_id", order=["ts", "event_id"])
    named = _event_stream(spark, sf_dir).withColumn("src_file", F.col("_metadata.file_path"))
    run = job.run_stream(spark, named, log.write_batch, f"{work}/checkpoint",
                         available_now=False, processing_time="500 milliseconds",
                         inactivity_timeout=WATCHDOG_TIMEOUT_S, poll_interval=0.25)
    if not run.stopped_for_inactivity:
        raise RuntimeError("stream_watchdog: the query ended without the inactivity stop")
    files = read_table(spark, sf_dir, "events").select(F.col("_metadata.file_path").alias("src_file")).distinct()
    if not files.join(log.read_log(spark).select("src_file"), "src_file", "left_anti").isEmpty():
        raise RuntimeError("stream_watchdog: stopped before every source file was read")
    return log.latest(spark).select("user_id", "event_id", "ts", "event_type", "value", "props")


@register(
    "stream_versions",
    f"""
SELECT l_returnflag || ' ' || l_linestatus AS address,
       l_quantity AS size,
       l_extendedprice AS price,
       l_extendedprice / l_quantity AS pricebyarea,
       l_linenumber AS rooms,
       CAST(l_partkey % 4 AS INTEGER) AS bathrooms,
       l_returnflag AS floor,
       (l_discount > {_dbl(0.05)}) AS haslift,
       l_linestatus AS propertytype,
       (l_tax > {_dbl(0.04)}) AS parkingspace,
       (l_suppkey % 2 = 0) AS exterior,
       {_dbl(LAT0)} + CAST(l_partkey % 201 - 100 AS DOUBLE) * {_dbl(STEP)} AS latitude,
       {_dbl(LON0)} + CAST(l_suppkey % 199 - 99 AS DOUBLE) * {_dbl(STEP)} AS longitude,
       l_returnflag || ' ' || l_linestatus || ' ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS description,
       l_returnflag AS typology,
       'listing/' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '/' AS url,
       CAST(l_orderkey AS VARCHAR) AS propertycode
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
        l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem)
WHERE rn = 1
""",
)
def stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upstream job on a keyed stream with many versions per key (A4, B1, B3, G1-G4, G9,
    H1-H3): every line item is a new version of its order's listing, landed by four pulls with
    its real order columns. The files are admitted a quarter at a time, so versions of a key
    arrive over several micro-batches and out of order; the newest by the order columns stays."""
    work = shared_dir(spark, "stream-versions")
    lines = read_table(spark, sf_dir, "lineitem")
    for pull in range(4):  # versions are ranked within a ship date, so a pull ranks and builds those of its own dates only
        write_messages(derive.versions_from_lineitem(lines.filter(F.dayofmonth("l_shipdate") % 4 == pull)), path=f"{work}/messages")
    files = len(spark.read.parquet(f"{work}/messages").inputFiles())
    run = jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/checkpoint", f"{work}/quarantine"),
                           files=f"{work}/messages", max_files_per_trigger=max(1, files // 4))
    if run.batches < 3:
        raise RuntimeError(f"stream_versions: {run.batches} micro-batches do not test the order of versions")
    return jobs.published_table(spark, f"{work}/table")


# ---------------------------------------------------------------------------------------
# Pages to messages to the keyed table (A4, B1, E1, G9, H1-H3): events as pages of listings
# keyed by user, many versions per key over dates, pages and positions, several micro-batches
# in both jobs. The newest by (page date, page number, position) stays.
# ---------------------------------------------------------------------------------------
@register(
    "replay_latest",
    """
SELECT CAST(user_id AS VARCHAR) AS propertycode, value AS price, event_type AS propertytype,
       CAST(event_id AS VARCHAR) AS url, CAST(ts AS DATE) AS page_date
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY CAST(ts AS DATE) DESC, event_id // 50 DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
)
def replay_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "replay-latest")
    write_landing(derive.pages_of_events(read_table(spark, sf_dir, "events")), f"{work}/landing")
    pages = len(spark.read.text(f"{work}/landing").inputFiles())
    jobs.replay_pages_job(spark, f"{work}/landing", f"{work}/manifest", f"{work}/ck-replay", messages=f"{work}/messages",
                          layout="lines", max_files_per_trigger=max(1, pages // 3))
    files = len(spark.read.parquet(f"{work}/messages").inputFiles())
    jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/ck-publish"), files=f"{work}/messages",
                     max_files_per_trigger=max(1, files // 3))
    table = jobs.published_table(spark, f"{work}/table", beside=True)
    return table.select("propertycode", "price", "propertytype", "url", "page_date")


# ---------------------------------------------------------------------------------------
# Messages that cannot be stored keep their raw text. Every 10th is cut in half, every
# 11th is an empty object, every 13th spells its key wrong.
# ---------------------------------------------------------------------------------------
@register(
    "quarantine_values",
    """
WITH m AS (SELECT p_partkey AS k, '{"propertyCode":"' || CAST(p_partkey AS VARCHAR) || '","rooms":' || CAST(p_size AS VARCHAR) || '}' AS v FROM part)
SELECT CASE WHEN k % 10 = 0 THEN substr(v, 1, CAST(floor(length(v) / 2) AS INTEGER)) WHEN k % 11 = 0 THEN '{}'
            ELSE replace(v, 'propertyCode', 'propertycodes') END AS value, k AS page_no
FROM m WHERE k % 10 = 0 OR k % 11 = 0 OR k % 13 = 0
""",
)
def quarantine_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "quarantine-values")
    k = F.col("page_no")
    whole = F.concat(F.lit('{"propertyCode":"'), k.cast("string"), F.lit('","rooms":'), F.col("p_size").cast("string"), F.lit("}"))
    bad = (F.when(k % 10 == 0, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
           .when(k % 11 == 0, F.lit("{}"))
           .when(k % 13 == 0, F.replace(whole, F.lit("propertyCode"), F.lit("propertycodes"))).otherwise(whole))
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("page_no"), "p_size")
    write_messages(part.select(bad.alias("value"), "page_no"), path=f"{work}/messages")
    jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/checkpoint", f"{work}/quarantine"),
                     files=f"{work}/messages")
    return spark.read.parquet(f"{work}/quarantine").select("value", "page_no")


# ---------------------------------------------------------------------------------------
# D2-D7, F1 over the table that the pipeline produces: orders published as listings, then the
# full request through the search job; the page date is the recency key.
# ---------------------------------------------------------------------------------------
@register(
    "table_search",
    _LISTINGS_SQL
    + f"""
SELECT propertycode, price, CAST(published_at AS DATE) AS page_date,
       CAST(CAST(floor({_haversine_sql('latitude', 'longitude')}) AS BIGINT) AS VARCHAR) AS distance
FROM listings
WHERE country = 'es' AND operation = 'F' AND propertytype IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND price BETWEEN 50000.0 AND 400000.0
  AND {_haversine_sql('latitude', 'longitude')} <= {_dbl(RADIUS)}
  AND CAST(published_at AS DATE) >= DATE '1998-07-03'
ORDER BY page_date DESC, propertycode DESC LIMIT 50
""",
)
def table_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "table-search")
    element = F.to_json(F.struct(F.col("propertycode").alias("propertyCode"), "price", F.col("propertytype").alias("propertyType"),
                                 "country", "operation", "latitude", "longitude"))
    write_messages(_listings(spark, sf_dir).select(element.alias("value"), F.to_date("published_at").alias("page_date")),
                   path=f"{work}/messages")
    jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/checkpoint"), files=f"{work}/messages")
    page = jobs.search_job(spark, f"{work}/table", FULL_REQ)
    return page.select("propertycode", "price", "page_date", "distance")


@register("page_ingest", "SELECT event_id, event_type, value FROM events")
def page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages end to end: land envelopes (B5), incremental page stream (A4) with
    manifest exclusion (D1), explode (E1), message sink (B1), manifest append (B6)."""
    work = shared_dir(spark, "page-ingest")
    write_landing(derive.envelopes_from_events(_dealt(spark, sf_dir, "events")), f"{work}/landing")
    jobs.replay_pages_job(spark, f"{work}/landing", f"{work}/manifest", f"{work}/checkpoint",
                          messages=f"{work}/messages", layout="lines")
    msgs = read_message_files(spark, f"{work}/messages", streaming=False)
    el = F.from_json("value", "eventId BIGINT, eventType STRING, value DOUBLE")
    return msgs.select(el["eventId"].alias("event_id"), el["eventType"].alias("event_type"),
                       el["value"].alias("value"))


# ---------------------------------------------------------------------------------------
# A second run over a half-filled manifest. The first run replays the pages up to the
# middle date; the second sees all pages from the start and takes only the rest. Every page
# is logged once and its elements sent once.
# ---------------------------------------------------------------------------------------
MANIFEST_SPLIT = "2024-01-16"


@register(
    "manifest_resume",
    f"""
WITH b AS (SELECT event_id // 50 AS block, CAST(min(ts) AS DATE) AS page_date, count(*) AS n FROM events GROUP BY 1),
p AS (SELECT page_date, block - min(block) OVER (PARTITION BY page_date) + 1 AS page_no, n FROM b)
SELECT page_date, page_no, CAST(n AS BIGINT) AS messages, CAST(1 AS BIGINT) AS logged,
       CASE WHEN page_date < DATE '{MANIFEST_SPLIT}' THEN 1 ELSE 2 END AS run FROM p
""",
)
def manifest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "manifest-resume")
    derive.envelopes_from_events(_dealt(spark, sf_dir, "events")).write.parquet(f"{work}/envelopes")
    pages = spark.read.parquet(f"{work}/envelopes")
    early = F.col("page_date") < F.lit(MANIFEST_SPLIT).cast("date")
    for n, landed in ((1, pages.filter(early)), (2, pages)):
        write_landing(landed, f"{work}/landing{n}")
        jobs.replay_pages_job(spark, f"{work}/landing{n}", f"{work}/manifest", f"{work}/checkpoint{n}",
                              messages=f"{work}/messages{n}", layout="lines")
    sent = [read_message_files(spark, f"{work}/messages{n}", streaming=False).withColumn("run", F.lit(n)) for n in (1, 2)]
    counts = sent[0].union(sent[1]).groupBy("page_date", "page_no").agg(F.count("*").alias("messages"), F.max("run").alias("run"))
    named = counts.withColumn("file_name", names.page_file_name("page_date", "page_no"))
    log = read_state(spark, f"{work}/manifest", S.MANIFEST_DDL).groupBy("file_name").agg(F.count("*").alias("logged"))
    return named.join(log, "file_name").select("page_date", "page_no", "messages", "logged", "run")


# ---------------------------------------------------------------------------------------
# Every page landed as an object of its own name and read back by name.
# ---------------------------------------------------------------------------------------
@register("named_landing", ORACLE_SQL["page_explode"])
def named_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = f"{shared_dir(spark, 'named-landing')}/pulldata"
    write_named_pages(derive.envelopes_from_events(_dealt(spark, sf_dir, "events")), landing)
    rows = pages_op.explode_pages(read_pages(spark, landing, layout="named"), keep=["page_date", "page_no"])
    el = F.from_json("element", "eventId BIGINT, eventType STRING, value DOUBLE")
    return rows.select("page_date", "page_no", "pos", el["eventId"].alias("event_id"), el["eventType"].alias("event_type"),
                       el["value"].alias("value"))


# ---------------------------------------------------------------------------------------
# D6, C16 beside the antimeridian, over a stored snapshot clustered by Z-order.
# ---------------------------------------------------------------------------------------
EAST = 179.99
_WRAPPED = f"({_dbl(EAST)} + CAST((o_orderkey * 104729) % 1999 - 999 AS DOUBLE) * {_dbl(STEP)} * {_dbl(0.1)})"


@register(
    "antimeridian_search",
    _LISTINGS_SQL
    + f"""
, w AS (SELECT propertycode, latitude, CASE WHEN {_WRAPPED} > {_dbl(180.0)} THEN {_WRAPPED} - {_dbl(360.0)} ELSE {_WRAPPED} END AS longitude
      FROM listings)
SELECT propertycode, CAST(CAST(floor({_haversine_sql('latitude', 'longitude').replace(repr(LON0), repr(EAST))}) AS BIGINT) AS VARCHAR) AS distance
FROM w WHERE {_haversine_sql('latitude', 'longitude').replace(repr(LON0), repr(EAST))} <= {_dbl(RADIUS)}
""",
)
def antimeridian_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark, 'antimeridian')}/listings"
    east = F.lit(EAST) + ((F.col("o_orderkey") * 104729) % 1999 - 999).cast("double") * F.lit(STEP) * F.lit(0.1)
    rows = _listings(spark, sf_dir).withColumn("longitude", F.when(east > 180.0, east - F.lit(360.0)).otherwise(east))
    write_snapshot(rows.select("propertycode", "latitude", "longitude"), path)
    center = (LAT0, EAST)
    hits = search.search_filter(spark.read.parquet(path), search.SearchRequest(center=center, distance_m=RADIUS))
    return search.with_distance(hits, center).select("propertycode", "distance")


# ---------------------------------------------------------------------------------------
# F2 by cursor: four pages, each found from the last row of the one before.
# ---------------------------------------------------------------------------------------
SEEK_PAGES = 4


@register(
    "seek_pages",
    _LISTINGS_SQL
    + f"""
SELECT o_orderkey, published_at, page_no FROM (
  SELECT o_orderkey, published_at,
         CAST((row_number() OVER (ORDER BY published_at DESC, o_orderkey DESC) - 1) // 50 + 1 AS INTEGER) AS page_no
  FROM listings WHERE operation = 'F')
WHERE page_no <= {SEEK_PAGES}
""",
)
def seek_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search.search_filter(_listings(spark, sf_dir), search.SearchRequest(operation="F")).select("o_orderkey", "published_at")
    out, cursor = None, None
    for n in range(1, SEEK_PAGES + 1):
        page = search.seek_page(hits, "published_at", "o_orderkey", cursor)
        cursor = search.cursor_of(page, "published_at", "o_orderkey")
        numbered = page.withColumn("page_no", F.lit(n))
        out = numbered if out is None else out.unionByName(numbered)
        if cursor is None:
            break
    return out


# ---------------------------------------------------------------------------------------
# Which pages lack. Pages arrive in two batches with planted gaps; the state holds runs.
# ---------------------------------------------------------------------------------------
@register(
    "missing_pages",
    _PAGES_SQL
    + """,
gone AS (SELECT page_date, page_no FROM pg WHERE page_no % 5 = 3 OR page_no % 11 IN (4, 5)),
runs AS (SELECT page_date, page_no, page_no - row_number() OVER (PARTITION BY page_date ORDER BY page_no) AS island FROM gone)
SELECT page_date, min(page_no) AS first_missing, max(page_no) AS last_missing FROM runs
WHERE page_date IN (SELECT page_date FROM pg WHERE NOT (page_no % 5 = 3 OR page_no % 11 IN (4, 5)))
GROUP BY page_date, island
""",
)
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = f"{shared_dir(spark, 'page-runs')}/runs"
    envelopes = derive.envelopes_from_events(read_table(spark, sf_dir, "events"))
    no = F.col("page_no")
    landed = pages_op.decode_envelope(envelopes.filter(~((no % 5 == 3) | (no % 11).isin(4, 5))).select("page_date", "page_no", "value"))
    for batch in range(2):
        append_page_runs(pages_op.page_runs(landed.filter(no % 2 == batch)), state)
    return pages_op.missing_pages(read_state(spark, state, S.PAGE_RUNS_DDL))


# ---------------------------------------------------------------------------------------
# D1, B6 with the manifest as bitmaps, logged in three batches, one of them twice. Every 97th
# name does not parse and takes the exact anti join.
# ---------------------------------------------------------------------------------------
@register(
    "manifest_bits",
    """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'stray-' || CAST(event_id AS VARCHAR) ELSE
         'response' || strftime(ts, '%Y_%m_%d') || '_p_' || CAST(event_id + 1 AS VARCHAR) || '.json' END AS file_name
FROM events WHERE user_id % 3 <> 0
""",
)
def manifest_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, no = f"{shared_dir(spark, 'manifest-bits')}/bits", F.col("event_id")
    name = F.when(no % 97 == 0, F.concat(F.lit("stray-"), no.cast("string"))).otherwise(names.page_file_name("ts", no + 1))
    page_date, page_no = names.parse_page_file_name("file_name")
    pages = (read_table(spark, sf_dir, "events").select("event_id", "user_id", name.alias("file_name"))
             .withColumns({"page_date": page_date, "page_no": page_no}))
    done = pages.filter("user_id % 3 = 0")
    for batch in (0, 1, 2, 1):
        append_manifest_bitmaps(incremental.manifest_bitmaps(done.filter(no % 3 == batch)), state)
    bits = read_state(spark, state, S.MANIFEST_BITS_DDL)
    left = incremental.exclude_processed_bits(pages.drop("user_id"), bits, done.filter("page_date IS NULL"))
    return left.select("event_id", "file_name")


# ---------------------------------------------------------------------------------------
# For each of the 38 fields how many messages have it, have it as null, lack it, or have
# it with the wrong type. Every 10th message is cut in half.
# ---------------------------------------------------------------------------------------
_PLANTED = {
    "propertyCode": "'present'",
    "price": "CASE WHEN p_partkey % 11 = 0 THEN 'wrong type' ELSE 'present' END",
    "address": "CASE WHEN p_partkey % 7 = 0 THEN 'null' ELSE 'present' END",
    "rooms": "CASE WHEN p_partkey % 3 = 0 THEN 'absent' WHEN p_partkey % 3 = 1 THEN 'wrong type' ELSE 'present' END",
    "parkingSpace": "CASE WHEN p_partkey % 13 = 0 THEN 'wrong type' ELSE 'present' END",
}


@register(
    "field_report",
    "WITH ok AS (SELECT * FROM part WHERE p_partkey % 10 <> 0), f AS (" + " UNION ALL ".join(
        f"SELECT '{name}' AS field, {_PLANTED.get(name, repr('absent'))} AS status FROM ok"
        for name in (c.split(" ")[0] for c in S.LISTING_DDL.split(", ")))
    + """ UNION ALL SELECT CAST(NULL AS VARCHAR), 'malformed' FROM part WHERE p_partkey % 10 = 0)
SELECT field, status, count(*) AS messages FROM f GROUP BY ALL
""",
)
def field_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    keys = _over_tasks(read_table(spark, sf_dir, "part").select(k))
    text = F.concat(
        F.lit('{"propertyCode":"'), k.cast("string"), F.lit('","price":'), F.when(k % 11 == 0, '"5"').otherwise("5"),
        F.lit(',"address":'), F.when(k % 7 == 0, "null").otherwise('"x"'),
        F.when(k % 3 == 0, "").when(k % 3 == 1, ',"rooms":"2"').otherwise(',"rooms":2'),
        F.lit(',"parkingSpace":{"hasParkingSpace":true'), F.when(k % 13 == 0, ',"price":50.0').otherwise(""), F.lit("}}"))
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    messages = keys.select(F.when(k % 10 == 0, half).otherwise(text).cast("binary").alias("value"))
    return field_report.field_report(messages)


# ---------------------------------------------------------------------------------------
# What every micro-batch decoded, flagged and put aside, counted by the write itself and
# committed with it; here summed over the batches.
# ---------------------------------------------------------------------------------------
@register(
    "batch_metrics",
    """
SELECT CAST(count(*) AS BIGINT) AS decoded, CAST(sum(CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 11 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
       CAST(sum(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS quarantined, max(CAST(o_orderdate AS DATE)) AS newest
FROM orders
""",
)
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "batch-metrics")
    k = F.col("o_orderkey")
    price = F.when(k % 11 == 0, F.lit('"high"')).otherwise(F.col("o_totalprice").cast("string"))
    whole = F.concat(F.lit('{"propertyCode":"'), k.cast("string"), F.lit('","price":'), price, F.lit("}"))
    cut = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    sent = read_table(spark, sf_dir, "orders").select(F.when(k % 10 == 0, cut).otherwise(whole).alias("value"),
                                                      F.to_date("o_orderdate").alias("page_date"))
    for part in range(3):
        write_messages(sent.filter(F.dayofmonth("page_date") % 3 == part), path=f"{work}/messages")
    files = len(spark.read.parquet(f"{work}/messages").inputFiles())
    jobs.publish_job(spark, jobs.PublishPaths(f"{work}/table", f"{work}/checkpoint", f"{work}/quarantine"),
                     files=f"{work}/messages", max_files_per_trigger=max(1, files // 3))
    seen = jobs.batch_metrics(spark, f"{work}/table")
    return seen.agg(*[F.sum(c).alias(c) for c in ("decoded", "flagged", "quarantined")], F.max("newest").alias("newest"))
