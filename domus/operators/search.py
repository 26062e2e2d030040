"""Listing search: the predicates the upstream API applied, as DataFrame filters, plus
recency order and paging.

Every predicate is a plain Column expression over the published columns, so Catalyst
pushes the equality / range / box parts into the Parquet scan; only the exact haversine
test stays a post-scan filter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domus.functions import geo
from domus.functions.timefn import bucket_days, ts_literal
from domus.session import checkpoint_root
from domus.sources.tables import range_count


@dataclass(frozen=True)
class SearchRequest:
    """What to search for. ``None`` means "no predicate" for every filter field."""

    country: str | None = None
    operation: str | None = None
    property_types: tuple[str, ...] | None = None
    min_price: float | None = None
    max_price: float | None = None
    center: tuple[float, float] | None = None
    distance_m: float | None = None
    since: str | None = None  # recency bucket token: T, Y, W, M, AllTime
    as_of: dt.datetime | None = None  # "now" for the recency window
    order_by: str = "published_at"
    descending: bool = True
    max_items: int = 50
    num_page: int = 1
    after: tuple[str | None, str] | None = None  # cursor of the last row seen; takes the place of num_page


@dataclass(frozen=True)
class ListingColumns:
    """Column names the search reads; override to search a differently named table."""

    key: str = "propertycode"
    country: str = "country"
    operation: str = "operation"
    property_type: str = "propertytype"
    price: str = "price"
    latitude: str = "latitude"
    longitude: str = "longitude"
    published_at: str = "published_at"


def _ts_literal(df: DataFrame, col: str, value: dt.datetime) -> Column:
    # Wall-clock text cast to the column's own type: the comparison folds to a literal that
    # reaches the scan, and no Python-process time zone leaks into it.
    return ts_literal(value, df.schema[col].dataType.simpleString())


def recency_predicate(df: DataFrame, col: str, since: str | None, as_of: dt.datetime) -> Column | None:
    """``col >= as_of - n days`` for the bucket; None for AllTime / no bucket."""
    days = bucket_days(since)
    if days is None:
        return None
    return F.col(col) >= _ts_literal(df, col, as_of - dt.timedelta(days=days))


def predicates(df: DataFrame, req: SearchRequest, c: ListingColumns = ListingColumns()) -> list[Column]:
    """The filter list for ``req`` (empty list = everything matches).

    A predicate on a column the table does not have is an error, never silently dropped.
    """
    needed = {
        c.country: req.country, c.operation: req.operation, c.property_type: req.property_types,
        c.price: req.min_price if req.min_price is not None else req.max_price,
        c.latitude: req.center, c.longitude: req.center,
        c.published_at: req.since if req.since not in (None, "AllTime") else None,
    }
    missing = sorted(k for k, v in needed.items() if v is not None and k not in df.columns)
    if missing:
        raise ValueError(f"search needs columns the table does not have: {missing}")
    out: list[Column] = []
    if req.country is not None:
        out.append(F.col(c.country) == req.country)
    if req.operation is not None:
        out.append(F.col(c.operation) == req.operation)
    if req.property_types is not None:
        out.append(F.col(c.property_type).isin(list(req.property_types)))
    if req.min_price is not None:
        out.append(F.col(c.price) >= float(req.min_price))
    if req.max_price is not None:
        out.append(F.col(c.price) <= float(req.max_price))  # maximum is inclusive
    if req.center is not None and req.distance_m is not None:
        lat0, lon0 = req.center
        out.append(geo.within_radius(c.latitude, c.longitude, lat0, lon0, req.distance_m))
    if req.since is not None:
        if req.as_of is None:
            raise ValueError("a recency bucket needs as_of")
        p = recency_predicate(df, c.published_at, req.since, req.as_of)
        if p is not None:
            out.append(p)
    return out


def search_filter(df: DataFrame, req: SearchRequest, c: ListingColumns = ListingColumns()) -> DataFrame:
    """Apply every predicate of the request."""
    for p in predicates(df, req, c):
        df = df.filter(p)
    return df


def with_distance(df: DataFrame, center: tuple[float, float], c: ListingColumns = ListingColumns(),
                  name: str = "distance") -> DataFrame:
    """Floored metres from the centre, as text."""
    lat0, lon0 = center
    return df.withColumn(name, geo.distance_text(geo.haversine_m(c.latitude, c.longitude, lat0, lon0)))


def order_and_page(df: DataFrame, order_by: str, key: str, descending: bool = True,
                   max_items: int = 50, num_page: int = 1) -> DataFrame:
    """page ``num_page`` (1-based) of ``max_items`` rows, newest first.

    The key is a unique tie-break so a page is deterministic. ``offset + limit`` after a
    sort plans as a per-partition top-(offset+limit) merged once (TakeOrderedAndProject),
    never a global sort of the whole input. That buffer grows with the page depth; who wants
    many or deep pages calls :func:`paginate`, which numbers the whole result once.
    """
    if max_items < 1 or num_page < 1:
        raise ValueError("max_items and num_page must be >= 1")
    o = F.desc if descending else F.asc
    skip = max_items * (num_page - 1)
    ordered = df.orderBy(o(order_by), o(key))
    return (ordered.offset(skip) if skip else ordered).limit(max_items)


def after_cursor(order_by: str, key: str, cursor: tuple, descending: bool = True) -> Column:
    """Rows behind ``cursor`` (order value, key) in the order of :func:`order_and_page`. Unless the
    cursor stands among rows without an order value, a plain comparison goes first, which
    reaches the scan."""
    value, last = cursor
    behind = (lambda c, x: c < x) if descending else (lambda c, x: c > x)
    o, k = F.col(order_by), behind(F.col(key), F.lit(last))
    if value is None:
        # without a value: last when descending, first when ascending
        return (o.isNull() & k) if descending else (o.isNotNull() | k)
    v = F.lit(value)
    tied = behind(o, v) | ((o == v) & k)
    if descending:
        return ((o <= v) & tied) | o.isNull()
    return (o >= v) & tied


def seek_page(df: DataFrame, order_by: str, key: str, cursor: tuple[str | None, str] | None = None,
              descending: bool = True, max_items: int = 50) -> DataFrame:
    """F2 by cursor: the ``max_items`` rows behind ``cursor`` (see :func:`cursor_of`; None: the first
    page). However deep the page, the plan is one scan with the comparison pushed down and a
    top-``max_items`` per partition. ``key`` must be unique and not NULL."""
    if cursor is not None:
        typed = [x if x is None else F.lit(x).cast(df.schema[c].dataType) for c, x in zip((order_by, key), cursor)]
        df = df.filter(after_cursor(order_by, key, tuple(typed), descending))
    return order_and_page(df, order_by, key, descending, max_items)


def cursor_of(page: DataFrame, order_by: str, key: str, descending: bool = True) -> tuple[str | None, str] | None:
    """The cursor behind a page's last row, (order value, key) as Spark's text of both, so that no
    driver time zone enters; None for an empty page. One row comes to the driver."""
    o = F.asc if descending else F.desc
    last = page.orderBy(o(order_by), o(key)).select(F.col(order_by).cast("string"), F.col(key).cast("string")).first()
    return None if last is None else tuple(last)


_ROW_BITS = 33  # monotonically_increasing_id = (partition index << 33) + row number in partition


def numbered_ranges(df: DataFrame, order_by: str, key: str, descending: bool = True,
                    partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned on (order, key), sorted within each range, with ``_range``
    (the range) and ``_local`` (0-based position in it), frozen by a reliable checkpoint in
    the shared checkpoint folder.

    Freezing matters: a range exchange samples its own bounds, so two plans that each
    range-partition the same rows may cut them differently. Everything downstream reads
    these stored rows, so counts and positions always agree, a lost executor re-reads
    them instead of recomputing them. The range count follows the size of the input
    (:func:`domus.sources.tables.range_count`) unless it is given.
    """
    n = partitions or range_count(df)
    d = F.desc_nulls_last if descending else F.asc_nulls_first
    local = (df.repartitionByRange(n, d(order_by), d(key))
             .sortWithinPartitions(d(order_by), d(key))
             .select("*", F.spark_partition_id().alias("_range"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_local")))
    checkpoint_root(df.sparkSession)
    return local.checkpoint(eager=True)


def paginate(df: DataFrame, order_by: str, key: str, descending: bool = True, max_items: int = 50,
             partitions: int | None = None, with_total: bool = False) -> DataFrame:
    """F1/F2 over the whole result: every row with its ``page_no`` (1-based) and ``pos``
    (0-based place in the page), as paging through all pages of the search would assign.
    ``key`` must be unique and not NULL (it makes the order total).

    No single-partition window over the data. Rows are range-partitioned on (order, key)
    (see :func:`numbered_ranges`); the key makes the sort key unique, so even one timestamp
    holding a third of all rows is split over many ranges. A per-range row count (one row
    per range: bounded by the range count, not by the data) is prefix-summed and broadcast
    back to turn local into global positions. With ``with_total`` the same small table
    also carries ``total``, the size of the whole result (what a page envelope reports), so
    no row is joined against a global aggregate.
    """
    if max_items < 1:
        raise ValueError("max_items must be >= 1")
    local = numbered_ranges(df, order_by, key, descending, partitions)
    sizes = local.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_n").over(every).alias("total"))
    if not with_total:
        offsets = offsets.drop("total")
    rank = F.col("_offset") + F.col("_local")
    return (local.join(F.broadcast(offsets), "_range")
            .withColumn("page_no", (F.floor(rank / F.lit(max_items)) + 1).cast("bigint"))
            .withColumn("pos", (rank % F.lit(max_items)).cast("int"))
            .drop("_range", "_local", "_offset"))


def search(df: DataFrame, req: SearchRequest, c: ListingColumns = ListingColumns()) -> DataFrame:
    """Filter, then return one ordered page, as the paged search endpoint did, or the page behind
    the request's cursor."""
    if req.after is not None:
        return seek_page(search_filter(df, req, c), req.order_by, c.key, req.after, req.descending, req.max_items)
    return order_and_page(search_filter(df, req, c), req.order_by, c.key, req.descending,
                          req.max_items, req.num_page)


def limit_one(df: DataFrame) -> DataFrame:
    """at most one row (connectivity probe); which row is not deterministic."""
    return df.limit(1)
