"""Listing-shaped inputs derived by Spark from the driver tables.

The registered queries run the library's operators on these, so their work grows with the
tables. Every derived value is plain column arithmetic that SQL can restate exactly
(the oracle in :mod:`domus.plans.queries` does). Doubles are built from double literals
only, so both engines do the same IEEE operations in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domus.functions.geo import DEFAULT_CENTER
from domus.functions.names import page_file_name

LAT0, LON0 = DEFAULT_CENTER
# Spread of derived coordinates about the search centre, in degrees per step.
STEP_DEG = 0.0005
ITEMS_PER_PAGE = 50


def _offset(key: Column, modulus: int, half: int) -> Column:
    return ((key % modulus) - half).cast("double") * F.lit(STEP_DEG)


def listing_struct_from_part(part: DataFrame) -> Column:
    """A full listing object per part row (camelCase keys, nested maps, one unknown key)."""
    k, size = F.col("p_partkey"), F.col("p_size")
    return F.struct(
        F.col("p_name").alias("address"),
        (size % 3 + 1).cast("bigint").alias("bathrooms"),
        F.lit("es").alias("country"),
        F.concat_ws(" ", "p_name", "p_brand").alias("description"),
        F.create_map(F.lit("typology"), F.lower("p_type")).alias("detailedType"),
        F.lit("0").alias("distance"),
        F.col("p_brand").alias("district"),
        (k % 2 == 0).alias("exterior"),
        F.col("p_brand").alias("floor"),
        (size % 3 == 0).alias("hasLift"),
        (F.lit(LAT0) + _offset(k, 201, 100)).alias("latitude"),
        (F.lit(LON0) + _offset(k, 199, 99)).alias("longitude"),
        F.col("p_brand").alias("neighborhood"),
        size.cast("bigint").alias("numPhotos"),
        F.lit("rent").alias("operation"),
        F.create_map(
            F.lit("hasParkingSpace"), size % 2 == 0,
            F.lit("isParkingSpaceIncludedInPrice"), size % 4 == 0,
        ).alias("parkingSpace"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") / size.cast("double")).alias("priceByArea"),
        F.create_map(
            F.lit("price"), F.create_map(F.lit("amount"), F.col("p_retailprice"))
        ).alias("priceInfo"),
        k.cast("string").alias("propertyCode"),
        F.lower("p_type").alias("propertyType"),
        (size % 5).cast("bigint").alias("rooms"),
        size.cast("double").alias("size"),
        F.concat(F.lit("listing/"), k.cast("string"), F.lit("/")).alias("url"),
    )


def listing_messages_from_part(part: DataFrame) -> DataFrame:
    """(p_partkey, value BINARY): one JSON listing message per part row, as a broker delivers it."""
    return part.select(
        "p_partkey",
        F.to_json(listing_struct_from_part(part)).cast("binary").alias("value"),
    )


def listings_from_orders(orders: DataFrame) -> DataFrame:
    """Orders viewed as published listings: key, price, operation, type, point, publish time."""
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("o_orderkey"),
        k.cast("string").alias("propertycode"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("operation"),
        F.col("o_orderpriority").alias("propertytype"),
        F.lit("es").alias("country"),
        (F.lit(LAT0) + _offset(k * 7919, 2003, 1001) * F.lit(0.1)).alias("latitude"),
        (F.lit(LON0) + _offset(k * 104729, 1999, 999) * F.lit(0.1)).alias("longitude"),
        F.col("o_orderdate").alias("published_at"),
    )


EVENT_FIELDS = {"event_id": "eventId", "ts": "ts", "user_id": "userId", "event_type": "eventType",
                "value": "value", "props": "props"}


def event_element_json(event: Column) -> Column:
    """One raw listing-like element of an event struct, as JSON text."""
    return F.to_json(F.struct(*[(event[c].cast("string") if c == "ts" else event[c]).alias(name)
                                for c, name in EVENT_FIELDS.items()]))


def envelopes_from_events(events: DataFrame, items_per_page: int = ITEMS_PER_PAGE) -> DataFrame:
    """Landed-page envelopes: (page_date, page_no, file_name, value) with ``value`` the page JSON.

    A page holds the events of one block of ``items_per_page`` consecutive event ids, so a
    page never exceeds that many elements whatever the skew of any other column. Pages are
    dated by their first event and numbered 1..n within the date by block order; that is
    settled on the narrow table of blocks. Columns, not JSON, cross the shuffle, and the
    pages meet their numbers on the block, by which they are already partitioned.
    """
    block = F.expr(f"event_id div {int(items_per_page)}").alias("block")
    dated = (events.select(block, "ts").groupBy("block").agg(F.to_date(F.min("ts")).alias("page_date")))
    bounds = dated.groupBy("page_date").agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"))
    numbered = dated.join(bounds, "page_date").select(
        "block", "page_date", (F.col("block") - F.col("first_block") + 1).alias("page_no"),
        (F.col("last_block") - F.col("first_block") + 1).alias("total_pages"))
    items = F.sort_array(F.collect_list(F.struct(*EVENT_FIELDS))).alias("items")
    pages = events.select(block, *EVENT_FIELDS).groupBy("block").agg(items).join(numbered, "block")
    envelope = F.struct(
        F.transform("items", event_element_json).alias("elementList"),
        F.size("items").cast("bigint").alias("total"),
        F.col("total_pages").alias("totalPages"),
        F.col("page_no").alias("actualPage"),
        F.lit(items_per_page).cast("bigint").alias("itemsPerPage"),
        F.lit(True).alias("paginable"),
    )
    return pages.select("page_date", "page_no", page_file_name("page_date", "page_no").alias("file_name"),
                        F.to_json(envelope).alias("value"))


def _lineitem_listing(property_code: Column) -> Column:
    """One listing object per line item; ``property_code`` is the listing's key."""
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    code = F.concat(ok.cast("string"), F.lit("-"), ln.cast("string"))
    return F.struct(
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("address"),
        (F.col("l_partkey") % 4).cast("bigint").alias("bathrooms"),
        F.lit("es").alias("country"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", code).alias("description"),
        F.create_map(F.lit("typology"), F.col("l_returnflag")).alias("detailedType"),
        (F.col("l_suppkey") % 2 == 0).alias("exterior"),
        F.col("l_returnflag").alias("floor"),
        (F.col("l_discount") > F.lit(0.05)).alias("hasLift"),
        (F.lit(LAT0) + _offset(F.col("l_partkey"), 201, 100)).alias("latitude"),
        (F.lit(LON0) + _offset(F.col("l_suppkey"), 199, 99)).alias("longitude"),
        F.create_map(F.lit("hasParkingSpace"), F.col("l_tax") > F.lit(0.04)).alias("parkingSpace"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("priceByArea"),
        property_code.alias("propertyCode"),
        F.col("l_linestatus").alias("propertyType"),
        ln.cast("bigint").alias("rooms"),
        F.col("l_quantity").alias("size"),
        F.concat(F.lit("listing/"), code, F.lit("/")).alias("url"),
    )


def listing_messages_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """(value BINARY): one listing message per line item; the large-table decode input."""
    code = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return lineitem.select(F.to_json(_lineitem_listing(code)).cast("binary").alias("value"))


# The order in which the versions of one order's listing were sent: by ship date, line number
# and then every other column the listing is built from (rows equal in all of them publish
# identical rows, so any order among them gives the same table).
VERSION_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def versions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Messages in which every line item is a new version of its order's listing, with the
    order columns of a message: the ship date as page date, the line number as page number,
    and the rank among an order's lines of one date and number as position."""
    key = F.col("l_orderkey").cast("string")
    same = Window.partitionBy("l_orderkey", "l_shipdate", "l_linenumber").orderBy(*VERSION_ORDER[2:])
    return lineitem.withColumn("pos", (F.row_number().over(same) - 1).cast("int")).select(
        F.to_date("l_shipdate").alias("page_date"), F.col("l_linenumber").cast("bigint").alias("page_no"), "pos",
        F.to_json(_lineitem_listing(key)).alias("value"))


def pages_of_events(events: DataFrame, per_page: int = ITEMS_PER_PAGE) -> DataFrame:
    """Landed pages (page_date, value) whose elements are listings keyed by user: every event is
    a version of its user's listing. A page is a block of event ids of one date."""
    block = F.expr(f"event_id div {int(per_page)}")
    pages = (events.select(F.to_date("ts").alias("page_date"), block.alias("block"), "event_id", "user_id", "value", "event_type")
             .groupBy("page_date", "block").agg(F.sort_array(F.collect_list(F.struct("event_id", "user_id", "value", "event_type"))).alias("items")))
    envelope = F.struct(F.transform("items", lambda x: F.to_json(F.struct(
        x["user_id"].cast("string").alias("propertyCode"), x["value"].alias("price"), x["event_type"].alias("propertyType"),
        F.lit("es").alias("country"), x["event_id"].cast("string").alias("url")))).alias("elementList"),
        F.size("items").cast("bigint").alias("total"), F.col("block").alias("actualPage"))
    return pages.select("page_date", F.to_json(envelope).alias("value"))
