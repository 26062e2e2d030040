"""Message decode, struct expansion, the published projection and quarantine.

Decode is ``from_json`` in PERMISSIVE mode with a declared schema: a message always yields
exactly one row, mismatched fields become NULL, unknown keys are dropped, JSON keys are
case-sensitive, and one bad value inside a map nulls the whole map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from domus import schemas as S


def decode_column(value: Column, schema: StructType | str, keep_corrupt: bool = False) -> Column:
    """``from_json`` against the declared schema; optionally also capture the raw bad record."""
    if isinstance(schema, str):
        schema = S.struct(schema)
    if keep_corrupt:
        schema = S.with_corrupt_column(schema)
        return F.from_json(value, schema, {"columnNameOfCorruptRecord": S.CORRUPT_COLUMN})
    return F.from_json(value, schema)


def decode_messages(
    df: DataFrame,
    schema: StructType | str = S.LISTING_DDL,
    value_col: str = "value",
    keep: list[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """value (binary or string) -> one column per schema field (+ ``keep`` pass-through columns).

    Expanding ``data.*`` lets Catalyst collapse the projections into one ``from_json`` and
    prune the struct fields the caller never selects.
    """
    keep = keep or []
    text = F.col(value_col).cast("string")
    decoded = df.select(*keep, decode_column(text, schema, keep_corrupt).alias("data"))
    return decoded.select(*keep, "data.*")


def publish_columns(narrow_ints: bool = True) -> list[Column]:
    """The 17 published columns in sink order, from decoded listing fields.

    Names are given explicitly (``alias``) so the output spelling never depends on
    ``spark.sql.caseSensitive``. rooms/bathrooms narrow to INT with ``try_cast``: a value
    above 2^31-1 becomes NULL instead of failing the batch under ANSI mode.
    """

    def narrow(c: str, out: str) -> Column:
        col = F.col(c)
        return (col.try_cast("int") if narrow_ints else col).alias(out)

    return [
        F.col("address").alias("address"),
        F.col("size").alias("size"),
        F.col("price").alias("price"),
        F.col("priceByArea").alias("pricebyarea"),
        narrow("rooms", "rooms"),
        narrow("bathrooms", "bathrooms"),
        F.col("floor").alias("floor"),
        F.col("hasLift").alias("haslift"),
        F.col("propertyType").alias("propertytype"),
        F.col("parkingSpace").getItem("hasParkingSpace").alias("parkingspace"),
        F.col("exterior").alias("exterior"),
        F.col("latitude").alias("latitude"),
        F.col("longitude").alias("longitude"),
        F.col("description").alias("description"),
        F.col("detailedType").getItem("typology").alias("typology"),
        F.col("url").alias("url"),
        F.col("propertyCode").alias("propertycode"),
    ]


PUBLISH_SOURCE_FIELDS = [
    "address", "size", "price", "priceByArea", "rooms", "bathrooms", "floor", "hasLift",
    "propertyType", "parkingSpace", "exterior", "latitude", "longitude", "description",
    "detailedType", "url", "propertyCode",
]


# The map fields the published projection looks into, and the one key it reads from each.
LOOKED_UP_KEYS = {"parkingSpace": ("hasParkingSpace", BooleanType()), "detailedType": ("typology", StringType())}


def lenient_lookups(schema: StructType) -> StructType:
    """The schema with each looked-up map declared as a struct of only the key that is read.

    A map decodes all-or-nothing: one value of the wrong type under any key nulls the whole
    map, and so the lookup. A struct ignores keys it does not declare, so the lookup
    survives a bad sibling. Opt-in: the default keeps the map semantics.
    """
    fields = []
    for f in schema.fields:
        if f.name in LOOKED_UP_KEYS:
            k, t = LOOKED_UP_KEYS[f.name]
            f = StructField(f.name, StructType([StructField(k, t, True)]), True)
        fields.append(f)
    return StructType(fields)


def decode_and_publish(
    messages: DataFrame,
    value_col: str = "value",
    keep: list[str] | None = None,
    prune_schema: bool = True,
    keep_corrupt: bool = False,
    lenient_maps: bool = False,
    beside: tuple[str, ...] = (),
    flag_published: bool = False,
) -> DataFrame:
    """Message stream/batch -> published rows. The whole upstream transform in one plan.

    With ``prune_schema`` the JSON parser only materialises the 17 fields that are
    published. Results are identical, except which rows ``_corrupt_record`` flags: a bad
    value in an unread field is not seen. The quarantine path therefore keeps the full schema.
    ``lenient_maps`` (off by default) reads ``parkingspace`` / ``typology`` even when another
    key of the same map holds a value of the wrong type (see :func:`lenient_lookups`).
    ``beside`` names listing fields to keep next to the published columns. ``flag_published``
    keeps ``_corrupt_record`` of the pruned schema: bad values in the fields that are kept.
    """
    schema = S.struct(S.LISTING_DDL)
    if prune_schema and not keep_corrupt:
        schema = S.subset(schema, [*PUBLISH_SOURCE_FIELDS, *beside])
    if lenient_maps:
        schema = lenient_lookups(schema)
    decoded = decode_messages(messages, schema, value_col, keep, keep_corrupt or flag_published)
    extra = [S.CORRUPT_COLUMN] if keep_corrupt or flag_published else []
    return decoded.select(*(keep or []), *publish_columns(), *beside, *extra)


def quarantine_flags(published: DataFrame, key: str = S.PUBLISHED_KEY) -> DataFrame:
    """Add ``quarantined`` (row cannot be stored: NULL key) and ``flagged`` (decode saw bad input).

    ``flagged`` is an annotation only: a row with one mismatched field keeps its other
    fields and is still published.
    """
    flagged = (
        F.col(S.CORRUPT_COLUMN).isNotNull()
        if S.CORRUPT_COLUMN in published.columns
        else F.lit(False)
    )
    return published.withColumn("quarantined", F.col(key).isNull()).withColumn(
        "flagged", flagged
    )


def listing_element(beside: tuple[str, ...] = ()) -> Column:
    """Published row -> listing element JSON (the inverse of :func:`publish_columns`).

    Field names and nesting are the decoded listing's (camelCase, ``parkingSpace`` and
    ``detailedType`` as maps), so a page of these elements replays and decodes back to the
    same published row: JSON keys are matched case-sensitively.
    """
    return F.to_json(F.struct(
        F.col("address").alias("address"),
        F.col("size").alias("size"),
        F.col("price").alias("price"),
        F.col("pricebyarea").alias("priceByArea"),
        F.col("rooms").cast("bigint").alias("rooms"),
        F.col("bathrooms").cast("bigint").alias("bathrooms"),
        F.col("floor").alias("floor"),
        F.col("haslift").alias("hasLift"),
        F.col("propertytype").alias("propertyType"),
        F.when(F.col("parkingspace").isNotNull(),
               F.create_map(F.lit("hasParkingSpace"), F.col("parkingspace"))).alias("parkingSpace"),
        F.col("exterior").alias("exterior"),
        F.col("latitude").alias("latitude"),
        F.col("longitude").alias("longitude"),
        F.col("description").alias("description"),
        F.when(F.col("typology").isNotNull(),
               F.create_map(F.lit("typology"), F.col("typology"))).alias("detailedType"),
        F.col("url").alias("url"),
        F.col("propertycode").alias("propertyCode"),
        *beside,
    ))
