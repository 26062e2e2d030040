"""Which listing fields arrive, field by field: present, null, absent or of the wrong type.

``from_json`` gives NULL for all three last cases. Beside it the message is parsed to a variant,
which still tells them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus import schemas as S

PRESENT, NULL, ABSENT, WRONG = "present", "null", "absent", "wrong type"
MALFORMED, OBJECT = "malformed", "object"  # the whole message, under no field


def field_states(message: Column, decoded: Column, ddl: str = S.LISTING_DDL) -> Column:
    """array<struct<field, status>>: one entry per declared field that the message has, and one without a
    field that says whether it is a JSON object (``message``, its fields as variants, is not null)."""
    names = S.struct(ddl).fieldNames()
    fits = F.array(*[F.when(decoded[n].isNotNull(), n) for n in names])
    declared = F.filter(F.map_entries(message), lambda e: F.array_contains(F.array(*map(F.lit, names)), e["key"]))
    states = F.transform(declared, lambda e: F.struct(e["key"].alias("field"), F.when(F.is_variant_null(e["value"]), NULL)
                                                      .when(F.coalesce(F.array_contains(fits, e["key"]), F.lit(False)), PRESENT).otherwise(WRONG).alias("status")))
    whole = F.struct(F.lit(None).cast("string").alias("field"), F.when(message.isNull(), MALFORMED).otherwise(OBJECT).alias("status"))
    return F.concat(F.array(whole), F.coalesce(states, F.array().cast("array<struct<field:string,status:string>>")))


def parsed(messages: DataFrame, value_col: str, ddl: str, by: list[str]) -> DataFrame:
    """by..., __message and __decoded: every message parsed twice, to its fields as variants and to the
    declared schema. In a projection of their own: folded into the states, which name them many
    times, the message would be parsed for every field again."""
    text = F.col(value_col).cast("string")
    return messages.select(*by, F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>").alias("__message"),
                           F.from_json(text, S.struct(ddl)).alias("__decoded"))


def field_report(messages: DataFrame, value_col: str = "value", ddl: str = S.LISTING_DDL, by: list[str] | None = None) -> DataFrame:
    """(by..., field, status, messages), how many messages have each field in each state. Counts
    are combined in every task before the exchange: it carries at most fields x states rows of
    a task and ``by`` value. A field is absent from those objects that have it in no state."""
    by = by or []
    rows = parsed(messages, value_col, ddl, by).select(*by, F.explode(field_states(F.col("__message"), F.col("__decoded"), ddl)).alias("__f"))
    counts = rows.groupBy(*by, F.col("__f.field").alias("__field"), F.col("__f.status").alias("__status")).agg(F.count("*").alias("__n"))
    seen = counts.groupBy(*by).agg(F.collect_list(F.struct(F.col("__field").alias("field"), F.col("__status").alias("status"),
                                                           F.col("__n").alias("messages"))).alias("__seen"))
    total = lambda keep: F.aggregate(F.filter("__seen", keep), F.lit(0).cast("long"), lambda n, x: n + x["messages"])
    absent = F.transform(F.array(*map(F.lit, S.struct(ddl).fieldNames())), lambda f: F.struct(
        f.alias("field"), F.lit(ABSENT).alias("status"),
        (total(lambda x: x["status"] == OBJECT) - total(lambda x: x["field"] == f)).alias("messages")))
    every = F.concat(F.filter("__seen", lambda x: x["status"] != OBJECT), F.filter(absent, lambda x: x["messages"] > 0))
    return seen.select(*by, F.inline(every))
