"""Fixity audit of archive replicas by Merkle trees over records and ordered offset ranges.

A record is (archive, offset, payload). Its leaf digest covers offset, length and payload.
Records of an archive meet in offset ranges of ``range_bytes``; a range's digest covers its
leaves in offset order, and every level above covers ``fanout`` neighbouring ranges, up to
one root per archive. Two replicas are compared from the roots down: only children of nodes
that differ are looked at, so the work below the roots follows the damage, not the archive.

Defined results: records that differ, or exist in one replica only, are returned as
``corrupt``, ``missing`` (not in the replica) or ``extra``. Null archives are one archive of
their own, null offsets are offset -1, a null payload differs from an empty one. Repeated
identical records count: a record kept twice but expected once is ``corrupt``. Empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.llm.common import store

RANGE_BYTES = 1 << 16
FANOUT = 16
NODE = ["archive", "node"]


def digested(records: DataFrame) -> DataFrame:
    """archive, offset, length and payload digest of every record: the payload goes no further."""
    payload = F.col("payload").cast("binary")
    return records.select("archive", "offset", F.length(payload).alias("length"), F.sha2(payload, 256).alias("sha"))


def leaves(records: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """archive, offset, digest and range number of every distinct place, from :func:`digested`
    records. The digest of a place with several records covers the sums of all of theirs."""
    rows = records.select(
        F.coalesce(F.col("archive").cast("string"), F.lit("")).alias("archive"),
        F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"),
        F.sha2(F.concat_ws("|", F.col("offset").cast("string"), F.col("length").cast("string"), "sha"), 256).alias("d"))
    # equal records at one place are counted; different ones are summed, not listed: a place of any
    # number of records (all those without an offset) stays one small row in every task
    same = rows.groupBy("archive", "offset", "d").agg(F.count("*").alias("n"))
    same = same.withColumn("e", F.sha2(F.concat_ws(":", "d", F.col("n").cast("string")), 256))
    sums = [F.sum(F.conv(F.substring("e", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    one = same.groupBy("archive", "offset").agg(F.sha2(F.concat_ws(":", *sums), 256).alias("digest"))
    return one.withColumn("node", F.expr(f"greatest(offset, 0L) div {range_bytes}"))


def _up(level: DataFrame, fanout: int) -> DataFrame:
    return (level.withColumn("child", F.col("node")).withColumn("node", F.expr(f"child div {fanout}"))
            .groupBy(*NODE).agg(_combine("child")))


def _combine(order: Column | str) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col("digest")))),
                                           lambda s: s["digest"]), "|"), 256).alias("digest")


def levels(leaf: DataFrame, height: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Tree levels above the leaves, from offset ranges up to one root per archive."""
    out = [store(leaf.groupBy(*NODE).agg(_combine("offset")), "merkle-level")]
    for _ in range(height):
        out.append(store(_up(out[-1], fanout), "merkle-level"))
    return out


def _differ(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks."""
    x, y = a.select(*keys, F.col("digest").alias("da")), b.select(*keys, F.col("digest").alias("db"))
    return x.join(y, keys, "full_outer").filter(~F.col("da").eqNullSafe(F.col("db")))


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """archive, offset, state, expected and found digest of every record at which the replica
    differs. Both sides are :func:`digested` records."""
    a, b = (store(leaves(x, range_bytes), "merkle-leaves") for x in (primary, replica))
    last = a.select("node").union(b.select("node")).agg(F.max("node")).first()[0] or 0
    height = 0
    while fanout ** height <= last:
        height += 1
    up_a, up_b = levels(a, height, fanout), levels(b, height, fanout)
    bad = store(_differ(up_a[-1], up_b[-1], NODE).select(*NODE), "merkle-bad")
    for x, y in zip(up_a[-2::-1], up_b[-2::-1]):
        parents = bad.withColumnRenamed("node", "parent")
        sides = [z.withColumn("parent", F.expr(f"node div {fanout}")).join(parents, ["archive", "parent"], "left_semi")
                 for z in (x, y)]
        bad = store(_differ(*sides, NODE).select(*NODE), "merkle-bad")
    diff = _differ(*[z.join(bad, NODE, "left_semi") for z in (a, b)], ["archive", "offset"])
    state = F.when(F.col("db").isNull(), "missing").when(F.col("da").isNull(), "extra").otherwise("corrupt")
    return diff.select("archive", "offset", state.alias("state"), F.col("da").alias("expected"), F.col("db").alias("found"))
