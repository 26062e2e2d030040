"""Connected components over an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the least node of the
    node's component.

    Each round maps a node to the neighbour (or itself) that a hash puts first, follows that
    map twice, and replaces the edges by the edges between images. Which node comes first is
    random, so a chain loses a fixed part of its nodes each round whatever its ids. Hot
    nodes are reduced before the shuffle; rounds are written to the shared folder, as few tables
    as they need: every job leaves something in the driver's memory.
    """
    left = store(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        first = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n"))
        step = both.groupBy("a").agg(F.least(F.min(first), F.min(own))["n"].alias("to"))  # one shuffle serves both sides below
        jump = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = store(step.join(jump, "to").select("a", F.col("further").alias("to")), "step")
        steps.append(step)
        ends = left.join(step, "a").select(F.col("to").alias("a"), "b").join(step.withColumnRenamed("a", "b"), "b")
        left = store(ends.select("a", F.col("to").alias("b")).filter("a <> b")
                     .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    mapped = steps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for step in steps[1:]:
        onward = step.select(F.col("a").alias("root"), "to")
        mapped = mapped.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    mapped = store(mapped, "mapped") if len(steps) > 1 else mapped
    least = mapped.groupBy("root").agg(F.min("node").alias("least"))
    return mapped.join(least, "root").select("node", F.col("least").alias("root"))
