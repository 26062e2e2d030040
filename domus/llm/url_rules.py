"""URL filter: host-suffix / path-prefix expressions, hash-prefix join, digest, precedence.

Every URL is expanded into (host suffix + path prefix) expressions. Only suffixes with as
many labels, and prefixes with as many characters, as some rule has are made, so the number
of expressions of a URL is bounded by the rule table and not by the URL. Expressions meet
the rules on the first bytes of their SHA-256; the full digest then confirms, and the
longest rule wins (ties: the longer host, then block before allow).

Defined results: a null URL or one without ``://`` has empty host and path, and no rule fits
it; a rule fits only if the path literally starts with the rule's path, so an empty path
fits no rule whose path is ``/``. Repeated rows each get their own result; extra columns of
the pages are ignored. With no rules, or no fitting rule, the verdict is ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8  # four bytes of the digest meet in the join


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    whole = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(whole, r"(?s)^([^/]*)", 1)
    path = F.substring(whole, F.length(host) + 1, F.length(whole))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a rule table."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) pairs with their expressions (arrays on one row of rule shape)."""
    # one row: the label counts and path lengths that occur, no more than a host has labels or a path characters
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                      F.collect_set(F.length("path")).alias("lengths")).first()
    labels = F.split("host", r"\.")
    counts, lengths = (F.lit(x).cast("array<int>") for x in (sorted(shape.labels), sorted(shape.lengths)))
    suffixes = F.transform(F.filter(counts, lambda n: n <= F.size(labels)),
                           lambda n: F.array_join(F.slice(labels, -n, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    both = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("\n"), p))))
    return urls.select("host", "path", F.explode(both).alias("_e"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (``host + path`` of the winning rule) and verdict."""
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    split = pages.select(*[F.col(f"`{c}`") for c in kept]).withColumns({"host": host, "path": path})
    digest = F.sha2("_e", 256)
    urls = split.filter("host <> ''").select("host", "path").distinct()
    found = _expressions(urls, rules).select("host", "path", digest.alias("_d")) \
        .withColumn("_p", F.substring("_d", 1, PREFIX_HEX))
    named = rules.filter("host IS NOT NULL AND path IS NOT NULL").select(
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("_h"),
        F.sha2(F.concat("host", F.lit("\n"), "path"), 256).alias("_rd")) \
        .withColumn("_p", F.substring("_rd", 1, PREFIX_HEX))
    rank = F.struct(F.length("rule").alias("n"), F.col("_h"), (F.col("verdict") == "block").alias("b"), F.col("rule"))
    best = (found.join(named, "_p").filter("_d = _rd")
            .groupBy("host", "path").agg(F.max(F.struct(rank.alias("k"), "rule", "verdict")).alias("_w")))
    return (split.join(best, ["host", "path"], "left")
            .select(*[F.col(f"`{c}`") for c in kept], "host", "path",
                    F.col("_w.rule").alias("rule"), F.coalesce("_w.verdict", F.lit(default)).alias("verdict")))
