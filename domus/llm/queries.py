"""The contract queries of this subpackage: one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from domus.llm import (column_suffix, debruijn, exact_shards, fill_middle, hyperplane_tree, lsh_forest, merkle, piece_bpe,
                       subword_classifier, templates, token_counts, url_rules, weak_rules)
from domus.llm.common import read, store

# The rules that the URL query judges by.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TOKEN_LIMIT = 1024
ARCHIVE_RECORDS = 1000  # ids per archive file
ACCEPT = 0.3


def warc_records(pages: DataFrame, damaged: Column | None = None) -> DataFrame:
    """The pages as archived records: archive, offset, length, sha, page_id. An archive holds
    the records of a block of ids in id order; rows without an id spread over 1,024 archives. Of
    ``damaged`` rows the payload's first byte is another one."""
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
                    F.lit("\r\nContent-Length: "), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"), F.lit("\r\n\r\n"))
    block = F.coalesce(F.concat(F.lit("crawl-"), F.expr(f"page_id div {ARCHIVE_RECORDS}").cast("string")),
                       F.concat(F.lit("crawl-x"), F.pmod(F.xxhash64("url"), F.lit(1024)).cast("string")))
    body = F.concat(head, F.coalesce("html", F.lit("")), F.lit("\r\n\r\n"))
    if damaged is not None:
        body = F.when(damaged, F.overlay(body, F.lit("#"), 1, 1)).otherwise(body)
    rows = merkle.digested(pages.select(block.alias("archive"), F.struct("page_id", "url").alias("offset"), body.alias("payload")))
    before = Window.partitionBy("archive").orderBy("offset", "sha").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("archive", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "sha",
                       F.col("offset.page_id").alias("page_id"))


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of the pages' archives in which some records are damaged: ids that
    leave 13 modulo 97 have another payload, ids that leave 5 modulo 89 are gone."""
    pages = read(spark, sf_dir, "pages")
    primary = store(warc_records(pages), "warc")
    replica = warc_records(pages, F.coalesce(F.col("page_id") % 97 == 13, F.lit(False)))
    replica = replica.filter(F.coalesce(F.col("page_id") % 89 != 5, F.lit(True)))
    found = merkle.audit(primary, replica)
    return found.join(primary.select("archive", "offset", "page_id"), ["archive", "offset"], "left")


def op2_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(read(spark, sf_dir, "documents"))


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.deduplicate(read(spark, sf_dir, "documents"), form="digest")


def op7_column_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_suffix.deduplicate(read(spark, sf_dir, "documents"), form="digest")


def op6_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "quality")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = subword_classifier.train(docs, read(spark, sf_dir, "labels"))
    scored = subword_classifier.score(docs, model)
    return scored.select("doc_id", subword_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, url_rules.rule_table(spark, URL_RULES)).drop("url")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(read(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("kept.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperplane_tree.hard_negatives(read(spark, sf_dir, "embeddings"), label=hyperplane_tree.relabelled())


def op13_exact_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = exact_shards.shuffled(read(spark, sf_dir, "documents"))
    text = F.coalesce("row.text", F.lit(""))
    return dealt.select("row.doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_merkle_fixity": op1_merkle_fixity,
    "op2_lsh_forest_join": op2_lsh_forest_join,
    "op3_template_leaks": op3_template_leaks,
    "op4_url_rules": op4_url_rules,
    "op5_debruijn_dedup": op5_debruijn_dedup,
    "op6_weak_quality": op6_weak_quality,
    "op7_column_suffix_dedup": op7_column_suffix_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_piece_bpe": op10_piece_bpe,
    "op11_fill_middle": op11_fill_middle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_shards": op13_exact_shards,
}

ORACLE_SQL: dict[str, str] = {
    "op4_url_rules": """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
whole AS (SELECT page_id, coalesce(regexp_extract(rest, '^([^?#]*)', 1), '') AS w FROM cut),
split AS (SELECT page_id, lower(regexp_extract(w, '^([^/]*)', 1)) AS host,
                 substr(w, length(regexp_extract(w, '^([^/]*)', 1)) + 1) AS path FROM whole),
rules(rhost, rpath, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (SELECT page_id, host, path, rhost || rpath AS r, rv,
          row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
        FROM split LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, r AS "rule", coalesce(rv, 'allow') AS verdict FROM fit WHERE k = 1
""",
    "op11_fill_middle": """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, units, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parted AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS p, array_to_string(list_slice(units, a + 1, b), '') AS m,
         array_to_string(list_slice(units, b + 1, n), '') AS s FROM cut),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parted)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(o) AS output_sha256,
       sha256(CASE form
         WHEN 'plain' THEN o
         WHEN 'psm' THEN substr(o, 4, strpos(o, '<S>') - 4) || substr(o, strpos(o, '<M>') + 3)
                         || substr(o, strpos(o, '<S>') + 3, strpos(o, '<M>') - strpos(o, '<S>') - 3)
         ELSE substr(o, strpos(o, '<P>') + 3, strpos(o, '<M>') - strpos(o, '<P>') - 3) || substr(o, strpos(o, '<M>') + 3)
              || substr(o, 4, strpos(o, '<P>') - 4) END) AS restored_sha256
FROM made
""",
    "op12_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS k FROM scored WHERE same),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS k
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE p.k <= 5 AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE k <= 5
""",
}
