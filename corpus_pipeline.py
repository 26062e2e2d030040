"""From raw documents to token ids: classify, drop near copies, cut repeated bytes, drop
leaked benchmarks, encode.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but
the last return the columns of documents.

Defined results: null and empty texts pass every stage that has nothing to find in them.
Rows without an id are no one's copy and come last where order matters. Repeated rows of a
kept id stay together, extra columns are carried along, empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import column_suffix, lsh_forest, piece_bpe, subword_classifier, templates
from domus.llm.common import read, store

ACCEPT = 0.3
SCORE = "__score"

# The classifier is trained and the template slots are compared in steps that SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = subword_classifier.train(docs, read(spark, sf_dir, "labels"))
    scored = subword_classifier.score(docs, model, keep=docs.columns, into=SCORE)
    return scored.filter(F.col(SCORE) >= ACCEPT).select(*[f"`{c}`" for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    classes = lsh_forest.near_duplicates(docs)
    gone = classes.filter("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier document has; documents of which nothing is left go."""
    kept = column_suffix.deduplicate(docs, form="text", carry=[c for c in docs.columns if c != "text"])
    kept = kept.filter("n_removed = 0 OR length(kept) > 0")
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        size = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_removed") > 0, size).otherwise(F.col("rest.n_chars"))
    return kept.select(*[changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return templates.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded bytes, ids."""
    return piece_bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_bytes),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
