"""Sharding: exact sums of the matrix, its distribution, and every row in exactly one slot."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from domus.llm import exact_shards as es
from domus.llm.queries import op13_exact_shards

SF = "/root/testdata/sf0.001"


def check_deal(rows, shards):
    """Shard sizes differ by one at most, slots are gapless."""
    sizes = Counter(r.shard for r in rows)
    assert all(0 <= s < shards for s in sizes)
    want = [len(rows) // shards + (j < len(rows) % shards) for j in range(shards)]
    assert sorted(sizes.get(j, 0) for j in range(shards)) == sorted(want)
    for j in range(shards):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sizes.get(j, 0)))


def test_matrix_sums():
    rng = np.random.default_rng(3)
    for sent, shards in (([5, 0, 17, 1], 4), ([1000, 3], 40), ([0, 0], 3), ([], 2), ([7], 10)):
        wanted = [sum(sent) // shards + (j < sum(sent) % shards) for j in range(shards)]
        m = es.communication_matrix(sent, wanted, rng)
        assert m.sum(axis=1).tolist() == sent and m.sum(axis=0).tolist() == wanted and (m >= 0).all()


def test_draws_follow_the_distribution():
    rng = np.random.default_rng(5)
    for good, bad, draws in ((6, 9, 7), (300, 1000, 90), (3, 100000, 50000)):
        ours = np.array([es.hypergeometric(rng, good, bad, draws) for _ in range(4000)])
        known = rng.hypergeometric(good, bad, draws, 4000)
        spread = np.sqrt(known.var() / 2000)
        assert abs(ours.mean() - known.mean()) < 5 * spread
        top = max(ours.max(), known.max()) + 1
        a, b = np.bincount(ours, minlength=top), np.bincount(known, minlength=top)
        common = (a + b) >= 20
        assert (((a - b) ** 2 / (a + b).clip(1))[common]).sum() < common.sum() + 6 * np.sqrt(2 * common.sum()) + 6


def test_draws_from_populations_beyond_a_billion():
    rng = np.random.default_rng(6)
    got = [es.hypergeometric(rng, 10**11, 39 * 10**11, 10**6) for _ in range(300)]
    assert abs(np.mean(got) - 25000) < 5 * np.sqrt(10**6 / 40 / 300)


def test_every_row_once_with_clashing_names(spark):
    rows = [(i % 5 if i % 7 else None, None if i % 3 == 0 else "t" * (i % 50), i, "f") for i in range(1000)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, shard string, slot int, row string")
    got = es.shuffled(docs.repartition(7), shards=6, file_rows=100).cache()
    check_deal(got.select("shard", "slot").collect(), 6)
    assert Counter(tuple(r.row) for r in got.collect()) == Counter(rows)


def test_few_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    check_deal(es.shuffled(docs, shards=5).collect(), 5)
    assert es.shuffled(docs.limit(0), shards=5).count() == 0


def test_rows_spread_over_shards_and_slots(spark):
    """Neighbours and equal texts go anywhere: shard and half of the shard are independent of the input order."""
    docs = spark.range(0, 8000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    got = es.shuffled(docs, shards=4).collect()
    table = np.zeros((8, 8))
    for r in got:
        table[r.row.doc_id // 1000, r.shard * 2 + (r.slot >= 1000)] += 1
    assert ((table - 125) ** 2 / 125).sum() < 49 + 6 * np.sqrt(2 * 49)


def test_same_input_same_deal(spark):
    docs = spark.range(0, 500, 1, 3).select(F.col("id").alias("doc_id"))
    one, two = ({(r.row.doc_id, r.shard, r.slot) for r in es.shuffled(docs).collect()} for _ in range(2))
    assert one == two


def test_shard_folders(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"))
    es.write_shards(es.shuffled(docs, shards=3), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    check_deal(back.select("shard", "slot").collect(), 3)


def test_query_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op13_exact_shards(spark, SF).collect()
    check_deal(got, 40)
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
