"""Hard negatives: the tree search against brute force over all pairs."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus.llm import hyperplane_tree as ht
from domus.llm.queries import op12_hard_negatives

SF = "/root/testdata/sf0.01"
DDL = "vec_id long, embedding array<float>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=100):
    known = {}
    for i, v, b in rows:
        if i is None or b is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = [math.floor(256 * float(np.float32(x))) for x in v]
        b = (b + 1) % 10 if i % 7 == 0 else b
        known[i] = min(known.get(i, (b, one)), (b, one))
    out = set()
    for a, (label, v) in known.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, b) for i, (b, w) in known.items() if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            found = [(n, i) for n, i, b in scored if b != label and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out |= {(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(found)}
    return out


def search(spark, rows, every=100, ddl=DDL):
    got = ht.hard_negatives(spark.createDataFrame(rows, ddl), label=ht.relabelled(), every=every).select(*NAMES)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got))
    return set(got)


def clustered(n, seed, centres=12, dims=8, spread=0.1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i, (middle[i % centres] + spread * rng.normal(size=dims)).astype(np.float32).tolist(), int(rng.integers(10))) for i in range(n)]


def test_clusters_with_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(ht, "SAMPLE", 500)
    rows = clustered(1500, 1)
    rows += [(1500 + i, [0.5] * 8, i % 3) for i in range(700)]  # one vector, a third of all rows: ties go by id
    assert search(spark, rows, every=50) == brute(rows, 50)


def test_leaves_are_left_out_and_none_is_missed():
    """On clusters most leaves are skipped; every leaf with a row in the window stays."""
    rows = clustered(4000, 2, centres=30)
    x = np.floor(np.array([v for _, v, _ in rows]) * 256)
    tree = ht.Tree(x[:1000], float((x * x).sum(axis=1).max()))
    leaf = tree.place(x)
    for one in np.unique(leaf):
        away = tree.along(int(one), x[leaf == one])
        if away.shape[1]:
            tree.measure(int(one), away.min(axis=0), away.max(axis=0))
    score = x[:40] @ x.T
    most = np.sort(score, axis=1)[:, -6:-5]
    least = np.ceil(0.8 * most)
    still = tree.open_leaves(x[:40], most, least)
    for i in range(40):
        assert still[i][np.unique(leaf[(score[i] <= most[i]) & (score[i] >= least[i])])].all()
    assert len(tree.path) > 20 and still.mean() < 0.5


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 5), st.integers(1, 40))
def test_random_small_integers(spark, seed, dims, every):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.integers(-2, 3, dims) / 4).tolist(), int(rng.integers(3))) for i in rng.choice(400, 120, replace=False)]
    assert search(spark, rows, every) == brute(rows, every)


def test_edge_rows(spark):
    v = [0.5, 0.25, -0.125]
    rows = [(100, v, 1), (100, v, 1), (200, [0.5, 0.25], 1), (201, v, 2), (202, None, 2), (203, [0.5, None, 0.1], 2), (204, [float("nan")] * 3, 2),
            (205, [float("inf"), 0.0, 0.0], 2), (206, v, None), (None, v, 2), (300, [], 4), (301, [0.0, 0.0, 0.0], 4), (302, [], 5), (-100, v, 1),
            (207, [0.5, 0.2, 0.0], 3), (208, v, 3), (208, v, 2)]
    assert search(spark, rows) == brute(rows) != set()


def test_extra_columns_and_empty_tables(spark):
    rows = clustered(300, 4)
    wide = spark.createDataFrame(rows, DDL).withColumn("leaf", F.lit("x")).withColumn("score", F.lit(1))
    got = ht.hard_negatives(wide, label=ht.relabelled()).select(*NAMES).collect()
    assert {tuple(r) for r in got} == brute(rows)
    assert search(spark, []) == set()
    assert search(spark, [(100, None, 1)]) == set()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="exact integer"):
        search(spark, [(100, [1e30], 1), (101, [1.0], 1)])


def test_query_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert {tuple(r) for r in op12_hard_negatives(spark, SF).select(*NAMES).collect()} == brute(rows)
