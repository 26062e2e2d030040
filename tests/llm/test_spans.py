import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.llm import column_suffix, debruijn, queries, spans


def brute_words(rows, width=20):
    order = lambda i: float("inf") if i is None else i
    first, docs = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            first[g] = min(first.get(g, float("inf")), order(i))
    out = []
    for i, w in docs:
        gone, seen = set(), set()
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            if first[g] < order(i) or g in seen:
                gone.update(range(k, k + width))
            seen.add(g)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, width=50):
    order = lambda i: float("inf") if i is None else i
    first, docs = {}, [(i, (t or "").encode()) for i, t in rows]
    for i, t in docs:
        for k in range(len(t) - width + 1):
            g = t[k:k + width]
            first[g] = min(first.get(g, float("inf")), order(i))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for k in range(len(t) - width + 1):
            if first[t[k:k + width]] < order(i):
                gone[k:k + width] = True
        ends = int((np.diff(gone.astype(int)) == -1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), ends, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "été", "漢字", *[f"w{i}" for i in range(300)]]
    pool = [" ".join(rng.choice(vocab) for _ in range(rng.choice([12, 25, 60]))) for _ in range(6)]
    rows = []
    for i in range(40):
        text = " ".join(rng.choice([rng.choice(pool), " ".join(rng.choice(vocab) for _ in range(30))]) for _ in range(rng.randrange(1, 5)))
        rows.append((i, text))
    rows += [(40 + i, rows[i][1]) for i in range(4)]  # whole copies
    near = rows[5][1].split()
    for i in range(12):
        edited = list(near)
        edited[rng.randrange(len(edited))] = "edit"
        rows.append((50 + i, " ".join(edited)))
    rows += [(70, None), (71, ""), (72, "be " * 200), (73, "be " * 30), (74, "a" * 300), (75, "a" * 60), (76, "ab" * 100),
             (77, " ".join(rng.choice(vocab) for _ in range(3000))), (78, "short"), (None, rows[3][1]), (None, "only here " * 3),
             (None, rows[3][1]), (3, rows[3][1]), (3, rows[8][1]), (-5, rows[9][1][10:300])]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 9, "x", 1) for i, t in rows], "doc_id long, text string, doc int, tag string, spans int")


@pytest.mark.parametrize("seed", [1, 2])
def test_both_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = _frame(spark, rows).repartition(3)
    got = sorted((tuple(r) for r in debruijn.deduplicate(docs, form="digest").collect()), key=str)
    assert got == brute_words(rows)
    got = sorted((tuple(r) for r in column_suffix.deduplicate(docs, form="digest").collect()), key=str)
    assert got == brute_bytes(rows)


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_anchors_equal_brute_force(spark, hot):
    rows = corpus(3)
    got = column_suffix.deduplicate(_frame(spark, rows).repartition(3), form="digest", hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_bytes(rows)


@pytest.mark.parametrize("same", [None, 5])
def test_a_third_of_the_rows_without_an_id_or_of_one_id(spark, same):
    """The results are those of brute force, and the time stays near that of a table with ids."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy("doc_id").limit(3000).collect()]
    frames = [_frame(spark, [(same if hot and i % 3 == 0 else i, t) for i, t in enumerate(texts)]).repartition(4).cache() for hot in (False, True)]
    for deduplicate, brute in ((debruijn.deduplicate, brute_words), (column_suffix.deduplicate, brute_bytes)):
        took = []
        for frame in frames:
            start = time.perf_counter()
            got = deduplicate(frame, form="digest").collect()
            took.append(time.perf_counter() - start)
        rows = [(r.doc_id, r.text) for r in frames[1].collect()]
        assert sorted((tuple(r) for r in got), key=str) == brute(rows)
        assert took[1] < 2 * took[0] + 2, took


def test_first_documents_by_columns():
    rng = np.random.default_rng(4)
    width, k = 12, 5
    text = [bytes(rng.choice(list(b"ab"), 60).tolist()) for _ in range(30)] + [b"a" * 60]
    rows = []
    for d, t in enumerate(text):
        r = spans.Runs(column_suffix._CODE[np.frombuffer(t, np.uint8)], np.array([len(t)]), width, k)
        rows += [(int(m), int(p - s), int(n), d, t[s:s + n + width - 1]) for m, p, s, n in zip(r.anchor, r.place, r.start, r.n)]
    rows.sort(key=lambda x: x[0])
    m, left, n, doc, piece = zip(*rows)
    group = np.unique(np.array(m, dtype=np.uint64), return_inverse=True)[1]
    got = column_suffix.first_documents(group, np.array(left), np.array(n), np.array(doc), list(piece), width, k)
    least = {}
    for d, t in enumerate(text):
        for i in range(len(t) - width + 1):
            least.setdefault(t[i:i + width], d)
    for i, p in enumerate(piece):
        assert got[i, :n[i]].tolist() == [least[p[j:j + width]] for j in range(n[i])]


def test_packing_and_empty(spark):
    a = np.array([0, 1 << 63, 0xFFFFFFFFFFFF0000, 0x0000000000010000], dtype=np.uint64)
    assert spans.unpack(spans.pack(a)).tolist() == a.tolist()
    none = _frame(spark, [(1, "x")]).limit(0)
    assert debruijn.deduplicate(none).count() == 0 and column_suffix.deduplicate(none).count() == 0


def test_queries_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op5_debruijn_dedup(spark, sf).collect()), key=str) == brute_words(rows)
    assert sorted((tuple(r) for r in queries.op7_column_suffix_dedup(spark, sf).collect()), key=str) == brute_bytes(rows)


def test_rows_of_one_id_whose_texts_collide_in_32_bits_stay_apart(spark):
    text = F.concat(F.lit("one two three four five six seven eight nine ten "), *[F.concat(F.col("id"), F.lit(f" x{k} ")) for k in range(12)])
    same = spark.range(300_000).select(text.alias("t")).groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).filter("size(ts) > 1")
    copied, own = same.orderBy("h").first().ts[:2]
    rows = [(1, copied), (7, copied), (7, own), (None, copied), (None, own)]
    got = sorted((tuple(r) for r in debruijn.deduplicate(_frame(spark, rows), form="digest").collect()), key=str)
    assert got == brute_words(rows)
    got = sorted((tuple(r) for r in column_suffix.deduplicate(_frame(spark, rows), form="digest").collect()), key=str)
    assert got == brute_bytes(rows)


def test_a_common_passage_is_one_row_per_document_and_slice(spark, monkeypatch):
    """Its pieces' places travel packed: rows follow the documents, not documents x pieces."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    common = " ".join(word() for _ in range(60))
    rows = [(i, " ".join([*(word() for _ in range(12)), common, *(word() for _ in range(12))])) for i in range(300)]
    rows += [(300 + i, common[40:300] + word()) for i in range(20)]
    docs = spans.keyed(_frame(spark, rows).repartition(2), "text", [])
    found = column_suffix.repeated_windows(docs, spans.copies(docs, "text").limit(0), 50, 20)
    assert {tuple(f) for f in found.dtypes} == {("node", "bigint"), ("tag", "int"), ("spans", "array<struct<start:int,n:int>>")}
    # a row of the merged places and those of the two pieces at its ends, which differ; not one for each of its pieces
    assert found.groupBy("node").count().agg(F.expr("median(count)")).first()[0] <= 3
    for hot in (column_suffix.HOT, 3):
        got = column_suffix.deduplicate(_frame(spark, rows).repartition(2), form="digest", hot=hot).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_bytes(rows)
