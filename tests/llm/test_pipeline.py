import hashlib

import tiktoken

import corpus_pipeline
from domus.llm import lsh_forest, piece_bpe, templates
from domus.llm.common import store, tokenizer_path
from domus.llm.queries import op9_quality_classifier
from domus.llm.token_counts import PATTERN

SF = "/root/testdata/sf0.001"


def cut(rows, width=50):
    """Bytes that start a window of a smaller id go; documents left empty by that go too."""
    first = {}
    for i, t in rows:
        for k in range(len(t) - width + 1):
            first[t[k:k + width]] = min(first.get(t[k:k + width], i), i)
    out = {}
    for i, t in rows:
        gone = set()
        for k in range(len(t) - width + 1):
            if first[t[k:k + width]] < i:
                gone.update(range(k, k + width))
        kept = bytes(b for k, b in enumerate(t) if k not in gone).decode("utf-8", "ignore")
        if kept or not gone:
            out[i] = kept
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    a = store(stage["quality classifier"](spark, docs, SF), "t")
    good = {r.doc_id for r in op9_quality_classifier(spark, SF).collect() if r.predicted}
    assert {r.doc_id for r in a.collect()} == good and a.columns == docs.columns
    b = store(stage["n-gram Jaccard join"](spark, a, SF), "t")
    from test_lsh_forest import brute
    want = {i for i, v in brute([(r.doc_id, r.text) for r in a.collect()]).items() if v[0] == i}
    assert {r.doc_id for r in b.collect()} == want and b.columns == docs.columns
    c = store(stage["suffix-array dedup"](spark, b, SF), "t")
    assert {r.doc_id: r.text for r in c.collect()} == cut([(r.doc_id, (r.text or "").encode()) for r in b.collect()])
    assert c.dtypes == docs.dtypes and all(r.n_chars == len(r.text) for r in c.collect())
    d = store(stage["benchmark decontamination"](spark, c, SF), "t")
    leaks = {r.doc_id for r in templates.find_leaks(c, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in d.collect()} == {r.doc_id for r in c.collect()} - leaks and d.dtypes == docs.dtypes
    tik = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                            mergeable_ranks={t: i for i, t in enumerate(piece_bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken")))})
    last = {r.doc_id: (r.ids, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert last == {r.doc_id: (ids := tik.encode_ordinary(r.text or ""), len(ids), hashlib.sha256((r.text or "").encode()).hexdigest())
                    for r in d.collect()}


def test_odd_rows_pass_through(spark, tmp):
    rows = [(1, None, "x", None), (2, "", "y", 1), (None, "no id here but words", "z", 3), (3, "w " * 20_000, None, 2),
            (4, "same text of a few words " * 3, "a", 1), (5, "same text of a few words " * 3, "b", 1), (4, "same text of a few words " * 3, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n long")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = store(stage(spark, docs, tmp), "t"), store(stage(spark, empty, tmp), "t")
        assert empty.count() == 0 and docs.columns == ["doc_id", "text", "key", "n"], name
    assert sorted(((r.doc_id, r.key, r.n) for r in docs.collect()), key=str) == sorted([(1, "x", None), (2, "y", 1), (None, "z", 3), (3, None, 2), (4, "a", 1), (4, "a", 1)], key=str)
    assert lsh_forest.near_duplicates(docs).count() == 6
