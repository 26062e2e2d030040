"""Fill-in-the-middle: the rank index against plain offsets, outputs against a unit-by-unit version."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus.llm import fill_middle as fm
from domus.llm.queries import op11_fill_middle

SF = "/root/testdata/sf0.001"


def plainly(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4000), max_size=80), min_size=1, max_size=6), st.integers(0, 127))
def test_rank_index_is_exact(steps, bound):
    seqs = [np.cumsum([0, *s]) for s in steps]
    starts = np.cumsum([0, *map(len, seqs)])[:-1]
    values = np.concatenate(seqs)
    index = fm.RankIndex(values, starts, bound)
    assert (index.at(np.arange(len(values))) == values).all()
    assert np.abs(index.residual.astype(int)).max() <= bound
    assert set(starts.tolist()) <= set(index.first.tolist())  # no segment crosses a sequence


def test_rank_index_of_a_long_sequence_is_small():
    rng = np.random.default_rng(1)
    values = np.r_[0, np.cumsum(rng.integers(1, 12, 3_000_000))]
    index = fm.RankIndex(values, np.array([0]))
    at = rng.integers(0, len(values), 1000)
    assert (index.at(at) == values[at]).all()
    assert len(index.first) < len(values) / 500


TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("abZ<>PSM 1\néł\U0001f600")), max_size=60), min_size=1, max_size=8)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(0, 10**6))
def test_rows_equal_the_plain_version(texts, first):
    ids = [None if i == 3 else first + i for i in range(len(texts))]
    assert list(fm.rearranged(ids, texts, 90, 20)) == [plainly(i, t) for i, t in zip(ids, texts)]


def test_edge_rows(spark):
    long = "word 12 " * 200_000
    rows = [(1, None, "x"), (2, "", "x"), (None, "some words here, and more", "x"), (4, "a <P> b", "x"), (5, long, "x"), (5, long, "x"),
            (6, "<<S", "x"), (7, "é" * 5000, "x"), (-8, "minus eight", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    made = fm.fill_in_middle(docs, keep=["doc_id", "text", "output"])
    got = made.select("kept.*", "n", "form", "prefix_chars", "middle_chars", F.col("output").alias("made"),
                      fm.restored(made.output, F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.made) == plainly(r.doc_id, r.text)
        assert r.back == (r.text or "") and r.output == "x"


def test_empty_table(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query_whole_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = op11_fill_middle(spark, sf).collect()
    assert len(got) == len(docs)
    forms = set()
    for r in got:
        n, form, p, m, out = plainly(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}
