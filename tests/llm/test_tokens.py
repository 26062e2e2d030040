import hashlib
import random
import sys
import time

import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from domus.llm import piece_bpe, queries, token_counts
from domus.llm.common import tokenizer_path
from domus.llm.token_counts import PATTERN

JSON, RANKS = (tokenizer_path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
LIB = Tokenizer.from_file(JSON)
TIK = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                        mergeable_ranks={t: i for i, t in enumerate(piece_bpe.read_ranks(RANKS))})
ODD = ["", " ", "aaaaaaaaaaaaa", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "don't I'LL x  \n\n y ", "▁▁ ▁x",
       "été ñandú 漢字 🙂🙂 \u200b\u00a0 \x1c\x85 0123 ٣", "=" * 3000, "ab" * 5000, "<unk><s>"]


def _counts(texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    return [r["n_tokens"] for b in token_counts.count_batches(iter([batch]), JSON) for r in b.to_pylist()]


def _expected(texts):
    return [len(LIB.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_and_ids_equal_the_libraries_on_odd_texts():
    assert _counts(ODD) == _expected(ODD)
    assert piece_bpe.codec(RANKS).encode(ODD) == [TIK.encode_ordinary(t) for t in ODD]


def test_long_pre_tokens_equal_the_library_in_seconds(monkeypatch):
    rng = random.Random(1)
    letters = lambda n, of: "".join(rng.choices(of, k=n))
    texts = [letters(1_000_000, "abcdefghijklmnopqrstuvwxyz"), "a" * 100_001, "=" * 70_000, letters(40_000, "ab"), letters(3000, "éñ漢x"),
             "the" * 20_000 + " " + letters(600, "etaoin")]
    began = time.perf_counter()
    got = _counts(texts)
    assert time.perf_counter() - began < 60
    assert got == _expected(texts)
    monkeypatch.setattr(token_counts, "LONG", 1)  # every pre-token the linked way
    short = ODD + [letters(rng.randrange(1, 40), "abcde tion") for _ in range(500)]
    assert _counts(short) == _expected(short)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab' \n.1é漢"), st.characters(exclude_categories=["Cs"])),
                        max_size=60), max_size=6))
def test_counts_and_ids_equal_the_libraries(texts):
    assert _counts(texts) == _expected(texts)
    c = piece_bpe.codec(RANKS)
    ids = c.encode(texts)
    assert ids == [TIK.encode_ordinary(t) for t in texts]
    import numpy as np
    assert [c.decode(np.array(i, dtype=np.int64)).decode() for i in ids] == texts


def test_every_code_point_splits_alike():
    text = " ".join(f"a{chr(i)}1" for i in range(0x30000) if not 0xD800 <= i < 0xE000)
    step = 20_000
    texts = [text[i:i + step] for i in range(0, len(text), step)]
    unlike = [i for i, (a, b) in enumerate(zip(piece_bpe.codec(RANKS).encode(texts), [TIK.encode_ordinary(t) for t in texts])) if a != b]
    assert unlike == []
    assert _counts(texts) == _expected(texts)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None])] + [(3, ODD[3], "x"), (None, "null id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_frames_handle_nulls_repeats_and_clashing_columns(spark, docs):
    got = {(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs).collect()}
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert got == {(i, len(t.encode()), n) for (i, t), n in zip(rows, _expected([t for _, t in rows]))}
    assert token_counts.token_counts(docs).count() == docs.count()
    enc = piece_bpe.encode(docs)
    want = sorted(((i, TIK.encode_ordinary(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in enc.collect()), key=str) == want
    assert sorted((str(r.doc_id), bytes(r.bytes).decode()) for r in piece_bpe.decode(enc).collect()) == \
        sorted((str(i), t) for i, t in rows)


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert token_counts.token_counts(none).count() == 0 and piece_bpe.round_trip(none).count() == 0


def test_queries_equal_the_libraries_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    n = {r.doc_id: (len((r.text or "").encode()), len(LIB.encode(r.text or "", add_special_tokens=False).ids)) for r in rows}
    got = queries.op8_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == n and len(got) == len(rows)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    want = {}
    for r in rows:
        ids = TIK.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(TIK.decode_bytes(ids)).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op10_piece_bpe(spark, sf).collect()} == want


if __name__ == "__main__":
    sys.exit(pytest.main([__file__, "-q"]))
