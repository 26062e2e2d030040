"""Byte-level BPE through a sentencepiece model that is written directly from the ranks.

The rank file's byte strings become pieces over a printable byte alphabet, each scored by
its negative rank, with identity normalisation and no dummy prefix; the unknown piece takes
the first free id, so a piece's id is its rank. Texts are split by the vocabulary's pattern
and every pre-token is encoded by that model; decoding maps ids back to pieces to bytes.

Defined results: a null or empty text has no ids and decodes to no bytes. Decoding always
gives the encoded UTF-8 back. Rows are independent; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from domus.llm.common import raw_texts, slices, tokenizer_path
from domus.llm.token_counts import MAX_CACHED, PATTERN, byte_alphabet

NORMAL, UNKNOWN, BPE = 1, 2, 2  # fixed values of the model format


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | bytes | np.float32) -> bytes:
    """One protocol-buffer field: bytes (length-delimited), float (fixed 32) or integer."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, np.float32):
        return _varint(number << 3 | 5) + value.tobytes()
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in rank order (ranks must be 0, 1, 2, ...)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model file: pieces (1), trainer spec (2), normaliser spec (3)."""
    letter = byte_alphabet()
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(letter[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, np.float32(-rank)) + _field(3, NORMAL)))
    out.append(_field(1, _field(1, b"<unk>") + _field(2, np.float32(0)) + _field(3, UNKNOWN)))
    trainer = (_field(3, BPE) + _field(4, len(tokens) + 1) + _field(40, len(tokens))  # unknown id
               + _field(41, -1) + _field(42, -1) + _field(43, -1))  # no begin, end or padding pieces
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class PieceCodec:
    """Encode texts to ids and decode ids to bytes."""

    def __init__(self, path: str):
        tokens = read_ranks(path)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        letter = byte_alphabet()
        self._letters = {b: letter[b] for b in range(256)}
        byte_of = {c: b for b, c in letter.items()}
        pieces = [self._model.id_to_piece(i) for i in range(len(tokens))]
        back = [bytes(byte_of[c] for c in p) for p in pieces]  # inverse mapping of every piece
        self._flat = np.frombuffer(b"".join(back), dtype=np.uint8)
        self._size = np.array([len(b) for b in back], dtype=np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._split = regex.compile(PATTERN)
        self._known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        docs = [self._split.findall(t) for t in texts]
        if len(self._known) > MAX_CACHED:
            self._known.clear()
        new = list(set().union(*docs) - self._known.keys())
        if new:
            mapped = [t.encode().decode("latin-1").translate(self._letters) for t in new]
            self._known.update(zip(new, self._model.encode(mapped, num_threads=1)))
        known = self._known
        return [[i for t in tokens for i in known[t]] for tokens in docs]

    def decode(self, ids: np.ndarray) -> bytes:
        size = self._size[ids]
        if not len(ids):
            return b""
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self._start[ids] - (ends - size), size)
        return self._flat[at].tobytes()


@functools.lru_cache(maxsize=4)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, text: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        for part in slices(batch, text):
            ids = c.encode([x.decode("utf-8") for x in raw_texts(part, text)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            out = [c.decode(np.asarray(x, dtype=np.int64)) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])


def encode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """doc_id and ids of every document."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    return docs.select("doc_id", text).mapInArrow(lambda it: _encode(it, path, text), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and bytes of encoded documents."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode(it, path), "doc_id long, bytes binary")


NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _digests(batches: Iterator[pa.RecordBatch], path: str, text: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        for part in slices(batch, text, 1 << 20):
            rows = c.encode([x.decode("utf-8") for x in raw_texts(part, text)])
            shown = [hashlib.sha256(" ".join(map(str, r)).encode()).hexdigest() for r in rows]
            back = [hashlib.sha256(c.decode(np.array(r, dtype=np.int64))).hexdigest() for r in rows]
            out = [part.column("doc_id").cast(pa.int64()), pa.array(map(len, rows), pa.int64()), pa.array(shown), pa.array(back)]
            if keep_ids:
                out.append(pa.array(rows, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=[*NAMES, "ids"][:len(out)])


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded bytes, and on request the ids:
    encoding and decoding in one map, so that decoding needs no second read."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", text).mapInArrow(lambda it: _digests(it, path, text, keep_ids), schema)
