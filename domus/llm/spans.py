"""Shared ground of the two span deduplications: anchored runs of windows, and the sieve that
finds which anchors occur in more than one document.

A window of ``width`` symbols has an anchor: the least hash among its ``k``-grams (the
leftmost of equals), which depends on the window alone. Consecutive windows with one anchor
place form a run. Equal windows have equal anchors, so a window whose anchor occurs in one
document only cannot occur elsewhere; the sieve shuffles anchors, packed, instead of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.llm.common import RangeHashes, mix, parts, raw_texts, slices

FLUSH_ANCHORS = 1_000_000
LAST = (1 << 63) - 1


def order_key(doc_id: Column | str) -> Column:
    """The id as documents are ordered by it; rows without one come last, none before another (an id
    of 2**63 - 1 counts as none)."""
    return F.coalesce(F.col(doc_id).cast("long") if isinstance(doc_id, str) else doc_id, F.lit(LAST))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (leftmost of equals) of every ``width`` neighbours."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        m = max(0, len(best) - step)
        right = best[step:] < best[:m]
        best, at, have = np.where(right, best[step:], best[:m]), np.where(right, at[step:], at[:m]), have + step
    return at


class Runs:
    """Runs of the windows of some documents' symbols laid end to end: doc, start (in the whole
    sequence), n windows, anchor value and anchor place."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, width: int, k: int):
        self.hashes, self.offsets = RangeHashes(symbols), np.cumsum(np.r_[0, lengths])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        n = max(0, len(symbols) - width + 1)
        grams = self.hashes.windows(k)
        place = sliding_argmin(grams, width - k + 1)[:n]
        inside = np.flatnonzero(owner[:n] == owner[width - 1:][:n])
        place = place[inside]
        fresh = np.flatnonzero(np.r_[True, (np.diff(inside) != 1) | (np.diff(place) != 0)]) if len(inside) else np.zeros(0, np.int64)
        self.start, self.place = inside[fresh], place[fresh]
        self.n = np.diff(np.r_[fresh, len(inside)])
        self.anchor, self.doc = grams[self.place], owner[self.start]


def pack(anchors: np.ndarray) -> bytes:
    """Upper 48 bits of every anchor: enough to sieve by, six bytes each."""
    return np.ascontiguousarray(anchors.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


SIEVED = ~np.uint64(0xFFFF)


def _flush(anchors: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed anchors by bucket, their documents as numbers into the flush's list of nodes, which goes
    along once (kind 2). An anchor that several of these documents have is known to repeat: its
    documents are told at once (kind 1), and it goes on as two entries of one document."""
    known, of = np.unique(nodes, return_inverse=True)
    of = of.astype(np.min_scalar_type(len(known) - 1))
    flush = xxhash.xxh3_64_intdigest(known.tobytes()) >> 1
    order = np.lexsort((of, anchors))
    anchors, of = anchors[order], of[order]
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])]
    anchors, of = anchors[new], of[new]
    equal = anchors[1:] == anchors[:-1]
    first, shared = np.r_[True, ~equal], np.r_[False, equal] | np.r_[equal, False]
    rows = [(flush % buckets, 2, flush, b"", known.tobytes()), (flush % buckets, 1, flush, pack(anchors[shared]), of[shared].tobytes())]
    times = np.where(first, np.where(shared, 2, 1), 0)
    anchors, of = np.repeat(anchors, times), np.repeat(of, times)
    bucket = ((anchors >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        at = order[cuts[b]:cuts[b + 1]]
        if len(at):
            rows.append((b, 0, flush, pack(anchors[at]), of[at].tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
        pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "kind", "flush", "anchors", "of"])


def by_doc(anchors: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(docs, kind="stable")
    anchors, docs = anchors[order], docs[order]
    cuts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True]) if len(docs) else []
    for lo, hi in zip(cuts, cuts[1:]):
        yield int(docs[lo]), anchors[lo:hi]


def _anchors(batches: Iterator[pa.RecordBatch], runs: Callable[[pa.RecordBatch], Runs], text: str, buckets: int, budget: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, text, budget):
            found, ids = runs(part), part.column("node").to_numpy(zero_copy_only=False)
            held.append((found.anchor & SIEVED, ids[found.doc]))
            size += len(found.anchor)
            if size > FLUSH_ANCHORS:
                yield from _flush(*map(np.concatenate, zip(*held)), buckets)
                held, size = [], 0
    if size:
        yield from _flush(*map(np.concatenate, zip(*held)), buckets)


def _numbers(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a packed row and the numbers of their documents."""
    a = unpack(row["anchors"])
    return a, np.frombuffer(row["of"], dtype=f"u{len(row['of']) // len(a)}" if len(a) else "u1").astype(np.uint32)


def _repeats(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """A bucket's anchors that several documents have, packed by flush; lists of nodes pass through."""
    out, held, flushes = [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"]:
                out.append((row["flush"] % groups, row["kind"], row["flush"], row["anchors"],
                            row["of"] if row["kind"] == 2 else _numbers(row)[1].tobytes()))
            else:
                held.append((*_numbers(row), np.full(len(row["anchors"]) // 6, len(flushes), dtype=np.int32)))
                flushes.append(row["flush"])
    if held:
        anchors, of, flush = map(np.concatenate, zip(*held))
        held.clear()
        order = np.argsort(anchors, kind="stable")
        equal = anchors[order][1:] == anchors[order][:-1]
        many = np.sort(order[np.r_[False, equal] | np.r_[equal, False]])  # flush after flush again
        for f, at in by_doc(many, flush[many]):
            out.append((flushes[f] % groups, 0, flushes[f], pack(anchors[at]), of[at].tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
            pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["group", "kind", "flush", "anchors", "of"])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes: dict[int, np.ndarray] = {}
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in (r for b in batches for r in b.to_pylist()):
        if row["kind"] == 2:
            nodes[row["flush"]] = np.frombuffer(row["of"], dtype=np.int64)
        elif row["of"]:
            held.setdefault(row["flush"], []).append((unpack(row["anchors"]), np.frombuffer(row["of"], dtype=np.uint32)))
    for flush, rows in held.items():
        told = []
        for d, a in by_doc(*map(np.concatenate, zip(*rows))):
            told.append((int(nodes[flush][d]), pack(a)))
            if len(told) == 4096:
                yield _told(told)
                told = []
        yield _told(told)


def _told(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    d, a = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a, pa.binary())], names=["node", "anchors"])


def sieve(docs: DataFrame, runs: Callable[[pa.RecordBatch], Runs], text: str, budget: int) -> DataFrame:
    """(node, anchors): per document, a packed list of those of its anchors that other documents
    have too (and a few more, by chance)."""
    n = parts(docs.sparkSession)
    packed = docs.select("node", text).mapInArrow(
        lambda it: _anchors(it, runs, text, n, budget), "bucket int, kind int, flush long, anchors binary, of binary")
    found = packed.repartitionById(n, F.col("bucket")).mapInArrow(
        lambda it: _repeats(it, n), "group int, kind int, flush long, anchors binary, of binary")
    told = found.repartitionById(n, F.col("group")).mapInArrow(_by_document, "node long, anchors binary")
    return told.dropDuplicates(["node"])  # rows equal in id and text, met in several flushes, are told the same


def copies(docs: DataFrame, text: str) -> DataFrame:
    """(node, tag) of documents whose whole text a document with a smaller id has."""
    keyed = docs.select("doc", "node", "tag", F.sha2(text, 256).alias("key"))
    first = keyed.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    return keyed.join(first, "key").filter("doc > first").select("node", "tag").distinct()


def keyed(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """doc (order key), text, doc_id, and the columns to carry along as one struct, so that no name can
    clash. A row's address is (node, tag), 64 bits of its id and text and 32 more of the text: rows
    without an id, or of one id, are as spread as any others, and the id only says which is earlier."""
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    text = F.coalesce(text, F.lit(""))
    return docs.select(order_key("doc_id").alias("doc"), F.xxhash64(order_key("doc_id"), text).alias("node"),
                       F.hash(text).alias("tag"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       rest.alias("rest"))


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tight = zstandard.ZstdCompressor(level=9)
    for batch in batches:
        for part in slices(batch, "text"):
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "text", pa.array([tight.compress(x) for x in raw_texts(part)], pa.binary()))


def zipped(docs: DataFrame) -> DataFrame:
    """The documents with their texts compressed, for a shuffle."""
    fields = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(_zip, ", ".join(fields))


def unzipped(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Slices of a compressed shuffle's batches with their texts back, about ``budget`` bytes each."""
    loose = zstandard.ZstdDecompressor()
    for batch in batches:
        for part in slices(batch, "text", budget // 3):
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "text", pa.array([loose.decompress(x) for x in raw_texts(part)], pa.binary()))


def in_list(part: pa.RecordBatch, found: Runs) -> np.ndarray:
    """Which runs' anchors are in their document's packed list (column ``anchors``)."""
    out = np.zeros(len(found.doc), dtype=bool)
    cuts = np.searchsorted(found.doc, np.arange(part.num_rows + 1))
    for i, marked in enumerate(part.column("anchors").to_pylist()):
        if marked and cuts[i + 1] > cuts[i]:
            here = slice(cuts[i], cuts[i + 1])
            out[here] = np.isin(found.anchor[here] & SIEVED, unpack(marked))
    return out


def kept_value(kept: bytes, form: str) -> str | bytes:
    """What is left of a text: its SHA-256 (``digest``), its whole characters (``text``: parts of
    characters that a cut left are dropped) or its ``bytes``."""
    if form == "digest":
        return hashlib.sha256(kept).hexdigest()
    return kept.decode("utf-8", "ignore") if form == "text" else kept


def kept_field(form: str) -> tuple[str, str]:
    return {"digest": ("kept_sha256", "string"), "text": ("kept", "string"), "bytes": ("kept", "binary")}[form]


def result_schema(docs: DataFrame, counts: list[str], form: str) -> str:
    """DDL of a rebuilt document; the carried columns come as ``rest``."""
    rest = docs.schema["rest"].dataType.simpleString()
    return f"doc_id long, {', '.join(f'{c} long' for c in counts)}, {' '.join(kept_field(form))}, rest {rest}"


def spans_of(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Mask of the places that the spans cover."""
    depth = np.zeros(size + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth[:-1]) > 0


def rejoin(docs: DataFrame, removed: DataFrame, whole: DataFrame) -> DataFrame:
    """Documents with their removed spans (start, n windows; or ``spans``, some of them in an array) and whether
    all is removed. Rows equal in id and text have the same spans: a set, so that many such rows do
    not multiply them."""
    several = F.array_distinct(F.flatten(F.collect_set("spans"))) if "spans" in removed.columns else F.collect_set(F.struct("start", "n"))
    spans = removed.groupBy("node", "tag").agg(several.alias("spans"))
    told = spans.join(whole.select("node", "tag", F.lit(True).alias("whole")), ["node", "tag"], "full_outer")
    return zipped(docs).join(told, ["node", "tag"], "left").select("doc_id", "text", "rest", "spans", "whole")
