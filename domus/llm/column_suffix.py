"""Substring deduplication over bytes by column-wise suffix sorting of many short pieces.

Documents are cut into pieces, the runs of windows that share an anchor
(:mod:`domus.llm.spans`); only pieces whose anchor other documents have too enter. All
pieces of an anchor meet in one task, laid out with the anchor in one column, so that equal
windows start in one column. The construction inserts one symbol per piece each round, from
the last column to the first: the order of the suffixes that begin in a column is a stable
regrouping, by that column's symbols, of the order of the column after it, and the common
prefixes of neighbours follow from the least value between them. The symbols in the order
of the next column are that column's part of the collection's Burrows-Wheeler transform.
Neighbours with a common prefix of a window's width hold the same window; the least id
among them is its first document.

A round keeps its columns in bounded arrays of the task, read and written in order, instead
of files: a task holds some thousand anchors' different pieces at a time, and equal pieces
were merged before, their places packed. An anchor with more than ``HOT`` pieces is not sorted by one task: its windows
are grouped by their bytes, all of them. Whole copies of a document are settled by its digest.

Defined results: null and empty texts, and those shorter than a window, lose nothing. Rows
that share an id (or have none) never take from one another; rows without an id come last.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import RangeHashes, mix, parts, raw_texts, store
from domus.llm.spans import Runs, copies, in_list, kept_field, kept_value, keyed, rejoin, result_schema, sieve, spans_of, unzipped, zipped

WIDTH = 50
ANCHOR = 20
SLICE = 1 << 18  # bytes of text whose windows are held at once
MERGED = 1 << 20  # bytes of text whose equal pieces are merged before they are written
COUNTS = ["n_bytes", "n_removed", "n_spans"]
CHUNK = 40_000  # pieces sorted together, whole anchors
HOT = CHUNK  # pieces of an anchor beyond which its windows are grouped by Spark
PIECES = "slice long, node long, doc long, tag int, m long, c long, start int, n int, left int, many boolean, piece binary, others binary"
PLACE = np.dtype([("node", "<i8"), ("doc", "<i8"), ("tag", "<i4"), ("start", "<i4")])  # an occurrence of a piece
SPANS = "node long, tag int, spans array<struct<start:int,n:int>>"
_CODE = mix(np.arange(1, 257, dtype=np.uint64))


def byte_runs(width: int, k: int):
    def read(part: pa.RecordBatch) -> Runs:
        raw = raw_texts(part)
        return Runs(_CODE[np.frombuffer(b"".join(raw), dtype=np.uint8)], np.array([len(t) for t in raw], dtype=np.int64), width, k)

    return read


def _pieces(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Pieces of marked anchors; the equal pieces of some slices (``MERGED`` bytes of text) are one row, that of
    the least document, with the places of the others (``others``; ``many`` tells that there are some)."""
    runs, held, size = byte_runs(width, k), [], 0

    def merged() -> pa.RecordBatch:
        m, c, doc, start, n, left, node, tag = (np.concatenate(x) for x in zip(*[h[:8] for h in held]))
        pieces = [x for h in held for x in h[8]]
        order = np.lexsort((doc, m, c))
        head = np.flatnonzero(np.r_[True, (c[order][1:] != c[order][:-1]) | (m[order][1:] != m[order][:-1])])
        place = np.empty(len(m), dtype=PLACE)
        for name, column in (("node", node), ("doc", doc), ("tag", tag), ("start", start)):
            place[name] = column[order]
        others = [place[lo + 1:hi].tobytes() or None for lo, hi in zip(head.tolist(), [*head[1:].tolist(), len(m)])]
        at = order[head]
        name = np.full(len(at), xxhash.xxh3_64_intdigest(place.tobytes()) >> 1, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, (name, node[at], doc[at], tag[at], m[at].view(np.int64), c[at].view(np.int64), start[at], n[at], left[at])),
             pa.array([x is not None for x in others]), pa.array([pieces[i] for i in at.tolist()], pa.binary()), pa.array(others, pa.binary())],
            names=["slice", "node", "doc", "tag", "m", "c", "start", "n", "left", "many", "piece", "others"])

    for part in unzipped(batches, SLICE):
        r = runs(part)
        at = np.flatnonzero(in_list(part, r))
        flat = b"".join(raw_texts(part))
        size += len(flat)
        if len(at):
            start, n, doc = r.start[at], r.n[at], r.doc[at]
            piece = [flat[s:s + c + width - 1] for s, c in zip(start.tolist(), n.tolist())]
            held.append((r.anchor[at], r.hashes.of(start, start + n + width - 1), part.column("doc").to_numpy()[doc],
                         (start - r.offsets[doc]).astype(np.int32), n.astype(np.int32), (r.place[at] - start).astype(np.int32),
                         part.column("node").to_numpy()[doc], part.column("tag").to_numpy()[doc], piece))
        if size >= MERGED:
            if held:
                yield merged()
            held, size = [], 0
    if held:
        yield merged()


def first_documents(group: np.ndarray, left: np.ndarray, n: np.ndarray, doc: np.ndarray, pieces: list[bytes],
                    width: int, k: int) -> np.ndarray:
    """For every window of every piece, the least doc that has this window (pieces x windows).

    ``group`` numbers the anchors in ascending row order; ``left`` is the anchor's place in its
    piece, which all equal windows share once anchors are put in one column.
    """
    rows, lead = len(pieces), width - k  # a window begins at most ``lead`` before its anchor
    columns = lead + width
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    table = np.full((rows, columns), -1, dtype=np.int16)
    row = np.repeat(np.arange(rows), size)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    table[row, inner + np.repeat(lead - left, size)] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    out = np.full((rows, lead + 1), np.iinfo(np.int64).max)
    order, common = np.arange(rows), np.zeros(rows, dtype=np.int64)  # common[i]: prefix shared by order[i-1], order[i]
    for column in range(columns - 1, -1, -1):
        symbol = table[order, column]
        transform = group[order] * 257 + symbol + 1  # this column's symbols in the next column's order
        move = np.argsort(transform, kind="stable")
        order, key = order[move], transform[move]
        joined = np.flatnonzero((key[1:] == key[:-1]) & (symbol[move][1:] >= 0))
        fresh = np.zeros(rows, dtype=np.int64)
        if len(joined):
            # least common prefix between the two places in the old order
            bounds = np.empty(2 * len(joined), dtype=np.int64)
            bounds[0::2], bounds[1::2] = move[joined] + 1, move[joined + 1] + 1
            low = np.minimum.reduceat(np.r_[common, 0], bounds)[0::2]
            fresh[joined + 1] = np.minimum(low + 1, width)
        common = fresh
        if column <= lead:
            window = column - (lead - left[order])
            has = (window >= 0) & (window < n[order])
            starts = np.flatnonzero(common < width)
            least = np.minimum.reduceat(doc[order], starts)
            least = np.repeat(least, np.diff(np.r_[starts, rows]))
            out[order[has], window[has]] = least[has]
    return out


SETTLED = "node long, tag int, start int, n int, m long, c long, first binary"


def _removed(first: np.ndarray, doc: np.ndarray, node: pa.Array, tag: pa.Array, start: np.ndarray, n: np.ndarray) -> dict[str, pa.Array]:
    """Runs of windows whose first document (``first``, all rows' windows end to end) is earlier."""
    row = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    hit = np.flatnonzero(first < doc[row])
    head = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])]) if len(hit) else hit
    of = row[hit[head]]
    return {"node": node.take(pa.array(of)), "tag": tag.take(pa.array(of)),
            "start": pa.array((start[of] + inner[hit[head]]).astype(np.int32)),
            "n": pa.array(np.diff(np.r_[head, len(hit)]).astype(np.int32))}


def _settle(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``part``, which all rows of an anchor share. Emits the runs of windows to remove from the rows' own documents
    and, for pieces with ``many``, the first documents of their windows (m, c, first)."""
    held: list[pa.RecordBatch] = []

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        pieces = rows.column("piece").to_pylist()
        doc, (n, left) = rows.column("doc").to_numpy(), (rows.column(x).to_numpy().astype(np.int64) for x in ("n", "left"))
        # anchor and content hashes come from the bytes again, so that they need no shuffle
        hashes = RangeHashes(_CODE[np.frombuffer(b"".join(pieces), dtype=np.uint8)])
        end = np.cumsum(n + width - 1)
        begin = end - (n + width - 1)
        m, c = hashes.of(begin + left, begin + left + k).view(np.int64), hashes.of(begin, end).view(np.int64)
        order = np.lexsort((doc, c, m))
        new = np.r_[True, (m[order][1:] != m[order][:-1]) | (c[order][1:] != c[order][:-1])]
        at = order[new]  # one row per different piece: its least document
        which = np.empty(len(m), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        group = np.cumsum(np.r_[True, m[at][1:] != m[at][:-1]]) - 1
        first = first_documents(group, left[at], n[at], doc[at], [pieces[i] for i in at.tolist()], width, k)
        flat = first[which][np.arange(first.shape[1]) < n[:, None]]
        gone = _removed(flat, doc, rows.column("node").combine_chunks(), rows.column("tag").combine_chunks(), rows.column("start").to_numpy(), n)
        size = len(gone["node"])
        told = np.unique(which[rows.column("many").to_numpy(zero_copy_only=False)])
        rest = {"m": pa.nulls(size, pa.int64()), "c": pa.nulls(size, pa.int64()), "first": pa.nulls(size, pa.binary())}
        yield pa.RecordBatch.from_pydict({**gone, **rest})
        none = pa.nulls(len(told), pa.int32())
        yield pa.RecordBatch.from_pydict({
            "node": pa.nulls(len(told), pa.int64()), "tag": pa.nulls(len(told), pa.int32()), "start": none, "n": none, "m": pa.array(m[at][told]), "c": pa.array(c[at][told]),
            "first": pa.array([first[i, :w].tobytes() for i, w in zip(told.tolist(), n[at][told].tolist())], pa.binary())})

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            rows = pa.Table.from_batches(held)
            part = rows.column("part").to_numpy()
            cut = int(np.searchsorted(part, part[-1]))  # the last anchors may go on in the next batch
            if cut:
                yield from done(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
    if held:
        yield from done(pa.Table.from_batches(held))


def _united(node: np.ndarray, tag: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Runs of windows as one row per document, those that touch as one run."""
    order = np.lexsort((start, tag, node))
    node, tag, start, n = node[order], tag[order], start[order].astype(np.int64), n[order].astype(np.int64)
    new = np.r_[True, (node[1:] != node[:-1]) | (tag[1:] != tag[:-1])][:len(node)]
    base = np.cumsum(new) << 32  # documents apart, so that the farthest end so far is the document's own
    reach = np.maximum.accumulate(base + start + n)
    head = np.flatnonzero(np.r_[True, (base + start)[1:] > reach[:-1]][:len(node)] | new)
    last = np.r_[head[1:], len(node)] - 1
    spans = pa.StructArray.from_arrays([pa.array(start[head].astype(np.int32)), pa.array((reach[last] - (base + start)[head]).astype(np.int32))],
                                       names=["start", "n"])
    first = np.flatnonzero(new)
    offsets = np.r_[np.searchsorted(head, first), len(head)].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(node[first]), pa.array(tag[first]), pa.ListArray.from_arrays(pa.array(offsets), spans)],
                                      names=["node", "tag", "spans"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``slice``: pieces with their windows' first documents (n, first) and places (``others``, and
    one of their own if ``node`` is given). One row per document of a slice: its runs of windows to remove."""
    at, held = None, []

    def done() -> pa.RecordBatch:
        return _united(*map(np.concatenate, zip(*held)))

    for batch in batches:
        cols = [batch.column(x).to_pylist() for x in ("slice", "n", "first", "others", "node", "doc", "tag", "start")]
        for name, n, first, others, *own in zip(*cols):
            if name != at:
                if held:
                    yield done()
                at, held = name, []
            place = np.frombuffer(others or b"", dtype=PLACE)
            if own[0] is not None:
                place = np.r_[place, np.array([tuple(own)], dtype=PLACE)]
            gone = np.frombuffer(first, dtype=np.int64)[None, :] < place["doc"][:, None]
            edge = np.diff(gone.astype(np.int8), axis=1, prepend=0, append=0)
            (row, lo), (_, hi) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            if len(row):
                held.append((place["node"][row], place["tag"][row], place["start"][row] + lo, hi - lo))
    if held:
        yield done()


def _open(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Contents (m, c, n, piece, least doc) into their windows' bytes: m, c, i, window, doc."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        pieces = batch.column("piece").to_pylist()
        window = [pieces[r][k:k + width] for r, k in zip(row.tolist(), i.tolist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(x).take(pa.array(row)) for x in ("m", "c")), pa.array(i, pa.int32()),
                                          pa.array(window, pa.binary()), batch.column("doc").take(pa.array(row))],
                                         names=["m", "c", "i", "window", "doc"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first = [np.array(x, dtype=np.int64).tobytes() for x in batch.column("firsts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("m"), batch.column("c"), pa.array(first, pa.binary())], names=["m", "c", "first"])


def hot_contents(rows: DataFrame, width: int) -> DataFrame:
    """m, c, first: the first documents of the windows of every different content of anchors too frequent
    for one task. Their windows are grouped by their bytes, so that Spark spreads an anchor."""
    contents = rows.groupBy("m", "c").agg(F.min("doc").alias("doc"), F.max("piece").alias("piece"), F.max("n").alias("n"))
    opened = store(contents.mapInArrow(lambda it: _open(it, width), "m long, c long, i int, window binary, doc long"), "hot-windows")
    least = store(opened.groupBy("window").agg(F.min("doc").alias("first")), "hot-firsts")
    told = opened.join(least, "window").groupBy("m", "c").agg(F.sort_array(F.collect_list(F.struct("i", "first"))).alias("w"))
    return told.select("m", "c", F.col("w.first").alias("firsts")).mapInArrow(_packed, "m long, c long, first binary")


def repeated_windows(docs: DataFrame, whole: DataFrame, width: int, k: int, hot: int = HOT) -> DataFrame:
    """node, tag, spans (start, n): runs of windows that a document with a smaller id has."""
    marks = sieve(docs, byte_runs(width, k), "text", SLICE)
    near = zipped(docs.select("node", "doc", "tag", "text")).join(marks, "node").join(whole, ["node", "tag"], "left_anti") \
        .select("node", "doc", "tag", "text", "anchors")
    pieces = store(near.mapInArrow(lambda it: _pieces(it, width, k), PIECES), "pieces")
    frequent = store(pieces.groupBy("m").agg(F.count("*").alias("times")).filter(F.col("times") > hot)
                     .select("m"), "hot-anchors")
    none = frequent.isEmpty()  # mostly so: then there is nothing to leave out here, nor to group below
    usual = pieces if none else pieces.join(frequent, "m", "left_anti")
    dealt = (usual.select(F.shiftright("m", 32).cast("int").alias("part"), "node", "doc", "tag", "start", "n", "left", "many", "piece")
             .repartition(parts(docs.sparkSession), "part").sortWithinPartitions("part"))
    settled = store(dealt.mapInArrow(lambda it: _settle(it, width, k), SETTLED), "settled")
    others = usual.filter("many").select("slice", "m", "c", "n", "others")
    met = others.join(settled.filter("first IS NOT NULL").select("m", "c", "first"), ["m", "c"])
    met = met.select("slice", "n", "first", "others", *[F.lit(None).cast(t).alias(x) for x, t in (("node", "long"), ("doc", "long"), ("tag", "int"), ("start", "int"))])
    if not none:
        often = pieces.join(frequent, "m").select("slice", "node", "doc", "tag", "m", "c", "start", "n", "piece", "others")
        met = met.unionByName(often.drop("piece").join(store(hot_contents(often, width), "hot-contents"), ["m", "c"]).select(*met.columns))
    more = (met
            .repartition(parts(docs.sparkSession), "slice").sortWithinPartitions("slice").mapInArrow(_windows, SPANS))
    own = F.array(F.struct("start", "n")).cast("array<struct<start:int,n:int>>").alias("spans")
    return settled.filter("first IS NULL").select("node", "tag", own).union(more)


def _rebuild(batches: Iterator[pa.RecordBatch], width: int, form: str) -> Iterator[pa.RecordBatch]:
    for part in unzipped(batches, SLICE):
        out = []
        rows = zip(*(part.column(c).to_pylist() for c in ("spans", "whole")))
        for text, (spans, whole) in zip(raw_texts(part), rows):
            gone = np.zeros(len(text), dtype=bool)
            if whole and len(text) >= width:
                gone[:] = True
            elif spans:
                mine = np.array([(s["start"], s["n"]) for s in spans], dtype=np.int64).reshape(-1, 2)
                gone = spans_of(mine[:, 0], mine[:, 1] + width - 1, len(text))
            removed = int(gone.sum())
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if removed else text
            ends = np.count_nonzero(np.diff(np.r_[0, gone.view(np.int8)]) == 1) if removed else 0
            out.append((len(text), removed, ends, kept_value(kept, form)))
        size, removed, ends, last = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(ends, pa.int64()),
             pa.array(last, kept_field(form)[1]), part.column("rest")], names=["doc_id", *COUNTS, kept_field(form)[0], "rest"])


def deduplicate(docs: DataFrame, text: str = "text", width: int = WIDTH, k: int = ANCHOR, form: str = "bytes",
                carry: list[str] | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and what is kept in the form asked for (``digest``,
    ``text`` or ``bytes``), and the columns to ``carry`` as a struct ``rest``."""
    docs = keyed(docs, text, carry or [])
    whole = store(copies(docs, "text"), "copies")
    removed = repeated_windows(docs, whole, width, k, hot)
    out = rejoin(docs, removed, whole).mapInArrow(lambda it: _rebuild(it, width, form), result_schema(docs, COUNTS, form))
    return out if carry else out.drop("rest")
