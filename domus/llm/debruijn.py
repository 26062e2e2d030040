"""Substring deduplication over words by a compacted De Bruijn graph of repeated k-mers.

A k-mer of ``WIDTH`` words is an edge. Edges that follow each other under one anchor are
compacted where they are read (:mod:`domus.llm.spans`); of these paths only those whose
anchor other documents have too are kept. Spark joins then compact further: where an anchor
has one path, the graph does not branch, and all occurrences but the first go as a whole;
where it branches, equal paths are settled the same way, and only the first occurrence of
each different path is opened into its edges, which settle one by one. Whole copies of a
document are settled by its digest. The source coordinates of settled paths are spans of
words; a word goes if a k-mer over it starts earlier (in a document with a smaller id, or in
the same one before).

Paths are equal when the 64-bit hashes of both anchor and content are.

Defined results: null and empty texts, and those with fewer words than a k-mer, lose
nothing to others. Rows that share an id (or have none) never take from one another; rows
without an id come last. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import RangeHashes, WordHashes, hash_words, raw_texts, store
from domus.llm.spans import Runs, copies, in_list, kept_field, kept_value, keyed, rejoin, result_schema, sieve, spans_of, unzipped, zipped

WIDTH = 20
ANCHOR = 6
SLICE = 1 << 20
COUNTS = ["n_words", "n_removed"]
PATHS = "node long, doc long, tag int, m long, c long, start int, n int, edges binary"


def _symbols(part: pa.RecordBatch, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    words = [t.split() for t in raw_texts(part)]
    return hash_words(list(chain.from_iterable(words)), hashes), np.array([len(w) for w in words], dtype=np.int64)


def word_runs(width: int, k: int):
    """Reader of a slice's runs; its word cache lives as long as the task."""
    hashes = WordHashes()
    return lambda part: Runs(*_symbols(part, hashes), width, k)


def _paths(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    runs = word_runs(width, k)
    for part in unzipped(batches, SLICE):
        r = runs(part)
        at = np.flatnonzero(in_list(part, r))
        if not len(at):
            continue
        content = r.hashes.of(r.start[at], r.start[at] + r.n[at] + width - 1)
        # a document's later occurrences of a path go by the first one, when it is rebuilt
        order = np.lexsort((at, content, r.anchor[at], r.doc[at]))
        later = (np.diff(r.doc[at][order]) == 0) & (r.anchor[at][order][1:] == r.anchor[at][order][:-1]) \
            & (content[order][1:] == content[order][:-1])
        first = np.sort(order[np.r_[True, ~later]])
        at, content = at[first], content[first]
        start, n, doc = r.start[at], r.n[at], r.doc[at]
        edges = r.hashes.windows(width)
        yield pa.RecordBatch.from_arrays(
            [*(part.column(x).take(pa.array(doc)) for x in ("node", "doc", "tag")),
             pa.array(r.anchor[at].view(np.int64)), pa.array(content.view(np.int64)),
             pa.array((start - r.offsets[doc]).astype(np.int32)), pa.array(n.astype(np.int32)),
             pa.array([edges[s:s + c].tobytes() for s, c in zip(start.tolist(), n.tolist())], pa.binary())],
            names=["node", "doc", "tag", "m", "c", "start", "n", "edges"])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths into edges: node, doc, tag, m, h, start."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        at = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        h = np.frombuffer(b"".join(batch.column("edges").to_pylist()), dtype=np.int64)
        row = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(row) for c in ("node", "doc", "tag", "m")), pa.array(h),
             pa.array((batch.column("start").to_numpy()[at] + inner).astype(np.int32))], names=["node", "doc", "tag", "m", "h", "start"])


def repeated_paths(docs: DataFrame, whole: DataFrame, width: int, k: int) -> DataFrame:
    """node, tag, start, n: runs of k-mers that a document with a smaller id has."""
    marks = sieve(docs, word_runs(width, k), "text", SLICE)
    near = zipped(docs.select("node", "doc", "tag", "text")).join(marks, "node").join(whole, ["node", "tag"], "left_anti") \
        .select("node", "doc", "tag", "text", "anchors")
    paths = store(near.mapInArrow(lambda it: _paths(it, width, k), PATHS), "paths")
    # aggregates are written before they are joined: Spark splits a skewed join only between plain exchanges
    nodes = store(paths.groupBy("m").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("doc").alias("first"),
                                         F.max("doc").alias("last")).filter("first < last"), "nodes")
    met = store(paths.join(nodes, "m"), "met")
    straight = met.filter("low = high AND doc > first").select("node", "tag", "start", "n")
    branching = met.filter("low <> high").drop("low", "high", "first", "last")
    firsts = store(branching.groupBy("m", "c").agg(F.min("doc").alias("first")), "firsts")
    settled = store(branching.join(firsts, ["m", "c"]), "settled")
    equal = settled.filter("doc > first").select("node", "tag", "start", "n")
    opened = settled.filter("doc = first").select("node", "doc", "tag", "m", "start", "n", "edges") \
        .mapInArrow(_open, "node long, doc long, tag int, m long, h long, start int")
    least = store(opened.groupBy("m", "h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                  .filter("first < last"), "edges")
    single = opened.join(least, ["m", "h"]).filter("doc > first").select("node", "tag", "start", F.lit(1).alias("n"))
    return straight.union(equal).union(single)


def _rebuild(batches: Iterator[pa.RecordBatch], width: int, form: str) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in unzipped(batches, SLICE):
        out = []
        rows = zip(*(part.column(c).to_pylist() for c in ("spans", "whole")))
        for text, (spans, whole) in zip(raw_texts(part), rows):
            words = text.split()
            gone = np.zeros(len(words), dtype=bool)
            if len(words) >= width:
                if whole:
                    gone[:] = True
                else:
                    h = RangeHashes(hash_words(words, hashes)).windows(width)
                    order = np.argsort(h, kind="stable")
                    again = order[1:][h[order[1:]] == h[order[:-1]]]
                    mine = [(s["start"], s["n"]) for s in spans or ()]
                    start, n = np.array(mine, dtype=np.int64).reshape(-1, 2).T
                    gone = spans_of(np.r_[again, start], np.r_[np.full(len(again), width), n + width - 1], len(words))
            kept = b" ".join(compress(words, (~gone).tolist()))
            out.append((len(words), int(gone.sum()), kept_value(kept, form)))
        n, removed, last = zip(*out)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(last),
                                          part.column("rest")], names=["doc_id", *COUNTS, kept_field(form)[0], "rest"])


def deduplicate(docs: DataFrame, text: str = "text", width: int = WIDTH, k: int = ANCHOR, form: str = "text",
                carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by spaces in the form asked for
    (``digest``, ``text`` or ``bytes``), and the columns to ``carry`` as a struct ``rest``."""
    docs = keyed(docs, text, carry or [])
    whole = store(copies(docs, "text"), "copies")
    removed = repeated_paths(docs, whole, width, k)
    out = rejoin(docs, removed, whole).mapInArrow(lambda it: _rebuild(it, width, form), result_schema(docs, COUNTS, form))
    return out if carry else out.drop("rest")
