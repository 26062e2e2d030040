"""Token counts by rank-synchronous merging of ragged numpy arrays.

A batch's distinct pre-tokens are held as one flat array of symbols plus sequence starts.
Each round finds every sequence's lowest-rank adjacent pair and applies that pair at all its
places in the sequence at once (left to right where places overlap); sequences without a
mergeable pair leave. What survives is counted. In pre-tokens of more than ``LONG`` bytes a round
looks only at the places that the one before changed, so that time follows their length. Counts equal the ``tokenizers`` library on
the same ``.json`` file, with the file's special strings matched in texts as it does by
default (one token each).

Defined results: a null or empty text has 0 bytes and 0 tokens. Rows are independent, so
repeated rows get equal counts; extra columns are ignored; no length limit applies.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from domus.llm.common import raw_texts, slices, tokenizer_path

# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, n_bytes long, n_tokens long"
MAX_CACHED = 200_000
LONG = 512  # bytes of a pre-token beyond which a round looks only at the places that change
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> dict[int, str]:
    """byte -> printable character: printable Latin-1 bytes stand for themselves, the others
    take code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Merges:
    """The vocabulary of a byte-level BPE ``.json`` as arrays: sorted pair keys -> rank, new id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.byte_ids = np.array([vocab[c] for _, c in sorted(byte_alphabet().items())], dtype=np.int64)
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made, self.by_rank = key[order], order, made[order], made
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where no merge) and slot of every pair."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), at

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols each piece ends with."""
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        out, long = np.zeros(len(pieces), dtype=np.int64), size > LONG
        for rows, of in ((np.flatnonzero(~long), self._count_short), (np.flatnonzero(long), self._count_long)):
            if len(rows):
                out[rows] = of([pieces[i] for i in rows.tolist()])
        return out

    def _count_long(self, pieces: list[bytes]) -> np.ndarray:
        """The same for long sequences: symbols are linked, and a round looks only at the places of the
        lowest rank and at their neighbours, whose ranks it updates. The lowest rank of all
        sequences is the lowest of every sequence that has it."""
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner, out = np.repeat(np.arange(len(pieces)), size), size.copy()
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        after[np.cumsum(size) - 1] = -1
        before[np.cumsum(size) - size] = -1
        rank = np.full(len(symbols), NONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def renew(at: np.ndarray) -> None:
            """Ranks of the pairs that begin at these places."""
            rank[at] = NONE
            at = at[after[at] >= 0]
            rank[at] = self.lookup(symbols[at], symbols[after[at]])[0]
            at = at[rank[at] < NONE]
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1) if len(at) else ():
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(part)

        renew(np.arange(len(symbols)))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # places that overlap: keep every second of a run of neighbours
            fresh = np.r_[True, after[at[:-1]] != at[1:]]
            depth = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[depth % 2 == 0]
            gone = after[at]
            symbols[at], rank[gone] = self.by_rank[r], NONE
            after[at] = after[gone]
            follows = after[at] >= 0
            before[after[at][follows]] = at[follows]
            out -= np.bincount(owner[at], minlength=len(out))
            left = before[at]
            renew(np.unique(np.r_[at, left[left >= 0]]))
        return out

    def _count_short(self, pieces: list[bytes]) -> np.ndarray:
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        out = size.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), size)
        while len(symbols) > 1:
            inside = owner[1:] == owner[:-1]
            rank, slot = self.lookup(symbols[:-1], symbols[1:])
            rank = np.where(inside, rank, NONE)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            low = np.minimum.reduceat(np.r_[rank, NONE], starts)  # the last symbol of a sequence has NONE
            active = np.repeat(low < NONE, np.diff(np.r_[starts, len(symbols)]))
            if not active.any():
                break
            lowest = np.repeat(low, np.diff(np.r_[starts, len(symbols)]))[:-1]
            hit = (rank == lowest) & (rank < NONE)
            # places that overlap: keep every second of a run of neighbours
            run = np.flatnonzero(hit)
            fresh = np.r_[True, np.diff(run) > 1]
            depth = np.arange(len(run)) - np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
            at = run[depth % 2 == 0]
            symbols[at] = self.made[slot[at]]
            keep = active
            keep[at + 1] = False
            out -= np.bincount(owner[at], minlength=len(out))
            symbols, owner = symbols[keep], owner[keep]
        return out


@functools.lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def count_batches(batches: Iterator[pa.RecordBatch], path: str, text: str = "text") -> Iterator[pa.RecordBatch]:
    table, split, known = merges(path), regex.compile(PATTERN), {}
    for batch in batches:
        for part in slices(batch, text):
            raw = raw_texts(part, text)
            docs, counts = [], np.zeros(len(raw), dtype=np.int64)
            for i, data in enumerate(raw):
                whole = data.decode("utf-8")
                if table.special is not None and table.special.search(whole):
                    pieces = table.special.split(whole)
                    counts[i] += len(pieces) - 1
                    docs.append([t for p in pieces for t in split.findall(p)])
                else:
                    docs.append(split.findall(whole))
            if len(known) > MAX_CACHED:
                known.clear()
            new = list(set().union(*docs) - known.keys())
            if new:
                known.update(zip(new, table.count([t.encode() for t in new]).tolist()))
            for i, tokens in enumerate(docs):
                counts[i] += sum(map(known.__getitem__, tokens))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in raw], pa.int64()), pa.array(counts)],
                names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document. One narrow map, no shuffle."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    return docs.select("doc_id", text).mapInArrow(lambda it: count_batches(it, path, text), SCHEMA)
