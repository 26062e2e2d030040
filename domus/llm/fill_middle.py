"""Fill-in-the-middle rearrangement over a learned rank index of token boundaries.

A text's units are runs of ASCII letters and single other code points. The code point offsets
of all unit boundaries (rank 0 to n) are an ascending sequence. Straight segments are fitted to
it: a segment that misses a boundary by more than ``BOUND`` code points is halved, until every
one holds; what remains of each boundary is stored as one signed byte. A cut at rank r is
predicted by the segment that holds r and corrected by r's residual, which is exact.

The seeds of a document come from the sha256 of ``1:`` and its id, so the result does not depend
on order, partitioning or reruns. Everything is one narrow map, texts are handled in slices of
bounded size, and a very long text is fitted in pieces.

Defined results: null and empty texts are plain, with 0 units and an empty output. A text that
contains a marker is plain. A null id is hashed as ``1:`` alone. Rows are independent, so repeated
rows get equal results. The general operator keeps the columns it is told to keep in a struct,
so that their names cannot clash; the others are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import slices

BOUND = 127  # code points that a segment may miss a boundary by: residuals are signed bytes
PIECE = 1 << 16  # ranks that one segment may hold at first
FIT_AT_ONCE = 1 << 20  # boundaries fitted together
SLICE = 1 << 20
# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = ("plain", "psm", "spm")


class RankIndex:
    """Segments (first rank, value there, slope) and byte residuals of ascending sequences laid
    end to end; ``at`` gives the value of any rank."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, bound: int = BOUND):
        """``starts``: where each sequence begins in ``values``; no segment crosses one."""
        ends = np.r_[starts[1:], len(values)]
        cut = [np.arange(lo, hi, PIECE) for lo, hi in zip(starts.tolist(), ends.tolist())]
        first = np.concatenate(cut) if cut else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(values)]
        self.residual = np.zeros(len(values), dtype=np.int8)
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        batch = np.cumsum(last - first) // FIT_AT_ONCE
        for b in np.unique(batch):
            self._fit(values, first[batch == b], last[batch == b], bound, kept)
        self.first = np.concatenate([k[0] for k in kept]) if kept else np.zeros(0, np.int64)
        order = np.argsort(self.first)
        self.first = self.first[order]
        self.base, self.slope = (np.concatenate([k[i] for k in kept])[order] if kept else np.zeros(0) for i in (1, 2))

    def _fit(self, values: np.ndarray, first: np.ndarray, last: np.ndarray, bound: int, kept: list) -> None:
        while len(first):
            size = last - first
            opens = np.cumsum(size) - size
            of = np.repeat(np.arange(len(first)), size)
            step = np.arange(int(size.sum())) - opens[of]
            rank = first[of] + step
            low = values[first].astype(np.int64)
            slope = (values[last - 1] - low) / np.maximum(size - 1, 1)
            miss = values[rank] - low[of] - np.rint(slope[of] * step).astype(np.int64)
            least, most = np.minimum.reduceat(miss, opens), np.maximum.reduceat(miss, opens)
            middle = (least + most) // 2
            holds = np.maximum(most - middle, middle - least) <= bound
            good = holds[of]
            self.residual[rank[good]] = (miss - middle[of])[good]
            kept.append((first[holds], (low + middle)[holds], slope[holds]))
            lo, hi = first[~holds], last[~holds]
            half = (lo + hi) // 2
            first, last = np.r_[lo, half], np.r_[half, hi]

    def at(self, rank: np.ndarray) -> np.ndarray:
        """Exact values at ``rank``: predicted by the segment, corrected by the residual."""
        of = np.searchsorted(self.first, rank, side="right") - 1
        guess = self.base[of] + np.rint(self.slope[of] * (rank - self.first[of])).astype(np.int64)
        return guess.astype(np.int64) + self.residual[rank]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All unit boundaries of every text as code point offsets, text after text (0 and the
    text's length included), and where each text's boundaries begin."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    low = codes | np.uint32(32)
    letter = (low >= 97) & (low <= 122)
    ends = np.ones(len(codes), dtype=bool)  # does a unit end after this code point?
    ends[:-1] = ~(letter[:-1] & letter[1:])
    opens = np.cumsum(size) - size
    ends[(opens + size - 1)[size > 0]] = True
    last = np.flatnonzero(ends)
    of = np.searchsorted(opens + size, last, side="right")  # empty texts own nothing
    begins = np.cumsum(np.r_[0, np.bincount(of, minlength=len(texts))[:-1] + 1]) if texts else np.zeros(0, np.int64)
    values = np.zeros(len(last) + len(texts), dtype=np.int64)
    values[np.arange(len(last)) + of + 1] = last + 1 - opens[of]
    return values, begins


def seeds(doc_id: int | None) -> list[int]:
    """The first four unsigned 32-bit numbers of the sha256 of ``1:`` and the decimal id."""
    raw = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(raw[i:i + 4], "big") for i in range(0, 16, 4)]


def rearranged(ids: list[int | None], texts: list[str], rate: int, spm: int) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of every text."""
    values, begins = boundaries(texts)
    index = RankIndex(values, begins)
    n = np.diff(np.r_[begins, len(values)]) - 1
    seed = [seeds(i) for i in ids]
    ends = np.array([sorted((h[0] % (k + 1), h[1] % (k + 1))) for h, k in zip(seed, n.tolist())], dtype=np.int64).reshape(-1, 2)
    cuts = index.at(begins[:, None] + ends).tolist()
    for h, k, (a, b), text in zip(seed, n.tolist(), cuts, texts):
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= rate:
            yield k, "plain", None, None, text
        elif h[3] % 100 < spm:
            yield k, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
        else:
            yield k, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


OUTPUT = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
          T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())


def _transform(batches: Iterator[pa.RecordBatch], rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            ids = part.column("id").to_pylist()
            texts = [t or "" for t in part.column("text").to_pylist()]
            rows = list(zip(*rearranged(ids, texts, rate, spm)))
            made = [pa.array(c, t) for c, t in zip(rows, _TYPES)]
            yield pa.RecordBatch.from_arrays([part.column("kept"), *made],
                                             names=["kept", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   rate: int = 90, spm: int = 20) -> DataFrame:
    """kept (a struct of the columns ``keep``, by default the id), n units, form, prefix_chars,
    middle_chars and the output text. ``rate`` of 100 texts are rearranged, ``spm`` of 100 of
    them suffix first."""
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or [doc_id]]).alias("kept"),
                        F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return frame.mapInArrow(lambda it: _transform(it, rate, spm), T.StructType([frame.schema["kept"], *OUTPUT]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. A marker found in an output is the inserted one:
    texts with markers stay plain, and no marker can overlap another."""
    def after(t: Column, n) -> Column:
        return F.substring(t, F.lit(n) if isinstance(n, int) else n, F.lit(1 << 30))

    def parted(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = after(output, len(first) + 1)
        head = F.substring_index(rest, second, 1)
        tail = after(rest, F.length(head) + len(second) + 1)
        inner = F.substring_index(tail, MIDDLE, 1)
        return head, inner, after(tail, F.length(inner) + len(MIDDLE) + 1)

    head, inner, last = parted(PREFIX, SUFFIX)
    psm = F.concat(head, last, inner)
    head, inner, last = parted(SUFFIX, PREFIX)
    spm = F.concat(inner, last, head)
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)
