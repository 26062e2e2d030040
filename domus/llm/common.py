"""Helpers shared by the operators: Arrow slices of bounded size, words, hashing, storage.

Words are maximal runs of bytes outside space, tab, newline, vertical tab, form feed and
carriage return, as ``bytes.split`` finds them in the UTF-8 text.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from domus.session import checkpoint_root

SLICE_BYTES = 1 << 20
MAX_CACHED_WORDS = 150_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: later steps do
    not recompute it, and a lost executor costs only the tasks that were running."""
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts hold about ``budget`` bytes together; one very long
    text is a range of its own. Bounds the Python objects alive at once."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // budget
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """word -> 64-bit hash, filled on demand and emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hash_words(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class RangeHashes:
    """Hashes of any range of a sequence of 64-bit symbols: equal ranges hash alike."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self._inverse = powers(_INVERSE, n + 1)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * powers(_BASE, n), out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every ``width`` consecutive symbols."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self._sums[width:] - self._sums[:n]) * self._inverse[:n] + np.uint64(width))


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file: ``$DOMUS_TOKENIZERS`` or the installed public set."""
    root = os.environ.get("DOMUS_TOKENIZERS")
    if root:
        return os.path.join(root, name)
    import public_tokenizers

    return public_tokenizers.path(name)
