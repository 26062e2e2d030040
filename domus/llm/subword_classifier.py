"""Quality classifier: supervised subword embeddings, averaged, softmax, numpy SGD.

A document is the mean of the learned vectors of its hashed features: every word, the
character (byte) 3- and 4-grams of every word between word-end marks, and every pair of
neighbouring words (hashed without order, so that a word followed by itself falls in one
place). Two softmax outputs. The vectors and the output layer are trained together by
stochastic gradient descent on ``TRAIN_ROWS`` labelled documents at most, chosen by hash of
the id; scoring covers every document. For scoring, the output layer is folded into the
vectors: a mean of vectors times a matrix is the mean of each vector times that matrix.

Defined results: a null or empty text has no features and scores by the bias alone; with
fewer than two classes to learn from, every score is 0.5. Null ids count as not held out
and are never trained on; several labels of one id: the lowest counts. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from domus.llm.common import WordHashes, hash_words, mix, raw_texts, slices, store

TRAIN_ROWS = 4000  # the bound of the labelled sample
TRAIN_BYTES = 128 << 20  # and of its feature shares, 8 bytes per bucket of a document
SLICE = 256 << 10  # bytes of text whose features are held at once
BUCKETS = 1 << 16
DIMENSIONS = 12
EPOCHS = 8
RATE = 1.0
GRAMS = (3, 4)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bucket(hashed: np.ndarray) -> np.ndarray:
    return (hashed % np.uint64(BUCKETS)).astype(np.int32)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def features(texts: list[bytes], hashes: WordHashes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every feature, in three parts: words with their character grams
    come as (distinct word, bucket) first, then (document, distinct word), then word pairs."""
    words = [t.split() for t in texts]
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ids = _Ids()
    at = np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), dtype=np.int32, count=int(size.sum()))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    del words
    known = hash_words(list(ids), hashes)
    flat = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in ids), dtype=np.uint8)
    length = np.fromiter((len(w) + 2 for w in ids), dtype=np.int64, count=len(ids))
    of = np.repeat(np.arange(len(ids), dtype=np.int32), length)
    own, bucket = [np.arange(len(ids), dtype=np.int32)], [_bucket(known)]
    for n in GRAMS:
        m = max(0, len(flat) - n + 1)
        inside = np.flatnonzero(of[:m] == of[n - 1:])
        value = np.full(len(inside), n, dtype=np.uint64)
        for k in range(n):
            value *= np.uint64(257)
            value += flat[inside + k]
        own.append(of[inside])
        bucket.append(_bucket(mix(value)))
    yield np.concatenate(own), np.concatenate(bucket)
    del own, bucket, of, flat
    yield owner, at
    near = owner[1:] == owner[:-1]
    pair = mix((known[at[1:]] ^ known[at[:-1]])[near] + np.uint64(1))
    yield owner[1:][near], _bucket(pair)


def means(texts: list[bytes], value: np.ndarray, hashes: WordHashes) -> np.ndarray:
    """Mean of one value per bucket over each text's features (0 where it has none)."""
    found = features(texts, hashes)  # one part is held at a time
    word, bucket = next(found)
    n = int(word.max()) + 1 if len(word) else 0
    per_word, grams = np.bincount(word, value[bucket], n), np.bincount(word, minlength=n)
    del word, bucket
    owner, at = next(found)
    total, count = np.bincount(owner, per_word[at], len(texts)), np.bincount(owner, grams[at], len(texts))
    del owner, at
    doc, pair = next(found)
    total += np.bincount(doc, value[pair], len(texts))
    count += np.bincount(doc, minlength=len(texts))
    return total / np.maximum(count, 1)


def _bags(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for lo in range(batch.num_rows):
            part = batch.slice(lo, 1)
            (word, bucket), (_, at), (_, pair) = features(raw_texts(part, text), hashes)
            times = np.bincount(at, minlength=int(word.max()) + 1 if len(word) else 0)
            bag = np.bincount(bucket, times[word], BUCKETS) + np.bincount(pair, minlength=BUCKETS)
            found = np.flatnonzero(bag)
            share = (bag[found] / max(bag.sum(), 1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array([found.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([share.tobytes()], pa.binary())], names=["doc_id", "label", "buckets", "shares"])


class SubwordClassifier:
    """Bucket vectors and a softmax layer; ``value`` and ``bias`` fold them for class 1."""

    def __init__(self, bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.value = np.empty(BUCKETS)  # what outlives the training comes first: memory behind it can be given back
        vectors = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS))
        vectors /= DIMENSIONS
        out, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
        steps = EPOCHS * len(bags) if len({label for label, _, _ in bags}) == 2 else 0
        order = np.concatenate([rng.permutation(len(bags)) for _ in range(EPOCHS)]) if steps else []
        for step, i in enumerate(order):
            label, bucket, share = bags[i]
            rate = RATE * (1 - step / steps)
            mean = share @ vectors[bucket]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            vectors[bucket] -= (rate * 20) * share[:, None] * back
        np.matmul(vectors, out[:, 1] - out[:, 0], out=self.value)
        self.bias = float(bias[1] - bias[0])

    def scores(self, texts: list[bytes], hashes: WordHashes) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(means(texts, self.value, hashes) + self.bias, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = TRAIN_ROWS) -> SubwordClassifier:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, one row per id. Their hashed
    feature shares, not their texts, come to the driver: TRAIN_BYTES at most."""
    chosen = (labels.select("doc_id", F.col("quality").cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # of rows that share an id the one with the least text hash, then the least text, so that ``rows`` bounds what is collected
    least = F.min(F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("text")))
    bags = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
            .join(F.broadcast(chosen), "doc_id")  # ``rows`` rows of two numbers at most
            .groupBy("doc_id", "label").agg(least.alias("one")).select("doc_id", "label", F.col("one.text").alias(text))
            .mapInArrow(lambda it: _bags(it, text), "doc_id long, label int, buckets binary, shares binary"), "bags")
    # in the order of the choice, as many as TRAIN_BYTES hold: at most ``rows`` rows are ordered
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.octet_length("buckets") + F.octet_length("shares")
    held = bags.select("doc_id", size.alias("size")).withColumn("held", F.sum("size").over(so_far)).filter(F.col("held") <= TRAIN_BYTES)
    # one partition at a time, rows packed by the executors: the JVM holds no copy of the sample, Python one. That
    # one lies end to end in one buffer: thousands of small pieces would stay the driver's after they are freed
    packed, at = bytearray(), {}
    for r in bags.join(F.broadcast(held.select("doc_id")), "doc_id").toLocalIterator():
        at[r.doc_id] = (r.label, len(packed) // 4, len(r.buckets) // 4)
        packed += r.buckets
        packed += r.shares
    bucket, share = (np.frombuffer(packed, kind) for kind in (np.int32, np.float32))
    return SubwordClassifier([(label, bucket[lo:lo + n], share[lo + n:lo + 2 * n]) for _, (label, lo, n) in sorted(at.items())])  # by id: one row per id


def _scores(batches: Iterator[pa.RecordBatch], model: SubwordClassifier, text: str, into: str) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for part in slices(batch, text, SLICE):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(raw_texts(part, text), hashes))],
                                             names=[*part.schema.names, into])


def score(docs: DataFrame, model: SubwordClassifier, text: str = "text", keep: list[str] | None = None,
          into: str = "score") -> DataFrame:
    """The kept columns (the id by default) and the text of every document, with its score. The
    model (one number per bucket, a fixed size) travels with the function."""
    frame = docs.select(*[f"`{c}`" for c in keep or ["doc_id"] if c != text], text)
    shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.mapInArrow(lambda it: _scores(it, model, text, into), f"{shown}, `{into}` double")
