"""Hard negatives by windows over a GNAT-style multiway hyperplane tree.

Every row is one point: its components scaled to integers, and one more coordinate that brings
all rows to the greatest norm, so that a row's distance from an anchor falls as its inner
product with it grows. A node of the tree has up to ``WAYS`` split points taken far apart; a
row belongs to the nearest of them, level by level, down to a leaf. Each split point stores
the least and the greatest distance to the rows under every sibling, measured over all rows.

An anchor's score window is an annulus around it. By the triangle inequality a subtree whose
stored range cannot meet the annulus, seen from any split point above it, is left out; rows of
the leaves that remain are scored exactly, in integers. So nothing is lost: the tree only
saves work. Positives are found first in the anchor's own leaf, whose fifth best bounds the
search of the others; the windows of an anchor's positives are then searched together.

The tree is fitted on at most ``SAMPLE`` rows, chosen by hash of the id; all rows are indexed. The
rows of a leaf are packed into blocks of ``BLOCK`` rows, dealt by range of (leaf, id) so that a
leaf of any size is packed by many tasks, and under ``salt`` keys of ``SALT_BLOCKS`` blocks, so
that no join key is large. Anchors travel in chunks to the leaves they still need. A task holds
one chunk against one block and the best ``TOP`` candidates of some chunks; no pair is emitted.

Defined results: rows with a null label, vector, component or id or a component that is not
finite take no part. Of rows that repeat an id the one with the least (label, vector) counts.
Vectors of different lengths are compared as if filled up with zeros. Ties go to the smaller id.
Anchors without positives or without rows in the window give no rows; extra columns are
ignored; empty tables give no rows. Scores must be below 2**53, or an error is raised.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from domus.llm.common import parts, store

SAMPLE = 4096  # rows the tree is fitted on, at most
WAYS = 8
LEAF = 64  # sampled rows in a leaf, at most
BLOCK = 1024  # rows scored together
SALT_BLOCKS = 64
CHUNK = 256  # anchors scored together
HELD_CHUNKS = 64
SCALE = 256
RELABEL = 7  # ids divisible by this get the next label
LABELS = 10
EVERY = 100  # ids divisible by this are anchors
TOP = 5
LOW = 80  # where the window begins, in hundredths of the positive's score
EXACT = 1 << 53
FAR = -(1 << 62)


def _integers(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector as floor(SCALE * x); None where a component is null or not finite."""
    values = column.flatten()
    flat = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) * SCALE
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    out: list[np.ndarray | None] = []
    for lo, hi, valid in zip((ends - size).tolist(), ends.tolist(), column.is_valid().to_pylist()):
        one = flat[lo:hi]
        out.append(np.floor(one) if valid and np.isfinite(one).all() else None)
    return out


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
        rows = [(i, b, v) for i, b, v in zip(ids, labels, _integers(batch.column("vector"))) if v is not None]
        if rows:
            i, b, v = zip(*rows)
            if max(float(np.abs(x).max(initial=0)) for x in v) >= EXACT:
                raise ValueError("a component is too large for exact integer scores")
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int64()), pa.array(b, pa.int64()), pa.array([x.astype(np.int64).tobytes() for x in v], pa.binary()),
                 pa.array([len(x) for x in v], pa.int32()), pa.array([float(x @ x) for x in v])],
                names=["vec_id", "label", "vector", "width", "norm"])


def prepared(rows: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """vec_id, label, vector (integers as bytes), width, norm (squared): one row per id that takes part."""
    label = F.col("label").cast("long") if label is None else label
    frame = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col(f"`{vector}`").alias("vector"))
    frame = frame.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    found = frame.mapInArrow(_clean, "vec_id long, label long, vector binary, width int, norm double")
    least = F.min(F.struct("label", "vector", "width", "norm")).alias("r")
    return found.groupBy("vec_id").agg(least).select("vec_id", "r.*")


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        one = np.frombuffer(v, dtype=np.int64)
        out[i, :len(one)] = one
    return out


class Tree:
    """``split``: per node its split points; ``child``: per node the node or (negative) leaf under
    each; ``low`` / ``high``: per node [i, j] the distances of split point i from the rows under j."""

    def __init__(self, sample: np.ndarray, top: float):
        self.top = top  # the greatest squared norm
        self.split: list[np.ndarray] = []
        self.child: list[list[int]] = []
        self.path: list[list[tuple[int, int]]] = []  # per leaf, the (node, branch) above it
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._grow(sample, [])

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows as points: the last coordinate brings them to the greatest norm."""
        return np.c_[x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))]

    @staticmethod
    def far(x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of rows of x from points."""
        square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
        return np.sqrt(np.maximum(square, 0))

    def _grow(self, sample: np.ndarray, above: list[tuple[int, int]]) -> int:
        points = self.lift(sample) if len(sample) else np.zeros((0, sample.shape[1] + 1))
        chosen: list[int] = []
        if len(points) > LEAF:
            near = np.full(len(points), np.inf)
            at = int(np.argmax(self.far(points, points.mean(axis=0)[None, :])[:, 0]))
            while len(chosen) < WAYS and near[at] > 0:  # the farthest from those chosen
                chosen.append(at)
                near = np.minimum(near, self.far(points, points[at:at + 1])[:, 0])
                at = int(np.argmax(near))
        if len(chosen) < 2:  # few points, or all of them alike
            self.path.append(above)
            return -len(self.path)
        node = len(self.split)
        self.split.append(points[chosen])
        self.child.append([])
        self.low.append(np.full((len(chosen), len(chosen)), np.inf))
        self.high.append(np.full((len(chosen), len(chosen)), -np.inf))
        nearest = np.argmin(self.far(points, points[chosen]), axis=1)
        for branch in range(len(chosen)):
            self.child[node].append(self._grow(sample[nearest == branch], [*above, (node, branch)]))
        return node

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        points, leaf = self.lift(x), np.zeros(len(x), dtype=np.int32)
        todo = [(0 if self.split else -1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                leaf[rows] = -node - 1
                continue
            nearest = np.argmin(self.far(points[rows], self.split[node]), axis=1)
            for branch, child in enumerate(self.child[node]):
                if (nearest == branch).any():
                    todo.append((child, rows[nearest == branch]))
        return leaf

    def along(self, leaf: int, x: np.ndarray) -> np.ndarray:
        """Distances of a leaf's rows from all split points above it, level by level."""
        points = self.lift(x)
        return np.concatenate([self.far(points, self.split[node]) for node, _ in self.path[leaf]] or [np.zeros((len(x), 0))], axis=1)

    def measure(self, leaf: int, low: np.ndarray, high: np.ndarray) -> None:
        """Take in the ranges of one leaf's rows, in the order of ``along``."""
        at = 0
        for node, branch in self.path[leaf]:
            m = len(self.split[node])
            self.low[node][:, branch] = np.minimum(self.low[node][:, branch], low[at:at + m])
            self.high[node][:, branch] = np.maximum(self.high[node][:, branch], high[at:at + m])
            at += m

    def open_leaves(self, anchors: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
        """[anchor, leaf]: may rows scoring from ``least`` to ``most`` (one column per window) lie there?"""
        own = (anchors * anchors).sum(axis=1)[:, None] + self.top
        slack = 1e-5 * np.sqrt(own + self.top)  # far beyond rounding
        inner = np.sqrt(np.maximum(own - 2 * most, 0)) - slack
        outer = np.where(least > most, -np.inf, np.sqrt(np.maximum(own - 2 * least, 0)) + slack)
        points = np.c_[anchors, np.zeros(len(anchors))]
        still = np.zeros((len(anchors), len(self.path)), dtype=bool)
        todo = [(0 if self.split else -1, np.ones(most.shape, dtype=bool))]
        while todo:
            node, alive = todo.pop()
            if node < 0:
                still[:, -node - 1] = (alive & (inner <= outer)).any(axis=1)
                continue
            d = self.far(points, self.split[node])[:, :, None]
            for branch, child in enumerate(self.child[node]):
                low, high = self.low[node][:, branch], self.high[node][:, branch]
                if low[0] > high[0]:  # no row at all
                    continue
                nearest = np.maximum(low[None, :, None] - d, d - high[None, :, None])
                meets = (nearest <= outer[:, None, :]) & (d + high[None, :, None] >= inner[:, None, :])
                below = alive & meets.all(axis=1)
                if below.any():
                    todo.append((child, below))
        return still


def _place(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = tree.place(matrix(batch.column("vector").to_pylist(), width))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])


BLOCKS = "leaf int, least_label long, most_label long, n int, ids binary, labels binary, vectors binary, low array<double>, high array<double>"


def _pack(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (leaf, id); blocks of at most BLOCK rows of one leaf go out."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        ids, labels, vectors = (list(c) for c in zip(*[(i, b, v) for _, i, b, v in held]))
        whole = matrix(vectors, width)
        away = tree.along(held[0][0], whole)
        label = np.array(labels, dtype=np.int64)
        row = [[held[0][0]], [int(label.min())], [int(label.max())], [len(ids)], [np.array(ids, np.int64).tobytes()], [label.tobytes()],
               [whole.astype(np.int64).tobytes()], [away.min(axis=0).tolist()], [away.max(axis=0).tolist()]]
        held.clear()
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("leaf", "vec_id", "label", "vector")]):
            if held and (held[0][0] != row[0] or len(held) == BLOCK):
                yield block()
            held.append(row)
    if held:
        yield block()


class Index:
    """The tree with its ranges over all rows, the stored blocks, and the salts of each leaf."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        self.rows = store(rows, "vectors")
        size = self.rows.agg(F.max("width").alias("width"), F.max("norm").alias("norm")).first()
        self.width, top = size.width or 0, size.norm or 0.0
        if top >= EXACT:
            raise ValueError("vectors are too long for exact integer scores")
        sample = self.rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "vector").collect()
        sample.sort(key=lambda r: r.vec_id)
        tree, width = Tree(matrix([r.vector for r in sample], self.width), top), self.width
        self.placed = store(self.rows.mapInArrow(lambda it: _place(it, tree, width), "vec_id long, label long, vector binary, "
                                                 "width int, norm double, leaf int"), "placed")
        ranged = self.placed.select("leaf", "vec_id", "label", "vector").repartitionByRange(parts(spark), "leaf", "vec_id") \
            .sortWithinPartitions("leaf", "vec_id")
        self.blocks = store(ranged.mapInArrow(lambda it: _pack(it, tree, width), BLOCKS), "blocks")
        spans = self.blocks.select("leaf", "least_label", "most_label", F.posexplode(F.arrays_zip("low", "high")).alias("i", "r"))
        ranges = spans.groupBy("leaf", "i").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high")).groupBy("leaf") \
            .agg(F.sort_array(F.collect_list(F.struct("i", "low", "high"))).alias("r"))  # one entry per split point above a leaf
        leaves = self.blocks.groupBy("leaf").agg(F.count("*").alias("n"), F.min("least_label").alias("a"), F.max("most_label").alias("b"))
        leaves = leaves.join(ranges, "leaf", "left").orderBy("leaf").collect()  # one row per leaf of the tree
        count = len(tree.path)
        self.salts = np.zeros(count, dtype=np.int64)
        self.labels = np.zeros((count, 2), dtype=np.int64)
        for r in leaves:
            tree.measure(r.leaf, np.array([x.low for x in r.r or []]), np.array([x.high for x in r.r or []]))
            self.salts[r.leaf], self.labels[r.leaf] = -(-r.n // SALT_BLOCKS), (r.a, r.b)
        self.tree = tree
        salts = F.array(*[F.lit(int(x)) for x in self.salts])
        self.dealt = self.blocks.withColumn("salt", F.pmod(F.xxhash64("ids"), F.get(salts, F.col("leaf"))).cast("int"))

    def candidates(self, anchors: DataFrame, own: bool | None, positives: bool) -> DataFrame:
        """anchor, window, candidate, score: the best TOP of every leaf and salt that an anchor's windows may
        meet. ``anchors``: vec_id, label, vector, leaf, windows (array of most, least). ``positives``: rows
        of the anchor's label, else of the others. ``own``: its own leaf only, the others only, or all."""
        spark, tree, width, salts, labels = anchors.sparkSession, self.tree, self.width, self.salts, self.labels

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(lo, CHUNK)
                    x, leaf = matrix(part.column("vector").to_pylist(), width), part.column("leaf").to_numpy()
                    label = part.column("label").to_numpy()[:, None]
                    if own:
                        still = np.zeros((len(x), len(salts)), dtype=bool)
                        still[np.arange(len(x)), leaf] = True
                    else:
                        windows = part.column("windows").to_pylist()
                        wide = max(map(len, windows), default=0)
                        most, least = np.full((len(x), wide), float(FAR)), np.full((len(x), wide), -float(FAR))
                        for i, w in enumerate(windows):
                            most[i, :len(w)], least[i, :len(w)] = [a["most"] for a in w], [a["least"] for a in w]
                        still = tree.open_leaves(x, most, least)
                        if own is False:
                            still[np.arange(len(x)), leaf] = False
                    only = labels[:, 0] == labels[:, 1]
                    if positives:
                        still &= (labels[None, :, 0] <= label) & (label <= labels[None, :, 1])
                    else:
                        still &= ~(only[None, :] & (labels[None, :, 0] == label))
                    row, to = np.nonzero(still)
                    times = salts[to]
                    row, to = np.repeat(row, times), np.repeat(to, times)
                    salt = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to, pa.int32()), pa.array(salt, pa.int32()), *[part.column(c).take(pa.array(row)) for c in ANCHOR]],
                        names=["leaf", "salt", *ANCHOR])

        sent = anchors.mapInArrow(spread, "leaf int, salt int, " + ANCHOR_TYPES)
        ranged = sent.repartitionByRange(parts(spark), "leaf", "salt", "vec_id").sortWithinPartitions("leaf", "salt", "vec_id")
        chunks = ranged.mapInArrow(_chunk, "leaf int, salt int, a_ids binary, a_labels binary, a_vectors binary, a_most array<double>, "
                                           "a_least array<double>, a_wide int")
        pairs = self.dealt.select("leaf", "salt", "ids", "labels", "vectors").join(chunks, ["leaf", "salt"])
        return pairs.mapInArrow(lambda it: _score(it, width, positives), "anchor long, most long, candidate long, score long")


ANCHOR = ["vec_id", "label", "vector", "windows"]
ANCHOR_TYPES = "vec_id long, label long, vector binary, windows array<struct<most:long,least:long>>"


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by (leaf, salt) as chunks of at most CHUNK of one leaf and salt."""
    held: list[tuple] = []

    def chunk() -> pa.RecordBatch:
        wide = max((len(r[5]) for r in held), default=0)
        most, least = np.full((len(held), wide), float(FAR)), np.full((len(held), wide), -float(FAR))
        for i, r in enumerate(held):
            most[i, :len(r[5])], least[i, :len(r[5])] = [a["most"] for a in r[5]], [a["least"] for a in r[5]]
        size = max(len(r[4]) for r in held)
        row = [held[0][0], held[0][1], np.array([r[2] for r in held], np.int64).tobytes(), np.array([r[3] for r in held], np.int64).tobytes(),
               b"".join(r[4].ljust(size, b"\0") for r in held), most.ravel().tolist(), least.ravel().tolist(), wide]
        held.clear()
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2, pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                          names=["leaf", "salt", "a_ids", "a_labels", "a_vectors", "a_most", "a_least", "a_wide"])

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("leaf", "salt", *ANCHOR)]):
            if held and (held[0][:2] != row[:2] or len(held) == CHUNK):
                yield chunk()
            held.append(row)
    if held:
        yield chunk()


def _best(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Order of (score descending, id ascending), the first TOP."""
    return np.lexsort((ids, -score))[:TOP]


def _score(batches: Iterator[pa.RecordBatch], width: int, positives: bool) -> Iterator[pa.RecordBatch]:
    """The best TOP rows per anchor and window over the blocks met in a row; ``most`` names the window."""
    running: OrderedDict[tuple, dict] = OrderedDict()

    def flush(best: dict) -> pa.RecordBatch:
        rows = [(a, m, i, s) for (a, m), (score, ids) in best.items() for s, i in zip(score.tolist(), ids.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4,
                                          names=["anchor", "most", "candidate", "score"])

    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in ("leaf", "salt", "ids", "labels", "vectors", "a_ids", "a_labels", "a_vectors")}
            a_ids, a_labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
            ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
            wide = batch.column("a_wide")[k].as_py()
            most, least = (np.array(batch.column(c)[k].as_py()).reshape(len(a_ids), wide) for c in ("a_most", "a_least"))
            a = np.zeros((len(a_ids), width))
            given = np.frombuffer(row["a_vectors"], np.int64).reshape(len(a_ids), -1)
            a[:, :given.shape[1]] = given
            score = a @ np.frombuffer(row["vectors"], np.int64).reshape(len(ids), width).T.astype(np.float64)  # exact: below 2**53
            fits = (a_labels[:, None] == labels[None, :]) == positives
            fits &= a_ids[:, None] != ids[None, :]
            key = (row["leaf"], row["salt"], a_ids[0], len(a_ids))
            best = running.setdefault(key, {})
            running.move_to_end(key)
            for w in range(wide):
                inside = fits & (score <= most[:, w:w + 1]) & (score >= least[:, w:w + 1])
                many = inside.sum(axis=1)
                for i in np.flatnonzero(many).tolist():
                    at = np.flatnonzero(inside[i])
                    if len(at) > 4 * TOP:  # the TOP best scores and all that tie with the last of them
                        floor = np.partition(score[i, at], len(at) - TOP)[len(at) - TOP]
                        at = at[score[i, at] >= floor]
                    s, c = score[i, at].astype(np.int64), ids[at]
                    mark = (int(a_ids[i]), int(most[i, w]))
                    if mark in best:
                        s, c = np.r_[best[mark][0], s], np.r_[best[mark][1], c]
                    first = _best(s, c)
                    best[mark] = (s[first], c[first])
            if len(running) > HELD_CHUNKS:
                yield flush(running.popitem(last=False)[1])
    for best in running.values():
        yield flush(best)


def _ranked(found: DataFrame) -> DataFrame:
    """The first TOP of each anchor and window, with their rank."""
    order = Window.partitionBy("anchor", "most").orderBy(F.desc("score"), "candidate")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def hard_negatives(rows: DataFrame, vector: str = "embedding", label: Column | None = None, every: int = EVERY, low: int = LOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (id divisible
    by ``every``) and each of its TOP best rows of its label, the best TOP rows of other labels that
    score from ``low`` hundredths of the positive up to all of it."""
    index = Index(prepared(rows, vector, label))
    anchors = index.placed.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "vector", "leaf")
    open_ = F.array(F.struct(F.lit(-FAR).alias("most"), F.lit(FAR).alias("least")))
    near = store(_ranked(index.candidates(anchors.withColumn("windows", open_), True, True)), "near-positives")
    # the fifth best of the anchor's own leaf bounds the others
    bound = near.filter(F.col("rank") == TOP).select(F.col("anchor").alias("vec_id"), F.col("score").alias("bound"))
    bounded = anchors.join(bound, "vec_id", "left").withColumn(
        "windows", F.array(F.struct(F.lit(-FAR).alias("most"), F.coalesce("bound", F.lit(FAR)).alias("least")))).drop("bound")
    found = near.drop("rank").unionByName(index.candidates(bounded, False, True))
    positives = store(_ranked(found).select("anchor", F.col("candidate").alias("positive_id"), F.col("score").alias("positive_score")),
                      "positives")
    # 100 * score >= low * positive: the least whole score is the ceiling of the quotient
    window = F.struct(F.col("positive_score").alias("most"), F.expr(f"(positive_score * {low} + 99) div 100").alias("least"))
    windows = positives.filter("positive_score >= 0").groupBy(F.col("anchor").alias("vec_id")).agg(F.collect_set(window).alias("windows"))
    negatives = _ranked(index.candidates(anchors.join(windows, "vec_id"), None, False))
    negatives = negatives.withColumnRenamed("most", "positive_score")
    return positives.join(negatives, ["anchor", "positive_score"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("candidate").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def relabelled(every: int = RELABEL, labels: int = LABELS) -> Column:
    """The label, for ids divisible by ``every`` the next one of ``labels``."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)
