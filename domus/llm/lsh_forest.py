"""Near-duplicate join: MinHash LSH forest over word shingles, exact Jaccard verification.

Every document's set of five-word shingles gets a MinHash signature, cut into one label per
tree. A tree is the sorted prefix trie of its labels: documents meet where they share a
prefix. Matching starts at the whole label and shortens the prefix until pairs at the
threshold are found with the target probability; at every depth only one delegate of each
deeper trie node goes on, so a group of thousands enters the next depth as one row.
Documents that meet (directly or through others) form a candidate group; inside groups
every pair is verified on the whole shingle sets, block against block, and only counts and
a spanning set of verified links leave a block.

Defined results: a text of one to four words has one shingle, all of its words; a text
without words has none, is in a class of its own and has no links. Documents with equal
shingle sets are copies: one stands for all. A row that is
repeated counts once; if an id comes with several texts, its class is the least of theirs
and its numbers are the largest. A row without an id has class null and no links. Extra columns are
ignored, an empty table gives no rows, and no text or group is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import RangeHashes, WordHashes, hash_words, mix, parts, raw_texts, slices, store
from domus.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
STEP = 2
TARGET_RECALL = 0.999
BLOCK = 256


def recall(depth: int, trees: int = TREES, similarity: float = THRESHOLD) -> float:
    """Probability that a pair of that similarity shares a prefix of that depth in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def depths(target: float = TARGET_RECALL, trees: int = TREES, deepest: int = DEPTH, step: int = STEP,
           similarity: float = THRESHOLD) -> list[int]:
    """Prefix lengths to match at: from the whole label, shorter until the target is reached."""
    out = [deepest]
    while recall(out[-1], trees, similarity) < target and out[-1] > 1:
        out.append(max(1, out[-1] - step))
    return out


def shingle_sets(texts: list[bytes], hashes: WordHashes, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out = []
    for t in texts:
        words = t.split()
        found = RangeHashes(hash_words(words, hashes)).windows(min(width, len(words))) if words else np.zeros(0, np.uint64)
        out.append(np.unique(found))
    return out


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """MinHash values, one row per set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    seeds = mix(np.arange(1, 2 * size + 1, dtype=np.uint64))
    out = np.empty((len(sets), size), dtype=np.uint64)
    for j in range(size):
        out[:, j] = np.minimum.reduceat((flat ^ seeds[2 * j]) * (seeds[2 * j + 1] | np.uint64(1)), starts)
    return out


def _sign(batches: Iterator[pa.RecordBatch], text: str, levels: list[int], trees: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    names = ["doc_id", "k1", "k2", "size", *[f"p{d}" for d in levels]]
    for batch in batches:
        for part in slices(batch, text, 1 << 20):
            sets = shingle_sets(raw_texts(part, text), hashes)
            has = np.array([len(s) > 0 for s in sets])
            part, sets = part.filter(pa.array(has)), [s for s in sets if len(s)]
            if not sets:
                continue
            sig = mix(signatures(sets, trees * levels[0])).reshape(len(sets), trees, levels[0])
            starts = np.cumsum([0, *map(len, sets)])[:-1]
            flat = np.concatenate(sets)
            key = [np.add.reduceat(mix(flat ^ np.uint64(s)), starts).view(np.int64) for s in (1, 2)]
            tree = mix(np.arange(trees, dtype=np.uint64) + np.uint64(77))[None, :]
            labels = []
            for depth in levels:
                prefix = tree.repeat(len(sets), axis=0)
                for i in range(depth):
                    prefix = mix(prefix * np.uint64(31) + sig[:, :, i])
                labels.append(pa.array(list(prefix.view(np.int64)), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *map(pa.array, key), pa.array([len(s) for s in sets], pa.int32()), *labels],
                names=names)


def sign(docs: DataFrame, text: str = "text", levels: list[int] | None = None, trees: int = TREES) -> DataFrame:
    """doc_id, set key (k1, k2), set size and per depth one prefix label per tree."""
    levels = levels or depths(trees=trees)
    schema = "doc_id long, k1 long, k2 long, size int, " + ", ".join(f"p{d} array<long>" for d in levels)
    return docs.select("doc_id", text).mapInArrow(lambda it: _sign(it, text, levels, trees), schema)


def forest_edges(nodes: DataFrame, levels: list[int]) -> DataFrame:
    """(a, b): every trie node's members to its least member, depth by depth."""
    edges = None
    zipped = F.explode(F.arrays_zip(*[f"p{d}" for d in levels])).alias("t")
    members = nodes.select("node", zipped).select("node", *[F.col(f"t.p{d}").alias(f"p{d}") for d in levels])
    for i, depth in enumerate(levels):
        label, rest = f"p{depth}", [f"p{d}" for d in levels[i + 1:]]
        heads = members.groupBy(label).agg(F.min("node").alias("head"), F.count("*").alias("n"), *[F.min(c).alias(c) for c in rest])
        if rest:
            heads = store(heads, "delegates")
        found = (members.select("node", label).join(heads.filter("n > 1").select(label, "head"), label)
                 .filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
        edges = found if edges is None else edges.union(found)
        members = heads.select(F.col("head").alias("node"), *rest)
    return edges


def _shingled(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for part in slices(batch, text, 1 << 20):
            sets = [s.tobytes() for s in shingle_sets(raw_texts(part, text), hashes)]
            rest = part.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.binary())], names=[*rest.schema.names, "shingles"])


def overlaps(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, from the shared values only."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.r_[True, flat[1:] != flat[:-1]]
    value = np.cumsum(fresh) - 1
    shared = np.bincount(value)[value] > 1
    owner, value = owner[shared], (np.cumsum(fresh[shared]) - 1)
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for lo in range(0, int(value[-1]) + 1 if len(value) else 0, chunk):
        here = slice(np.searchsorted(value, lo), np.searchsorted(value, lo + chunk))
        member = np.zeros((len(sets), chunk), dtype=np.float32)
        member[owner[here], value[here] - lo] = 1
        out += member @ member.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _verify_group(side: np.ndarray, node: np.ndarray, copies: np.ndarray, sets: list[np.ndarray],
                  threshold: float) -> Iterator[tuple[int, int | None, int]]:
    """(node, None, linked documents) counts and (node, node, 0) spanning links of one block pair."""
    inter, size = overlaps(sets), np.array([len(s) for s in sets], dtype=np.float64)
    union = size[:, None] + size[None, :] - inter
    linked = (inter >= threshold * union - 1e-9) & (node[:, None] != node[None, :])
    if side.max() > side.min():
        linked &= side[:, None] != side[None, :]
    for i in np.flatnonzero(linked.any(axis=1)):
        yield int(node[i]), None, int(copies[linked[i]].sum())
    left = np.arange(len(node))
    open_ = np.ones(len(node), dtype=bool)
    for root in left:  # breadth-first spanning forest
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            new = np.flatnonzero(linked[at] & open_)
            open_[new] = False
            for j in new:
                yield int(node[at]), int(node[j]), 0
            queue.extend(new.tolist())


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block pair; one block pair is held at a time."""
    key, held, at, seen = None, [], None, set()

    def done() -> Iterator[pa.RecordBatch]:
        side, node, copies, sets = (list(c) for c in zip(*held))
        rows = list(_verify_group(np.array(side), np.array(node), np.array(copies), [np.frombuffer(s, np.uint64) for s in sets], threshold))
        if rows:
            a, b, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("comp", "i", "j", "side", "node", "copies", "shingles")]
        for comp, i, j, *row in zip(*cols):
            if (comp, i, j) != key:
                if len(held) > 1:
                    yield from done()
                key, held, seen = (comp, i, j), [], set()
            if row[1] != at:  # rows of one node follow each other
                at, seen = row[1], set()
            if row[3] not in seen:
                seen.add(row[3])
                held.append(row)
    if len(held) > 1:
        yield from done()


def verified(docs: DataFrame, members: DataFrame, text: str = "text", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Counts and links of all pairs inside the candidate groups ``members`` (node, comp, copies)."""
    sizes = members.groupBy("comp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = members.join(sizes, "comp").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("node"), text).join(placed, "node")
            .select("node", "comp", "copies", "blocks", "own", text)
            .mapInArrow(lambda it: _shingled(it, text), "node long, comp long, copies long, blocks int, own int, shingles binary"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rows.select("*", other).select(
        "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("side"),
        "node", "copies", "shingles")
    return (dealt.repartition(parts(docs.sparkSession), "comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node")
            .mapInArrow(lambda it: _verify(it, threshold), "a long, b long, n long"))


def near_duplicates(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id (least id of its class), n_copies (documents with its very shingles,
    itself included) and n_links (other documents at the threshold or more, copies included)."""
    levels = depths(target, similarity=threshold)
    signed = store(sign(docs, text, levels).filter("doc_id IS NOT NULL").distinct(), "signatures")
    # what else rows of one set have is equal, so any of them will do
    sets = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.count_distinct("doc_id").alias("copies"))
    sets = store(sets, "sets")
    reps = signed.join(sets.select("k1", "k2", F.col("node").alias("doc_id")), ["k1", "k2", "doc_id"]).withColumnRenamed("doc_id", "node")
    groups = components(forest_edges(reps, levels))
    groups = groups.select("node", F.col("root").alias("comp"))
    members = store(groups.join(sets.groupBy("node").agg(F.sum("copies").alias("copies")), "node"), "members")
    checked = store(verified(docs, members, text, threshold), "verified")
    classes = components(checked.filter("b IS NOT NULL").select("a", "b"))
    counts = checked.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    nodes = (sets.join(classes, "node", "left").join(counts, "node", "left")
             .select("k1", "k2", F.coalesce("root", "node").alias("class_id"), F.col("copies").alias("n_copies"),
                     (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    known = (signed.select("doc_id", "k1", "k2").join(nodes, ["k1", "k2"]).groupBy("doc_id")
             .agg(F.min("class_id").alias("class_id"), F.max("n_copies").alias("n_copies"), F.max("n_links").alias("n_links")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(known, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))
