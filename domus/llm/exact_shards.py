"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

The rows are written once to the shared folder, in files of at most ``FILE_ROWS`` rows; a row's
address is (file, place in the file), which a lost executor cannot change. How many rows each
file sends to each shard is drawn at once for all files: file after file, a multivariate
hypergeometric draw from what the shards still lack. So every file sends all its rows, and
every shard gets exactly its size, as a uniform shuffle would have dealt them.

Each file is then permuted locally and cut by its row of the matrix; rows are exchanged and
every shard is permuted again, by distinct 64-bit keys within the shard. That exchange is by
ranges of (shard, key), so that a shard of any size is spread over many tasks, and the
places in a shard come from the counts of the stored ranges.

Law ``rows``: shard sizes differ by one at most. Equal texts are rows like any other and may go to
different shards.

Bounds: the driver holds files x shards counts (8 bytes each; one file per writing task and
``FILE_ROWS`` rows more), as Spark itself holds one size per map task and partition; a task
holds one permutation of ``FILE_ROWS`` numbers. The draws follow from ``seed``, the order of the
files and their sizes.

Defined results: every row is dealt, whatever its id or text; null texts count as empty; repeated
rows are dealt each for itself; fewer rows than shards leave shards empty; empty tables give no
rows. All columns travel in one struct, so that their names cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from domus.llm.common import mix, parts, store
from domus.session import checkpoint_root

SHARDS = 40
FILE_ROWS = 1 << 20
SEED = 13
MAX_MATRIX_BYTES = 1 << 30


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` taken from ``good`` and ``bad`` things without putting back are good.
    Inverts the distribution function outwards from the mode, over 14 standard deviations to
    either side, for populations of any size."""
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo == hi:
        return lo
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), lo), hi)
    spread = np.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1)))
    reach = int(14 * spread) + 40
    a, b = max(lo, mode - reach), min(hi, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.r_[0.0, np.cumsum(ratio)]
    weight = np.cumsum(np.exp(weight - weight.max()))
    return a + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def communication_matrix(sent: list[int], wanted: list[int], rng: np.random.Generator) -> np.ndarray:
    """Rows sum to ``sent``, columns to ``wanted``: the counts of a uniform deal."""
    left, out = list(wanted), np.zeros((len(sent), len(wanted)), dtype=np.int64)
    lacking = sum(left)
    for i, rows in enumerate(sent):
        others = lacking
        for j, size in enumerate(left):
            others -= size
            n = hypergeometric(rng, size, others, rows)
            out[i, j] = n
            left[j] -= n
            rows -= n
        lacking = sum(left)
    return out


def _deal(batches: Iterator[pa.RecordBatch], files: dict[str, int], matrix: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    held, order = None, np.zeros(0, np.int64)
    for batch in batches:
        name = batch.column("file").dictionary_encode()
        of = np.array([files[x] for x in name.dictionary.to_pylist()], dtype=np.int64)[name.indices.to_numpy()]
        at = batch.column("at").to_numpy()
        shard = np.zeros(batch.num_rows, dtype=np.int32)
        for file in np.unique(of):
            if file != held:  # scans read file after file
                held, order = file, np.random.default_rng([seed, int(file)]).permutation(int(matrix[file].sum()))
            here = of == file
            shard[here] = np.searchsorted(np.cumsum(matrix[file]), order[at[here]], side="right")
        # distinct for distinct addresses: the scramble is a bijection
        salt = mix(np.array([seed], dtype=np.uint64))
        key = mix((of.astype(np.uint64) << np.uint64(32) | at.astype(np.uint64)) ^ salt).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(shard), pa.array(key)], names=["row", "shard", "key"])


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, file_rows: int = FILE_ROWS) -> DataFrame:
    """row (a struct of all columns), shard (from 0) and slot (gapless from 0 in every shard)."""
    spark = docs.sparkSession
    path = f"{checkpoint_root(spark)}/shard-rows-{uuid.uuid4().hex[:12]}"
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    held.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    rows = spark.read.schema(held.schema).parquet(path).select(
        "row", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    sent = rows.groupBy("file").agg(F.count("*").alias("n")).orderBy("file").collect()  # one row per file
    if 8 * len(sent) * shards > MAX_MATRIX_BYTES:
        raise ValueError(f"{len(sent)} files x {shards} shards exceed the matrix's bound; write fewer, larger files")
    total = sum(r.n for r in sent)
    wanted = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([r.n for r in sent], wanted, np.random.default_rng(seed))
    plan = spark.sparkContext.broadcast(({r.file: i for i, r in enumerate(sent)}, matrix))
    dealt = rows.mapInArrow(lambda it: _deal(it, *plan.value, seed), T.StructType(
        [held.schema["row"], T.StructField("shard", T.IntegerType()), T.StructField("key", T.LongType())]))
    # the bounds of ranges are sampled, so places are counted on what was stored
    ranged = (dealt.repartitionByRange(parts(spark), "shard", "key").sortWithinPartitions("shard", "key")
              .select("row", "shard", F.spark_partition_id().alias("range"),
                      F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("local")))
    ranged = store(ranged, "shard-ranges")
    sizes = ranged.groupBy("shard", "range").agg(F.count("*").alias("n"), F.min("local").alias("first"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # at most ranges + shards rows
    opens = sizes.select("shard", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("opens"))
    return ranged.join(F.broadcast(opens), ["shard", "range"]).select("row", "shard", (F.col("opens") + F.col("local")).alias("slot"))


def write_shards(dealt: DataFrame, path: str) -> None:
    """Shard folders ``shard=<j>``, each row with its slot."""
    dealt.write.partitionBy("shard").parquet(path)
