"""Keyed upsert without a keyed store: committed micro-batches over a bucketed base.

Layout of a table folder::

    batches/run=<r>/batch=<b>/attempt=<a>/   rows of one micro-batch, one per key
    base/gen=<g>/                            current rows, hashed by key into fixed buckets
    commits/commit=<c>/                      one row per committed batch or compaction

**Commits.** A micro-batch is deduplicated to one row per key, written to a folder of its own
and then committed by adding one row (one file) to ``commits``. Readers list the commits
once and read only folders that those rows name, so they never see half a batch, whatever
is written meanwhile. The run is the id that the stream's checkpoint holds: a batch that Spark
replays after its commit is already there and is left out; an attempt that failed before its
commit is never read.

**Base.** A compaction takes base and batches from one listing of the commits, and its own commit
row names the batches it covers: whatever is committed meanwhile is not covered and stays
beside the base. The base is a Spark bucketed table; a bucket is one hash of the key, so the
changes join it bucket by bucket and only the changes are shuffled. Only buckets that have
changes are rewritten, into a new generation; the commit row says which generation holds each
bucket. When superseded buckets make up half of the files, all of them are rewritten. One
compaction runs at a time beside any number of writers and readers: of two that write at the
same moment one may fail, which loses nothing.

The current table is, per key, the row with the greatest order (real columns of the data; batch
and run only break ties). Rows without a key are not stored; the publish job quarantines them.
The column names run, batch, attempt and gen are the table's own.

The driver reads one row per commit and, from a base, one number per bucket.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field, replace
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from domus import schemas as S
from domus.operators.upsert import latest_per_key
from domus.sources.tables import read_state

RUN_COL, BATCH_COL = "run", "batch"
COMMIT_DDL = ("version BIGINT, kind STRING, run STRING, batch BIGINT, attempt STRING, columns STRING, "
              "metrics MAP<STRING,STRING>, buckets INT, gens ARRAY<BIGINT>, written BIGINT, covered MAP<STRING,ARRAY<STRUCT<lo:BIGINT,hi:BIGINT>>>")
BATCH, BASE = "batch", "base"


@dataclass(frozen=True)
class Snapshot:
    """One listing of the commits: the newest base, the batches beyond it, the columns."""

    version: int = 0
    buckets: int = 0
    gens: tuple[int, ...] = ()  # per bucket the generation that holds it
    written: int = 0  # buckets in the files of all generations in use
    covered: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    batches: tuple[tuple[str, int, str], ...] = ()  # run, batch, attempt
    schema: StructType | None = None


def _within(ranges: list[tuple[int, int]], batch: int) -> bool:
    return any(lo <= batch <= hi for lo, hi in ranges)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, those that touch as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


@dataclass
class ChangeLog:
    path: str
    key: str
    order: list[str | Column]
    ddl: str | None = None  # columns of a table that nothing was committed to
    buckets: int | None = None  # of a new base; by default as many as shuffle partitions
    _known: dict[str, set[int]] = field(default_factory=dict, init=False, repr=False, compare=False)

    # ------------------------------------------------------------------ commits
    def snapshot(self, spark: SparkSession) -> Snapshot:
        rows = read_state(spark, f"{self.path}/commits", COMMIT_DDL).collect()
        bases = [r for r in rows if r["kind"] == BASE]
        base = max(bases, key=lambda r: (r["version"], r["attempt"]), default=None)
        covered = {run: [(x["lo"], x["hi"]) for x in v] for run, v in (base["covered"] if base else {}).items()}
        first: dict[tuple[str, int], str] = {}  # two commits of one batch hold the same rows
        columns: list[StructField] = []
        for r in sorted(rows, key=lambda r: (r["kind"] != BASE, r["version"] or 0, r["batch"] or 0, r["attempt"])):
            known = {c.name for c in columns}
            columns += [c for c in StructType.fromJson(json.loads(r["columns"])).fields if c.name not in known]
            if r["kind"] == BATCH and not _within(covered.get(r["run"], []), r["batch"]):
                first.setdefault((r["run"], r["batch"]), r["attempt"])
        if not rows and self.ddl:
            columns = list(S.struct(self.ddl).fields)
        batches = tuple((run, b, a) for (run, b), a in sorted(first.items()))
        schema = StructType(columns) if columns else None
        if base is None:
            return Snapshot(batches=batches, schema=schema)
        return Snapshot(base["version"], base["buckets"], tuple(base["gens"]), base["written"], covered, batches, schema)

    def _commit(self, spark: SparkSession, **row) -> None:
        names = S.struct(COMMIT_DDL).fieldNames()
        frame = spark.createDataFrame([tuple(row.get(n) for n in names)], COMMIT_DDL)
        # one file: all or nothing; a folder of its own: jobs that write to one folder at the same time
        # would clear each other's temporary files
        frame.coalesce(1).write.parquet(f"{self.path}/commits/commit=c{uuid.uuid4().hex}")

    # ------------------------------------------------------------------ writing
    def write_batch(self, df: DataFrame, batch_id: int, run_id: str, metrics: Observation | None = None) -> dict[str, str | None] | None:
        """Batch body: H3 dedupe within the batch, write its folder, then commit it. A batch that is
        committed already is left as it is. ``metrics`` that observe ``df`` are measured by the write
        itself and travel in the commit row: both are there, or neither. Returns what was measured, None
        where nothing was (a batch committed before)."""
        spark = df.sparkSession
        if run_id not in self._known:  # a run has one writer, which knows its own commits after that
            at = self.snapshot(spark)
            self._known[run_id] = {b for r, b, _ in at.batches if r == run_id}
            self._known[run_id] |= {b for lo, hi in at.covered.get(run_id, []) for b in range(lo, hi + 1)}
        if batch_id in self._known[run_id]:
            return None
        attempt = uuid.uuid4().hex
        rows = latest_per_key(df.filter(F.col(self.key).isNotNull()), self.key, self.order)
        rows.write.parquet(f"{self._folder(run_id, batch_id, attempt)}")
        seen = {k: None if v is None else str(v) for k, v in metrics.get.items()} if metrics else None
        self._commit(spark, kind=BATCH, run=run_id, batch=batch_id, attempt=attempt, columns=rows.schema.json(), metrics=seen)
        self._known[run_id].add(batch_id)
        return seen

    def _folder(self, run: str, batch: int, attempt: str) -> str:
        return f"{self.path}/batches/{RUN_COL}={quote(run, safe='')}/{BATCH_COL}={batch}/attempt={attempt}"

    def metrics(self, spark: SparkSession) -> DataFrame:
        """run, batch, metrics (map of text) of every committed batch, compacted or not."""
        rows = read_state(spark, f"{self.path}/commits", COMMIT_DDL).filter(F.col("kind") == BATCH)
        return rows.groupBy(RUN_COL, BATCH_COL).agg(F.min_by("metrics", "attempt").alias("metrics"))

    # ------------------------------------------------------------------ reading
    def _columns(self, at: Snapshot) -> StructType:
        if at.schema is None:
            raise ValueError(f"nothing was committed to {self.path} and its columns are not declared")
        names = {RUN_COL, BATCH_COL, "attempt", "gen"}
        return StructType([f for f in at.schema.fields if f.name not in names])

    def _tagged(self, at: Snapshot) -> StructType:
        return StructType([*self._columns(at).fields, StructField(RUN_COL, StringType()), StructField(BATCH_COL, LongType())])

    def _changes(self, spark: SparkSession, at: Snapshot) -> DataFrame:
        """Rows of the batches beyond the base, with run and batch. Only their folders are listed."""
        tagged = self._tagged(at)
        if not at.batches:
            return spark.createDataFrame([], tagged)
        read = spark.read.schema(StructType([*tagged.fields, StructField("attempt", StringType())]))
        return read.option("basePath", f"{self.path}/batches").parquet(*[self._folder(*b) for b in at.batches]).drop("attempt")

    def read_log(self, spark: SparkSession) -> DataFrame:
        """Every committed row beyond the base, with its run and batch."""
        return self._changes(spark, self.snapshot(spark))

    def _base_table(self, spark: SparkSession, at: Snapshot) -> str:
        """The session's name for the base: a bucketed table over its folder. It holds no data of
        its own, and is made anew in every session that needs it."""
        tagged = self._tagged(at)
        mark = hashlib.sha256(f"{self.path} {at.buckets} {tagged.json()}".encode()).hexdigest()[:16]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.fields)
        place = f"{self.path}/base".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS domus_base_{mark} ({columns}, gen BIGINT) USING parquet PARTITIONED BY (gen) "
                  f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {at.buckets} BUCKETS LOCATION '{place}'")
        return f"domus_base_{mark}"

    def _bucket(self, at: Snapshot) -> Column:
        return F.pmod(F.hash(self.key), F.lit(at.buckets))  # the hash that Spark buckets by

    def _base(self, spark: SparkSession, at: Snapshot) -> DataFrame:
        """Current rows of the base: of every bucket the generation that the snapshot names."""
        name, gens = self._base_table(spark, at), sorted({g for g in at.gens if g >= 0})
        for gen in gens:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (gen = {gen})")
        rows = spark.table(name).filter(F.col("gen").isin(gens))
        if at.written > sum(g >= 0 for g in at.gens):  # some generation holds superseded buckets
            held = F.from_json(F.lit(str(list(at.gens))), "array<bigint>")  # folds to one literal
            rows = rows.filter(F.get(held, self._bucket(at)) == F.col("gen"))
        return rows.drop("gen")

    def _total_order(self) -> list[str | Column]:
        return [*self.order, F.col(BATCH_COL), F.col(RUN_COL)]

    def _merged(self, spark: SparkSession, at: Snapshot, base: DataFrame | None, changes: DataFrame) -> DataFrame:
        """Base and changes as one row per key. The base stays where it is: the changes (one row per
        key and batch at most) are shuffled into its buckets and joined there."""
        alone = len(at.batches) <= 1  # a batch holds one row per key
        if base is None:
            # a key has one row per batch at most: combining before the exchange would only sort the rows twice
            return changes if alone else latest_per_key(changes.repartition(self.key), self.key, self._total_order())
        if not at.batches:
            return base
        new = changes.repartition(at.buckets, self.key)
        new = new if alone else latest_per_key(new, self.key, self._total_order())
        names = [f.name for f in self._tagged(at).fields]
        rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in self._total_order()])
        pack = lambda df, name: df.select(F.col(self.key), F.struct(*names).alias(name), rank.alias(f"{name}_rank"))
        both = pack(base, "old").join(pack(new, "new"), self.key, "full_outer")
        newer = F.col("old").isNull() | (F.col("new").isNotNull() & (F.col("new_rank") >= F.col("old_rank")))
        kept = both.select(F.when(newer, F.col("new")).otherwise(F.col("old")).alias("kept"))
        return kept.select(*[F.col(f"kept.`{n}`").alias(n) for n in names])

    def _current(self, spark: SparkSession, at: Snapshot) -> DataFrame:
        return self._merged(spark, at, self._base(spark, at) if at.version else None, self._changes(spark, at))

    def latest(self, spark: SparkSession, at: Snapshot | None = None) -> DataFrame:
        """The keyed table: newest version per key across the base and every committed batch, as of a
        snapshot (by default one of now). A table that nothing was committed to is empty."""
        return self._current(spark, at or self.snapshot(spark)).drop(RUN_COL, BATCH_COL)

    # ------------------------------------------------------------------ compaction
    def compact_in_place(self, spark: SparkSession, at: Snapshot | None = None) -> int:
        """Merge the batches that a snapshot (by default one of now) names into its base, rewriting only
        the buckets they change; returns the base's version. What is committed after the snapshot
        stays beside the new base. One number per bucket comes to the driver."""
        at = at or self.snapshot(spark)
        if at.version and not at.batches:
            return at.version
        changes = self._changes(spark, at)
        if not at.version:
            n = self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            at = replace(at, buckets=n, gens=(-1,) * n)
            touched = list(range(n))
            rows = self._merged(spark, at, None, changes)
        else:
            touched = sorted(r[0] for r in changes.select(self._bucket(at)).distinct().collect())
            if at.written + len(touched) > 2 * at.buckets:
                touched = list(range(at.buckets))
            base = self._base(spark, at)
            if len(touched) < at.buckets:
                chosen = F.from_json(F.lit(str(touched)), "array<int>")
                base = base.filter(F.array_contains(chosen, self._bucket(at)))
            rows = self._merged(spark, at, base, changes)
        # a merge is done in the base's own buckets: its rows need no further exchange
        gen, covered = self._write_base(spark, at, rows, dealt=at.version > 0), dict(at.covered)
        for run in {r for r, _, _ in at.batches}:
            covered[run] = _joined(covered.get(run, []) + [(b, b) for r, b, _ in at.batches if r == run])
        gens = [gen if b in set(touched) else g for b, g in enumerate(at.gens)]
        written = len(touched) if len(touched) == at.buckets else at.written + len(touched)
        self._commit(spark, version=at.version + 1, kind=BASE, attempt=uuid.uuid4().hex, columns=self._columns(at).json(),
                     buckets=at.buckets, gens=gens, written=written, covered=covered)
        return at.version + 1

    def _write_base(self, spark: SparkSession, at: Snapshot, rows: DataFrame, dealt: bool = False) -> int:
        """Rows as a new generation, one file per bucket (``dealt``: rows lie in the buckets already)."""
        gen, name = uuid.uuid4().int >> 66, self._base_table(spark, at)
        ready = (rows if dealt else rows.repartition(at.buckets, self.key)).withColumn("gen", F.lit(gen).cast("bigint"))
        ready.select(*spark.table(name).columns).write.insertInto(name)
        return gen

    def compact(self, spark: SparkSession, out_path: str) -> str:
        """Write the current rows as the base of a fresh table at ``out_path`` and return it."""
        out = replace(self, path=out_path)
        if not read_state(spark, f"{out_path}/commits", COMMIT_DDL).isEmpty():
            raise ValueError(f"{out_path} holds a table already")
        at = self.snapshot(spark)
        n = at.buckets or self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        fresh = Snapshot(buckets=n, gens=(-1,) * n, schema=at.schema)
        gen = out._write_base(spark, fresh, self._current(spark, at))
        out._commit(spark, version=1, kind=BASE, attempt=uuid.uuid4().hex, columns=self._columns(at).json(),
                    buckets=n, gens=[gen] * n, written=n, covered={})
        return out_path

