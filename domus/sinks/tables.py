"""Table sinks: append by format, DDL, landing write, manifest append, marker versions, messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import schemas as S
from domus.functions.timefn import ts_literal
from domus.functions.zorder import z_key
from domus.sources.endpoints import MESSAGE_ORDER, KafkaEndpoint
from domus.sources.tables import range_count, read_state


def append(df: DataFrame, fmt: str = "parquet", path: str | None = None,
           options: dict[str, str] | None = None) -> None:
    """B2: append a (micro-)batch to any table by format + options."""
    w = df.write.format(fmt).mode("append").options(**(options or {}))
    w.save(path) if path else w.save()


def create_table(spark: SparkSession, name: str, location: str, ddl: str = S.PUBLISHED_DDL,
                 fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the declared columns (idempotent)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt} LOCATION '{location}'")


def write_landing(pages: DataFrame, path: str) -> None:
    """Land page documents (columns page_date, value = envelope JSON with actualPage).

    One envelope per line under ``page_date=<d>/``, dynamic partition overwrite: re-landing
    a date replaces that date's page set, as a same-day re-pull rewrote the same objects.
    The ``rebalance`` hint lets AQE size the write tasks from measured shuffle sizes: small
    dates are coalesced into few files and a date holding a third of all pages is split
    over several tasks (``optimizeSkewsInRebalancePartitions``) instead of one.
    """
    (pages.select("page_date", "value")
     .hint("rebalance", "page_date")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("page_date")
     .text(path))


def append_manifest(rows: DataFrame, path: str) -> None:
    """Record processed file names under their page date, so that a batch reads only its own
    dates. Call only after the data write has committed."""
    (rows.select("page_date", "file_name", F.col("processed_at").cast("timestamp"))
     .write.mode("append").partitionBy("page_date").parquet(path))


def write_marker(spark: SparkSession, path: str, now: dt.datetime) -> None:
    """The last-pull marker becomes ``now`` (wall-clock text read in the session zone, so the
    driver process's own time zone cannot shift it). Appends a version, see :func:`advance_marker`."""
    spark.range(1).select(ts_literal(now, "timestamp").alias("pulled_at")).write.mode("append").parquet(path)


def advance_marker(committed: DataFrame, path: str, ts_col: str) -> None:
    """B7 after a commit: the marker becomes the latest pull time among the committed rows.

    Each call appends one version row (the executors reduce the rows to their maximum; no
    value passes through the driver), and readers take the greatest version, so the marker
    is never overwritten while being read and never moves backwards. An empty commit appends
    nothing and the marker stays where it was.
    """
    (committed.agg(F.max(F.col(ts_col)).cast("timestamp").alias("pulled_at"))
     .filter(F.col("pulled_at").isNotNull())
     .write.mode("append").parquet(path))


def read_marker(spark: SparkSession, path: str) -> DataFrame:
    """The current marker as one row ``pulled_at`` (NULL when no pull was ever committed)."""
    return read_state(spark, path, S.MARKER_DDL).agg(F.max("pulled_at").alias("pulled_at"))


def insert_into(df: DataFrame, table: str) -> None:
    """B2 into a catalog table made by :func:`create_table`: columns are matched by the
    table's own names (``insertInto`` is positional), then appended."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table)


def write_messages(df: DataFrame, ep: KafkaEndpoint | None = None, path: str | None = None,
                   key: str = "propertyCode", batch_id: int | None = None,
                   run_id: str | None = None) -> None:
    """B1: one message per row (``value`` = raw element JSON), keyed by the listing id.

    The columns of MESSAGE_ORDER go with the message (absent ones as NULL): as columns of the
    message files, as headers to a broker. They order versions of a key; the order in which
    tasks happen to write does not. Files of a micro-batch go to ``run=<r>/batch=<b>/``
    with dynamic overwrite, so a replayed batch replaces its own messages.
    """
    text = F.col("value").cast("string")
    key_col = F.get_json_object(text, f"$.{key}") if key else F.lit(None).cast("string")
    order = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
             for c, t in zip(MESSAGE_ORDER, ("date", "bigint", "int"))]
    out = df.select(*order, key_col.alias("key"), text.alias("value"))
    if ep is not None:
        head = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
                         for c in MESSAGE_ORDER])
        out.select("key", "value", head.alias("headers")).write.format("kafka").options(**ep.write_options()).save()
    elif path is not None and batch_id is not None:
        if run_id is None:
            raise ValueError("a per-batch message write needs the run id too")
        (out.withColumn("run", F.lit(run_id)).withColumn("batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "batch").parquet(path))
    elif path is not None:
        out.write.mode("append").parquet(path)
    else:
        raise ValueError("need a broker endpoint or a path")


def write_snapshot(rows: DataFrame, path: str, partitions: int | None = None,
                   lat: str = "latitude", lon: str = "longitude", key: str = S.PUBLISHED_KEY) -> None:
    """Listings as a plain table clustered by location (new folder): range-partitioned and sorted
    by the Z-order key of the point, so every file and row group covers a small tile and a radius
    search skips the others by their min/max statistics of both coordinates. The unique
    listing key in the range key lets one point holding a third of all listings still split over
    many tasks."""
    near = z_key(lat, lon)
    (rows.repartitionByRange(partitions or range_count(rows), near, key).sortWithinPartitions(near, key)
     .write.mode("errorifexists").parquet(path))


def append_page_runs(runs: DataFrame, path: str) -> None:
    """E3 state: the page runs of one batch (see :func:`domus.operators.pages.page_runs`) under their
    dates. Runs only say which pages were seen, so a replayed batch changes nothing."""
    runs.hint("rebalance", "page_date").write.mode("append").partitionBy("page_date").parquet(path)


def append_manifest_bitmaps(bitmaps: DataFrame, path: str) -> None:
    """B6 as bitmaps (see :func:`domus.operators.incremental.manifest_bitmaps`), under their dates.
    Bitmaps of several batches are united on reading, so a replay changes nothing."""
    bitmaps.hint("rebalance", "page_date").write.mode("append").partitionBy("page_date").parquet(path)
