"""Incremental processing: skip processed files, decide whether and how far back to pull,
and build the manifest rows for what a run has handled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.functions.timefn import BUCKET_ALL_TIME, BUCKET_NO_PULL, elapsed_days, since_bucket, ts_literal


def exclude_processed(pages: DataFrame, manifest: DataFrame, on: str = "file_name",
                      manifest_col: str | None = None) -> DataFrame:
    """Rows of ``pages`` whose name is not in the manifest (exact match).

    A left anti join; NULL names never match, so they are kept. No broadcast hint: the
    manifest grows with every run, so AQE decides from the measured size of the manifest
    side (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise shuffles both
    sides on the name. The manifest side is de-duplicated first (map-side partial
    aggregation): a name logged many times (replays, at-least-once appends) costs one row
    per map task, and AQE's skew split, which can only split the left side of an anti
    join, is never needed on the right. The de-duplicating exchange is the join's own
    hash partitioning, so a shuffled join adds no exchange for it.
    """
    mcol = manifest_col or on
    m = manifest.select(F.col(mcol).alias("_done")).distinct()
    return pages.join(m, pages[on] == m["_done"], "left_anti")


def manifest_of(manifest: DataFrame, pages: DataFrame, col: str = "page_date") -> DataFrame:
    """The manifest's rows of the dates that ``pages`` have: the manifest is partitioned by date,
    so other dates are not read. The dates of one micro-batch come to the driver, nothing else."""
    dates = [r[0] for r in pages.select(col).distinct().collect()]
    return manifest.filter(F.col(col).isin([d for d in dates if d is not None]) | F.col(col).isNull())


def manifest_bitmaps(pages: DataFrame) -> DataFrame:
    """B6 as bitmaps: (page_date, bucket, bits), one 4 kB bitmap per date and 32,768 page numbers in
    place of a row per name. Rows without a date or a positive page number have no place in it."""
    known = pages.filter(F.col("page_date").isNotNull() & (F.col("page_no") >= 1))
    return known.groupBy("page_date", F.bitmap_bucket_number("page_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page_no")).alias("bits"))


def _bit(bits: Column, position: Column) -> Column:
    """Is the bit at ``position`` of a bitmap set?"""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def exclude_processed_bits(pages: DataFrame, bitmaps: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """D1 by bit test: the pages (``page_date``, ``page_no``) whose bit is not set in the manifest's
    bitmaps. Bitmaps of several batches are united first; what is joined is one row per date
    and 32,768 pages, whatever the manifest's length. Pages whose name does not parse (no date or
    number) have no bit: they take the exact anti join on names against ``manifest``."""
    united = bitmaps.groupBy("page_date", "bucket").agg(F.bitmap_or_agg("bits").alias("_bits")) \
        .select(F.col("page_date").alias("_date"), F.col("bucket").alias("_bucket"), "_bits")
    placed = F.col("page_date").isNotNull() & F.coalesce(F.col("page_no") >= 1, F.lit(False))
    own = (F.col("page_date") == F.col("_date")) & (F.bitmap_bucket_number("page_no") == F.col("_bucket"))
    known = pages.filter(placed).join(united, own, "left")
    new = known.filter(F.col("_bits").isNull() | ~_bit(F.col("_bits"), F.bitmap_bit_position("page_no"))).select(*pages.columns)
    if manifest is None:
        return new
    return new.unionByName(exclude_processed(pages.filter(~placed), manifest).select(*pages.columns))


def pages_to_mark(pages: DataFrame, file_col: str = "file_name", now: dt.datetime | None = None) -> DataFrame:
    """B6 input: manifest rows for pages that were fully handled.

    Built from the page rows, not the exploded rows, so a page with an empty element list
    is still marked; a page whose element list is missing is not.
    """
    ts = ts_literal(now, "timestamp") if now is not None else F.current_timestamp()
    return pages.filter(F.col("envelope.elementList").isNotNull()).select(
        "page_date", F.col(file_col).alias("file_name"), ts.cast("timestamp").alias("processed_at")
    )


def with_since_bucket(df: DataFrame, last_col: str, now, days_col: str = "days",
                      bucket_col: str = "bucket") -> DataFrame:
    """C14 + C15 over a column of last-pull times against ``now`` (literal or column)."""
    n = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    return df.withColumn(days_col, elapsed_days(n, F.col(last_col))).withColumn(
        bucket_col, since_bucket(F.col(days_col))
    )


def pull_decision(spark: SparkSession, marker: DataFrame, now: dt.datetime,
                  col: str = "pulled_at") -> str | None:
    """The recency bucket for the next pull, or ``NoPull`` / None to skip.

    The marker table may have many rows (one per run); the executors reduce it to its
    latest value and compute the bucket there (wall-clock arithmetic, so the driver's time
    zone plays no part); only the bucket token reaches the driver. No marker -> AllTime.
    """
    row = marker.agg(F.max(col).alias("m")).select(
        F.col("m").isNull().alias("never"), since_bucket(elapsed_days(now, F.col("m"))).alias("bucket")
    ).first()
    return BUCKET_ALL_TIME if row["never"] else row["bucket"]


def pull_gate(bucket) -> "F.Column":
    """D8 as a Column: pull only for a real bucket (NoPull and no-bucket both skip)."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return b.isNotNull() & (b != F.lit(BUCKET_NO_PULL))


def should_pull(bucket: str | None) -> bool:
    """Pull only for a real bucket; NoPull and None skip the pull (and keep the marker)."""
    return bucket is not None and bucket != BUCKET_NO_PULL
