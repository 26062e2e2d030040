"""Run a streaming job: foreachBatch sink, append mode, trigger, checkpoint, watchdog.

``publish_batch_fn`` is the upstream job's batch: messages -> decode -> published projection
and quarantine -> keyed change log. Everything is planned per micro-batch
by Catalyst; the only driver-side code is the batch callback choosing where to write.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from domus import schemas as S
from domus.operators.decode import decode_and_publish
from domus.sinks.changelog import BATCH_COL, RUN_COL, ChangeLog
from domus.streaming.listener import InactivityListener, InactivityStopper

# (batch, batch id, run id)
BatchFn = Callable[[DataFrame, int, str], None]


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a stream's checkpoint: the same after every restart, and another
    for every other checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


@dataclass
class StreamRun:
    query_id: str
    batches: int
    stopped_for_inactivity: bool
    events: list[tuple[str, str]]


def run_stream(
    spark: SparkSession,
    df: DataFrame,
    on_batch: BatchFn,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    inactivity_timeout: float | None = None,
    poll_interval: float = 10.0,
    collect_events: bool = False,
) -> StreamRun:
    """Start ``df`` -> foreachBatch(on_batch) in append mode and wait for it to end.

    A checkpoint is required: it records source offsets / processed files and the batch
    ids, so a restart resumes instead of replaying from the start. ``available_now`` ends
    the query once everything present at start is processed; otherwise the query runs until
    stopped, e.g. by the inactivity watchdog. The listener is always removed. With
    ``collect_events`` the call also waits (bounded) for the asynchronous listener bus to
    deliver the query's last events, so ``StreamRun.events`` is complete.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    listener = InactivityListener(collect_events)
    spark.streams.addListener(listener)
    stopper, batches, run = None, [0], []

    def call(batch: DataFrame, batch_id: int) -> None:
        if not run:  # the checkpoint has its id before the first batch
            run.append(run_id_of(spark, checkpoint))
        on_batch(batch, batch_id, run[0])
        batches[0] += 1

    try:
        if inactivity_timeout is not None:
            # a no-data trigger must report itself well within the timeout
            spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", str(max(100, int(inactivity_timeout * 500))))
        w = df.writeStream.foreachBatch(call).outputMode("append").option(
            "checkpointLocation", checkpoint
        )
        if query_name:
            w = w.queryName(query_name)
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        q = w.start()
        if inactivity_timeout is not None:
            stopper = InactivityStopper(spark, listener, inactivity_timeout, poll_interval)
            stopper.watch(str(q.id))
        q.awaitTermination()
        if collect_events:
            # listener events travel on an asynchronous bus; let the last ones arrive
            listener.wait_terminated(str(q.id), timeout=10.0)
        return StreamRun(str(q.id), batches[0], bool(stopper and stopper.stopped_for_inactivity),
                         list(listener.events))
    finally:
        if stopper is not None:
            stopper.close()
        spark.streams.removeListener(listener)
        if inactivity_timeout is not None:
            spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")


def publish_batch_fn(changelog: ChangeLog, order_cols: list[str], quarantine_path: str | None = None,
                     lenient_maps: bool = False) -> BatchFn:
    """Batch body for listing messages (``value`` and ``order_cols``): listings with a key go to
    the change log, decoded from the fields that are kept; messages without one go to the
    quarantine with their raw ``value``, and only they are decoded in full. A batch whose write
    counted none is not read again for them.

    The write also counts, in the same pass, the decoded messages, those with a bad value in a field
    that is kept (``flagged``) or without a key (``quarantined``), and the newest page date;
    the counts are part of the batch's commit (:meth:`ChangeLog.metrics`)."""
    beside = tuple(S.struct(S.BESIDE_DDL).fieldNames())

    def fn(batch: DataFrame, batch_id: int, run_id: str) -> None:
        good = decode_and_publish(batch, keep=order_cols, lenient_maps=lenient_maps, beside=beside, flag_published=True)
        seen = Observation()
        newest = F.max(S.RECENCY) if S.RECENCY in order_cols else F.lit(None)
        good = good.observe(seen, F.count(F.lit(1)).alias("decoded"), F.count(S.CORRUPT_COLUMN).alias("flagged"),
                            F.count_if(F.col(S.PUBLISHED_KEY).isNull()).alias("quarantined"), newest.cast("string").alias("newest"))
        counted = changelog.write_batch(good.drop(S.CORRUPT_COLUMN), batch_id, run_id, seen)
        # the write has counted the messages without a key; a replayed batch, which it leaves alone, is looked through again
        if quarantine_path is None or (counted and counted["quarantined"] == "0"):
            return
        code = F.from_json(F.col("value").cast("string"), "propertyCode STRING")["propertyCode"]
        aside = batch.filter(code.isNull()).withColumn("value", F.col("value").cast("string"))
        # (run, batch) like the change log: a replay overwrites itself
        (decode_and_publish(aside, keep=["value", *order_cols], keep_corrupt=True, lenient_maps=lenient_maps)
         .withColumn(RUN_COL, F.lit(run_id)).withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(RUN_COL, BATCH_COL).parquet(quarantine_path))

    return fn
