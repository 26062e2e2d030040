"""Runnable jobs: what a deployment launches.

* :func:`publish_job`: message stream (broker topic or message files) -> decode -> publish ->
  quarantine -> keyed change log. The upstream streaming job, with a required checkpoint and
  an optional inactivity stop.
* :func:`replay_pages_job`: landed pages -> skip pages in the manifest -> explode -> one
  message per element -> manifest append. The upstream page-to-topic producer, as one
  distributed job per micro-batch.
* :func:`search_job`: one page of search results over the published table.
* :func:`land_search_job`: every page of a search, landed one envelope per page under the
  pull date (the pull-and-land step, without the HTTP fetch).
* :func:`pull_decision_job`: read the marker, decide the recency bucket, optionally advance it.
* :func:`pull_job`: marker -> bucket gate -> every page landed -> marker advanced after the commit.
* :func:`compact_job`: the keyed table's change log rewritten as its latest rows, in a new folder.
* :func:`snapshot_job`: the current rows as a plain table clustered by location, for searches.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import schemas as S
from domus.operators import incremental, search
from domus.operators import pages as pages_op
from domus.sinks.changelog import ChangeLog, Snapshot
from domus.operators.decode import listing_element
from domus.sinks.named_pages import write_named_pages
from domus.sinks.tables import (append_manifest, write_landing, write_marker, write_messages,
                                write_snapshot)
from domus.sources.endpoints import (MESSAGE_ORDER, KafkaEndpoint, admission_bytes, read_kafka_stream,
                                     read_message_files)
from domus.sources.pages import stream_pages
from domus.sources.tables import read_state
from domus.streaming.job import StreamRun, publish_batch_fn, run_stream


# Columns of the keyed table that the publish job writes.
TABLE_DDL = f"{S.PUBLISHED_DDL}, {S.BESIDE_DDL}, page_date DATE, page_no BIGINT, pos INT"


@dataclass
class PublishPaths:
    table: str  # change log of published rows (the keyed table)
    checkpoint: str
    quarantine: str | None = None


def message_stream(spark: SparkSession, kafka: KafkaEndpoint | None = None,
                   files: str | None = None, max_files_per_trigger: int | None = None
                   ) -> tuple[DataFrame, list[str]]:
    """(stream with ``value``, columns that order versions of a key): the page date, page number
    and position that each message carries; from a broker then partition and offset."""
    if kafka is not None:
        return read_kafka_stream(spark, kafka), [*MESSAGE_ORDER, "partition", "offset"]
    if files is None:
        raise ValueError("need a broker endpoint or a message folder")
    df = read_message_files(spark, files, max_files_per_trigger,
                            max_bytes_per_trigger=None if max_files_per_trigger else admission_bytes(spark))
    return df, list(MESSAGE_ORDER)


def publish_job(spark: SparkSession, paths: PublishPaths, kafka: KafkaEndpoint | None = None,
                files: str | None = None, available_now: bool = True,
                processing_time: str | None = None, inactivity_timeout: float | None = None,
                poll_interval: float = 10.0, max_files_per_trigger: int | None = None,
                lenient_maps: bool = False) -> StreamRun:
    stream, order = message_stream(spark, kafka, files, max_files_per_trigger)
    log = ChangeLog(paths.table, key=S.PUBLISHED_KEY, order=order)
    return run_stream(spark, stream, publish_batch_fn(log, order, paths.quarantine, lenient_maps), paths.checkpoint,
                      available_now=available_now, processing_time=processing_time, query_name=None,
                      inactivity_timeout=inactivity_timeout, poll_interval=poll_interval)


def _table_log(spark: SparkSession, table: str) -> tuple[ChangeLog, Snapshot]:
    """The table at a folder, ordered by those of the order columns that it has, and what it holds now."""
    log = ChangeLog(table, key=S.PUBLISHED_KEY, order=list(MESSAGE_ORDER), ddl=TABLE_DDL)
    at = log.snapshot(spark)
    log.order = [c for c in (*MESSAGE_ORDER, "partition", "offset") if c in at.schema.fieldNames()]
    return log, at


def published_table(spark: SparkSession, table: str, beside: bool = False) -> DataFrame:
    """Current keyed table: the latest published row per listing. With ``beside`` also what
    searches need next to the published columns: country, operation and the page date."""
    cols = S.struct(S.PUBLISHED_DDL).fieldNames()
    more = [*S.struct(S.BESIDE_DDL).fieldNames(), S.RECENCY] if beside else []
    log, at = _table_log(spark, table)
    return log.latest(spark, at).select(*cols, *more)


def batch_metrics(spark: SparkSession, table: str) -> DataFrame:
    """Run, batch, decoded, flagged, quarantined, newest of every committed micro-batch."""
    m = F.col("metrics")
    return _table_log(spark, table)[0].metrics(spark).select(
        "run", "batch", *[m[c].cast("bigint").alias(c) for c in ("decoded", "flagged", "quarantined")], m["newest"].cast("date").alias("newest"))


def snapshot_job(spark: SparkSession, table: str, out: str, partitions: int | None = None) -> str:
    """The keyed table's current rows as a plain table at ``out`` (new folder), clustered by
    location (see :func:`domus.sinks.tables.write_snapshot`): every row group covers a narrow
    band and its min/max statistics let a radius search skip the rest. Searching it needs no
    aggregation and no shuffle."""
    write_snapshot(published_table(spark, table, beside=True), out, partitions)
    return out


def compact_job(spark: SparkSession, table: str, out: str | None = None) -> str:
    """Make the latest rows of the batches logged so far the keyed table's new base; readers
    switch to it by its pointer while a running publish goes on. Given ``out`` (a folder
    that must not exist), write a compacted copy there instead."""
    log, at = _table_log(spark, table)
    if out:
        return log.compact(spark, out)
    log.compact_in_place(spark, at)
    return table


def replay_pages_job(spark: SparkSession, landing: str, manifest: str, checkpoint: str,
                     kafka: KafkaEndpoint | None = None, messages: str | None = None,
                     layout: str = "named", max_files_per_trigger: int | None = None) -> StreamRun:
    """Pages -> messages. Manifest rows are appended only after the batch's messages are
    written, and are built from the page rows (an empty page is marked, a page with no
    element list is not)."""
    return run_stream(spark, _page_source(spark, landing, layout, max_files_per_trigger),
                      replay_batch_fn(manifest, kafka, messages), checkpoint)


def replay_batch_fn(manifest: str, kafka: KafkaEndpoint | None = None, messages: str | None = None):
    """Batch body of the replay: pages that the manifest lacks become messages in page order
    columns, then enter the manifest. A replayed batch overwrites its own messages; if it had
    already entered the manifest, its pages are left out, so the messages it wrote stay."""

    def on_batch(pages: DataFrame, batch_id: int, run_id: str) -> None:
        state = read_state(pages.sparkSession, manifest, S.MANIFEST_DDL)
        todo = incremental.exclude_processed(pages, incremental.manifest_of(state, pages)).persist()
        try:
            if todo.isEmpty():
                return
            rows = pages_op.explode_pages(todo, keep=["page_date", "page_no"])
            write_messages(rows.withColumnRenamed("element", "value"), ep=kafka, path=messages,
                           batch_id=batch_id if kafka is None else None, run_id=run_id)
            append_manifest(incremental.pages_to_mark(todo), manifest)
        finally:
            todo.unpersist()

    return on_batch


def _page_source(spark: SparkSession, landing: str, layout: str, max_files_per_trigger: int | None) -> DataFrame:
    return stream_pages(spark, landing, layout=layout, max_files_per_trigger=max_files_per_trigger,
                        max_bytes_per_trigger=None if max_files_per_trigger else admission_bytes(spark))


def _searched(spark: SparkSession, table: str, req: search.SearchRequest, published_at: str | None,
              snapshot: bool = False) -> tuple[DataFrame, search.SearchRequest, search.ListingColumns]:
    """The table, the request ordered by the table's recency column, and the column names. A
    predicate whose column the table lacks raises; a table without the recency column is ordered by key."""
    df = spark.read.parquet(table) if snapshot else published_table(spark, table, beside=True)
    recency = published_at or S.RECENCY
    order = recency if recency in df.columns else S.PUBLISHED_KEY
    return df, replace(req, order_by=order), search.ListingColumns(published_at=recency)


def search_job(spark: SparkSession, table: str, req: search.SearchRequest,
               published_at: str | None = None, snapshot: bool = False) -> DataFrame:
    """One page of results over the published table (distance added when a centre is set),
    newest page date first unless ``published_at`` names another recency column.

    With ``snapshot`` the table is one written by :func:`snapshot_job` and is read as is: the
    predicates reach the scan. Otherwise the change log is reduced to its latest rows first
    (predicates can only apply after that, or an older version could match).
    """
    df, req, cols = _searched(spark, table, req, published_at, snapshot)
    page = search.search(df, req, cols)
    if req.center is not None:
        page = search.with_distance(page, req.center)
    return page


def land_search_job(spark: SparkSession, table: str, req: search.SearchRequest, landing: str,
                    pull_date: dt.date, published_at: str | None = None, layout: str = "lines") -> None:
    """Every page of ``req`` over the published table, ``req.max_items`` per page in the
    request's order, landed as one envelope per page under ``page_date=<pull_date>``.
    Re-landing a date replaces it. Layout ``named`` lands one object per page under its own name
    instead, re-landing replaces objects of the same names."""
    df, req, cols = _searched(spark, table, req, published_at)
    element = listing_element(tuple(S.struct(S.BESIDE_DDL).fieldNames())).alias("element")
    # numbered by the narrow order and key; the elements' JSON is built from the rows after that
    hits = search.search_filter(df, req, cols)
    paged = search.paginate(hits, req.order_by, cols.key, descending=req.descending,
                            max_items=req.max_items, with_total=True).select("page_no", "pos", "total", element)
    pages = pages_op.page_envelopes(paged, F.lit(pull_date), max_items=req.max_items)
    (write_named_pages if layout == "named" else write_landing)(pages, landing)


def pull_job(spark: SparkSession, table: str, landing: str, marker: str, req: search.SearchRequest,
             now: dt.datetime | None = None, published_at: str | None = None, layout: str = "lines") -> dict:
    """The pull step: decide from the marker whether and how far back to pull; if so, land
    every page of the search (recency window from the bucket when the table has a
    publication time) under today's date, then advance the marker, only after the landing
    has committed. NoPull and no-bucket skip the pull and leave the marker as it is."""
    now = now or dt.datetime.now()
    bucket = incremental.pull_decision(spark, read_state(spark, marker, S.MARKER_DDL), now)
    if not incremental.should_pull(bucket):
        return {"bucket": bucket, "pulled": False}
    since = None if bucket == "AllTime" else bucket
    req = replace(req, since=since, as_of=now)
    land_search_job(spark, table, req, landing, now.date(), published_at, layout)
    write_marker(spark, marker, now)
    return {"bucket": bucket, "pulled": True}


def pull_decision_job(spark: SparkSession, marker: str, now: dt.datetime | None = None,
                      advance: bool = False) -> str | None:
    """D8 + B7: bucket for the next pull; advance the marker only when asked (after a commit)."""
    now = now or dt.datetime.now()
    bucket = incremental.pull_decision(spark, read_state(spark, marker, S.MARKER_DDL), now)
    if advance and incremental.should_pull(bucket):
        write_marker(spark, marker, now)
    return bucket
