"""Structured Streaming: stream == batch, restart processes nothing twice, quarantine,
inactivity stop, listener clean-up."""

import datetime as dt
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from domus import schemas as S
from domus.operators import decode
from domus.sinks.changelog import ChangeLog
from domus.streaming import job
from domus.streaming.listener import InactivityListener
from domus.sources.endpoints import MESSAGE_ORDER, read_message_files


def _msg(code, price, **kw):
    d = {"propertyCode": code, "price": price, "rooms": 1, "parkingSpace": {"hasParkingSpace": True},
         "detailedType": {"typology": "flat"}, **kw}
    return json.dumps(d)


def _land(root, name, lines, date="2024-05-21", page=1):
    """One message file: the lines of one page, in order."""
    os.makedirs(root, exist_ok=True)
    n = len(lines)
    pq.write_table(pa.table({"page_date": pa.array([dt.date.fromisoformat(date)] * n), "page_no": pa.array([page] * n, pa.int64()),
                             "pos": pa.array(range(n), pa.int32()), "key": pa.nulls(n, pa.string()), "value": lines}),
                   os.path.join(root, name.replace(".txt", ".parquet")))


def _run(spark, tmp, log, quarantine=True, collect_events=False):
    stream = read_message_files(spark, tmp + "/in", max_files_per_trigger=1)
    fn = job.publish_batch_fn(log, MESSAGE_ORDER, tmp + "/quarantine" if quarantine else None)
    return job.run_stream(spark, stream, fn, tmp + "/ckpt", collect_events=collect_events)


def test_stream_equals_batch_and_restart_is_idempotent(spark, tmp):
    _land(tmp + "/in", "m1.txt", [_msg("a", 1.0), _msg("b", 2.0), "junk"])
    _land(tmp + "/in", "m2.txt", [_msg("a", 3.0), _msg("c", None)], page=2)
    log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
    run = _run(spark, tmp, log)
    assert run.batches == 2
    got = {r["propertycode"]: r["price"] for r in log.latest(spark).collect()}
    assert got == {"a": 3.0, "b": 2.0, "c": None}
    # batch semantics on the same rows
    batch = decode.decode_and_publish(read_message_files(spark, tmp + "/in", streaming=False))
    assert batch.filter("propertycode IS NOT NULL").count() == 4 and batch.count() == 5
    assert [r["value"] for r in spark.read.parquet(tmp + "/quarantine").collect()] == ["junk"]
    rows_before = log.read_log(spark).count()
    # restart on the same checkpoint: nothing new, nothing reprocessed
    run2 = _run(spark, tmp, log)
    assert run2.batches == 0 and log.read_log(spark).count() == rows_before
    # a new file after restart is picked up as the next batch
    _land(tmp + "/in", "m3.txt", [_msg("b", 9.0), _msg("a", 0.5)], date="2024-05-21", page=1)
    _land(tmp + "/in", "m4.txt", [_msg("b", 9.0)], date="2024-05-22")
    _run(spark, tmp, log)
    got = {r["propertycode"]: r["price"] for r in log.latest(spark).collect()}
    assert got == {"a": 3.0, "b": 9.0, "c": None}


def test_listener_removed_and_events_seen(spark, tmp):
    _land(tmp + "/in", "m1.txt", [_msg("a", 1.0)])
    log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
    n_before = len(spark.streams._jsqm.listListeners()) if hasattr(spark.streams, "_jsqm") else None
    run = _run(spark, tmp, log, quarantine=False, collect_events=True)
    kinds = {k for k, _ in run.events}
    assert "started" in kinds and "progress" in kinds
    if n_before is not None:
        assert len(spark.streams._jsqm.listListeners()) == n_before


def test_inactivity_stops_query_by_id(spark, tmp):
    _land(tmp + "/in", "m1.txt", [_msg("a", 1.0)])
    log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
    stream = read_message_files(spark, tmp + "/in")
    t0 = time.time()
    run = job.run_stream(spark, stream, job.publish_batch_fn(log, MESSAGE_ORDER), tmp + "/ckpt", available_now=False,
                         processing_time="1 second", inactivity_timeout=3.0, poll_interval=0.5)
    assert run.stopped_for_inactivity
    assert time.time() - t0 < 60
    assert log.latest(spark).count() == 1
    assert not spark.streams.active


def test_watchdog_waits_for_a_batch_longer_than_the_timeout(spark, tmp):
    # No progress event arrives while a batch runs; the watchdog must not cut the batch.
    _land(tmp + "/in", "m1.txt", [_msg("a", 1.0)])
    log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
    fn = job.publish_batch_fn(log, MESSAGE_ORDER)
    done = []

    def slow(df, batch_id, run_id):
        time.sleep(3.0)
        fn(df, batch_id, run_id)
        done.append(batch_id)

    run = job.run_stream(spark, read_message_files(spark, tmp + "/in"), slow, tmp + "/ckpt", available_now=False,
                         processing_time="200 milliseconds", inactivity_timeout=1.0, poll_interval=0.2)
    assert run.stopped_for_inactivity
    assert done == [0]
    assert log.latest(spark).count() == 1


def test_watchdog_stops_a_query_on_an_empty_source(spark, tmp):
    # Nothing ever arrives: no progress event, but no-data triggers report idle events,
    # so the query is stopped (and never before its first trigger completed).
    os.makedirs(tmp + "/in")
    stream = read_message_files(spark, tmp + "/in")
    t0 = time.time()
    run = job.run_stream(spark, stream, lambda df, b, r: None, tmp + "/ckpt", available_now=False,
                         processing_time="200 milliseconds", inactivity_timeout=1.0,
                         poll_interval=0.2, collect_events=True)
    assert run.stopped_for_inactivity and run.batches == 0
    assert ("idle", run.query_id) in run.events
    assert time.time() - t0 < 60


def test_listener_clock_ignores_idle():
    now = [0.0]
    lst = InactivityListener(clock=lambda: now[0])

    class E:
        id = "q"

    lst.onQueryStarted(E())
    now[0] = 5.0
    assert not lst.found_no_data("q")
    lst.onQueryIdle(E())
    assert lst.idle_seconds("q") == 5.0 and lst.found_no_data("q")

    class P:
        class progress:
            id = "q"

    lst.onQueryProgress(P())
    assert lst.idle_seconds("q") == 0.0 and not lst.found_no_data("q") and lst.events == []
    lst.onQueryTerminated(E())
    assert lst.idle_seconds("q") is None


def test_checkpoint_is_required(spark):
    with pytest.raises(ValueError):
        job.run_stream(spark, spark.range(1), lambda d, i, r: None, "")


def test_every_batch_is_counted(spark, tmp):
    os.makedirs(tmp + "/in")
    for i in range(120):
        _land(tmp + "/in", f"m{i}.txt", [_msg(f"k{i}", 1.0)])
    run = job.run_stream(spark, read_message_files(spark, tmp + "/in", max_files_per_trigger=1), lambda df, b, r: None, tmp + "/ckpt")
    assert run.batches == 120


@pytest.mark.parametrize("fails_after", ["log", "quarantine"])
def test_a_replayed_batch_of_new_objects_changes_nothing(spark, tmp, fails_after):
    """The batch dies after one of its writes; the restart, with new objects throughout, replays
    it: the log and the quarantine hold every row once."""
    _land(tmp + "/in", "m1.txt", [_msg("a", 1.0), "junk", _msg("b", 2.0)])

    def start(fail):
        log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
        fn = job.publish_batch_fn(log, MESSAGE_ORDER, tmp + "/q" if fails_after == "quarantine" or not fail else None)

        def flaky(df, batch_id, run_id):
            fn(df, batch_id, run_id)
            if fail:
                raise RuntimeError("lost after the write, before the commit")

        return job.run_stream(spark, read_message_files(spark, tmp + "/in"), flaky, tmp + "/ckpt")

    with pytest.raises(StreamingQueryException):
        start(True)
    start(False)
    log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
    assert log.read_log(spark).count() == 2 and spark.read.parquet(tmp + "/q").count() == 1
    assert {r["propertycode"]: r["price"] for r in log.latest(spark).collect()} == {"a": 1.0, "b": 2.0}


def test_quarantine_kept_across_streams(spark, tmp):
    for i in (0, 1):
        _land(f"{tmp}/in{i}", "m.txt", [_msg(f"k{i}", 1.0), f"junk{i}"])
        log = ChangeLog(tmp + "/log", key=S.PUBLISHED_KEY, order=MESSAGE_ORDER)
        # another checkpoint is another run: batch ids restart at 0 and overwrite nothing
        job.run_stream(spark, read_message_files(spark, f"{tmp}/in{i}"), job.publish_batch_fn(log, MESSAGE_ORDER, tmp + "/q"), f"{tmp}/ckpt{i}")
    assert {r["value"] for r in spark.read.parquet(tmp + "/q").collect()} == {"junk0", "junk1"}
    assert log.latest(spark).count() == 2


def test_a_batch_without_bad_messages_is_not_read_again_for_the_quarantine(spark, tmp):
    log = ChangeLog(tmp + "/table", key="propertycode", order=list(MESSAGE_ORDER))
    fn = job.publish_batch_fn(log, list(MESSAGE_ORDER), tmp + "/q")
    frame = lambda *texts: spark.createDataFrame([(t, None, n, 0) for n, t in enumerate(texts)],
                                                 "value string, page_date date, page_no long, pos int")
    fn(frame('{"propertyCode":"a"}', '{"propertyCode":"b"}'), 0, "r")
    assert not os.path.exists(tmp + "/q")
    fn(frame('{"propertyCode":"a"}', "junk"), 1, "r")
    assert [r.value for r in spark.read.parquet(tmp + "/q").collect()] == ["junk"]
    # the same batch again, by a writer that finds it committed but not put aside
    job.publish_batch_fn(ChangeLog(tmp + "/table", key="propertycode", order=list(MESSAGE_ORDER)), list(MESSAGE_ORDER), tmp + "/q2")(
        frame('{"propertyCode":"a"}', "junk"), 1, "r")
    assert [r.value for r in spark.read.parquet(tmp + "/q2").collect()] == ["junk"]
    assert {r.propertycode for r in log.latest(spark).collect()} == {"a", "b"}


def test_versions_of_several_batches_are_sorted_once(spark, tmp):
    log = ChangeLog(tmp + "/table", key="k", order=["n"])
    for batch in range(3):
        log.write_batch(spark.createDataFrame([("a", batch), ("b", -batch)], "k string, n long"), batch, "r")
    latest = log.latest(spark)
    assert {(r.k, r.n) for r in latest.collect()} == {("a", 2), ("b", 0)}
    plan = latest._jdf.queryExecution().sparkPlan().toString()
    assert "RepartitionBy" in latest._jdf.queryExecution().optimizedPlan().toString(), plan
