"""Stop a streaming query after a period without progress.

The listener refreshes a per-query clock on start and on every progress event (a
micro-batch ran). An idle event tells that a trigger found no data. A daemon thread stops
the query *by id* once such an event has followed the last progress and the clock has stood
longer than the timeout: quiet alone, as while events are late or a batch is long, is not
taken for the end of the data.
"""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class InactivityListener(StreamingQueryListener):
    def __init__(self, collect: bool = False, clock=time.monotonic):
        self._clock, self._collect = clock, collect
        self._last: dict[str, float] = {}
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}
        self._idle: set[str] = set()  # queries whose last event was a trigger without data
        self.events: list[tuple[str, str]] = []

    def _ended_flag(self, qid: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(qid, threading.Event())

    def wait_terminated(self, qid: str, timeout: float) -> bool:
        """Block until this listener has seen the query's terminated event (bus is async)."""
        return self._ended_flag(qid).wait(timeout)

    def _note(self, kind: str, qid: str) -> None:
        if self._collect:
            self.events.append((kind, qid))

    def _touch(self, qid: str) -> None:
        with self._lock:
            self._last[qid] = self._clock()

    def onQueryStarted(self, event) -> None:
        self._note("started", str(event.id))
        self._touch(str(event.id))

    def onQueryProgress(self, event) -> None:
        self._note("progress", str(event.progress.id))
        self._touch(str(event.progress.id))
        with self._lock:
            self._idle.discard(str(event.progress.id))

    def onQueryIdle(self, event) -> None:
        self._note("idle", str(event.id))
        with self._lock:
            self._idle.add(str(event.id))

    def found_no_data(self, qid: str) -> bool:
        """Has a trigger found no data since the query's last progress?"""
        with self._lock:
            return qid in self._idle

    def onQueryTerminated(self, event) -> None:
        self._note("terminated", str(event.id))
        with self._lock:
            self._last.pop(str(event.id), None)
        self._ended_flag(str(event.id)).set()

    def idle_seconds(self, qid: str) -> float | None:
        with self._lock:
            t = self._last.get(qid)
        return None if t is None else self._clock() - t


class InactivityStopper:
    """Watch one query; stop it when ``listener`` has seen no progress for ``timeout`` s."""

    def __init__(self, spark: SparkSession, listener: InactivityListener, timeout: float,
                 poll_interval: float):
        self.spark, self.listener = spark, listener
        self.timeout, self.poll_interval = timeout, poll_interval
        self._done = threading.Event()
        self.stopped_for_inactivity = False

    def watch(self, query_id: str) -> threading.Thread:
        t = threading.Thread(target=self._loop, args=(query_id,), daemon=True, name="inactivity-stopper")
        t.start()
        return t

    def _loop(self, qid: str) -> None:
        while not self._done.wait(self.poll_interval):
            q = self.spark.streams.get(qid)
            if q is None or not q.isActive:
                return
            # Stop only after a trigger that found no data, and not while one runs with data.
            status = q.status
            if not self.listener.found_no_data(qid) or (
                    status.get("isTriggerActive") and status.get("isDataAvailable")):
                continue
            idle = self.listener.idle_seconds(qid)
            if idle is not None and idle > self.timeout:
                log.info("no progress for %.1fs, stopping query %s", idle, qid)
                self.stopped_for_inactivity = True
                q.stop()
                return

    def close(self) -> None:
        self._done.set()
