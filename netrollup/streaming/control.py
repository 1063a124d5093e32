"""Watching and stopping streams: a progress listener, stops between batches, a console preview."""

from __future__ import annotations

import logging
import threading
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

_LOG = logging.getLogger("netrollup")


class StopRequested(Exception):
    """Raised in place of a batch that was to begin after a stop request."""


class BatchGate:
    """A batch function that can be closed: after ``close`` no batch begins.

    A batch that Spark has planned in the meantime is turned away before it writes anything, and so
    is not committed: a restart runs it.
    """

    def __init__(self, work: Callable[[DataFrame, int], None]):
        self._work, self._lock = work, threading.Lock()
        self._closed, self.running, self.last = False, None, None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with self._lock:
            if self._closed:
                raise StopRequested(f"batch {batch_id} begins after a stop request")
            self.running = batch_id
        try:
            self._work(batch, batch_id)
            self.last = batch_id
        finally:
            self.running = None

    def close(self) -> None:
        with self._lock:
            self._closed = True


_gates: dict[str, BatchGate] = {}


def start_batches(frame: DataStreamWriter, work: Callable[[DataFrame, int], None],
                  start: Callable[[DataStreamWriter], StreamingQuery]) -> StreamingQuery:
    """Start ``foreachBatch`` with a gate that ``stop_gracefully`` finds."""
    gate = BatchGate(work)
    query = start(frame.foreachBatch(gate))
    _gates[query.id] = gate
    return query


def stop_gracefully(query: StreamingQuery, timeout_s: float = 600.0) -> None:
    """Stop between two batches: the one in flight is written and committed, none begins after it.

    After ``timeout_s``, stop anyway; a batch cut short is run again on restart and lands on the
    same keys.
    """
    gate, deadline = _gates.pop(query.id, None), time.monotonic() + timeout_s
    if gate is not None:
        gate.close()

    def busy() -> bool:
        if gate is None:
            return query.status["isTriggerActive"]
        if gate.running is not None:
            return True
        # Written; the commit follows, and then the progress report.
        said = query.lastProgress
        return gate.last is not None and (said is None or said["batchId"] < gate.last)

    while query.isActive and busy() and time.monotonic() < deadline:
        time.sleep(0.02)
    query.stop()
    error = query.exception()
    if error is not None and "StopRequested" not in str(error):
        raise error


class ProgressLog(StreamingQueryListener):
    """Keeps the last progress of every query, and logs what needs a look: how a query ended, lines
    that the watermark has turned away, batches that take longer than their trigger."""

    def __init__(self, keep: int = 100, slow_s: float | None = None):
        self.keep, self.slow_s = keep, slow_s
        self.progress: dict[str, deque] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self.progress.setdefault(str(event.id), deque(maxlen=self.keep))
        self.ended.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        said = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in said.stateOperators)
        seconds = said.batchDuration / 1000
        row = {
            "batch": said.batchId, "rows": said.numInputRows, "seconds": seconds,
            "watermark": said.eventTime.get("watermark"), "dropped": dropped,
            "state_rows": sum(s.numRowsTotal for s in said.stateOperators),
            "end": [s.endOffset for s in said.sources],
        }
        self.progress.setdefault(str(said.id), deque(maxlen=self.keep)).append(row)
        name = said.name or said.id
        if dropped:
            _LOG.warning("%s: batch %d: the watermark turned rows away", name, said.batchId)
        if self.slow_s is not None and seconds > self.slow_s:
            _LOG.warning("%s: batch %d took %.1f s", name, said.batchId, seconds)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception
        if event.exception and "StopRequested" not in event.exception:
            _LOG.error("query %s ended: %s", event.id, event.exception.splitlines()[0])


def watch(spark: SparkSession, **options) -> ProgressLog:
    """A listener to all streams of the session."""
    listener = ProgressLog(**options)
    spark.streams.addListener(listener)
    return listener


def preview_stream(rows: DataFrame, n: int = 20, name: str | None = None) -> StreamingQuery:
    """Print the first rows of every batch, untruncated.  Keeps no progress; for debugging."""
    writer = rows.writeStream.outputMode("append").format("console") \
        .option("numRows", n).option("truncate", "false")
    return (writer.queryName(name) if name else writer).start()
