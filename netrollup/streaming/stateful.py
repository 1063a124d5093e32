"""Event-time windows in Spark's own state: watermark, window, append mode.

A window is written once, when the watermark (the greatest event time of the batches before, less
``delay_s``) has passed its end.  A line that comes later is dropped by Spark; here it is also
kept: after a batch has dropped something, its lines are read again by the offsets that the
checkpoint has for it, and those whose window was closed go to a side table under the batch's
number.  So closed windows and late lines together hold every line, and a restart changes nothing.

``event_stream`` is the other mode: windows that late lines reopen.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netrollup.operators.parse import parse
from netrollup.operators.rollup import event_seconds, grouped_by, table_of
from netrollup.plans.batch import fields_of
from netrollup.shared import read_stage, remove, write_stage
from netrollup.sinks.documents import register
from netrollup.streaming.common import Sink, start, write_tables
from netrollup.streaming.control import start_batches, stop_gracefully
from netrollup.streaming.windows import query_id

_LOG = logging.getLogger("netrollup")
IDENTITY = ("topic", "partition", "offset")
# Reads the records between two sets of offsets, as a checkpoint's JSON has them.
RangeReader = Callable[[dict, dict], DataFrame]


def event_time(ahead_s: int) -> Column:
    """A line's time.  One that is further ahead of its arrival than ``ahead_s`` has a wrong clock
    and counts at its arrival: otherwise it would close everybody's windows."""
    at = F.timestamp_seconds(event_seconds())
    arrival = F.col("arrival")
    wrong = at > arrival + F.make_dt_interval(secs=F.lit(ahead_s))
    return F.when(wrong, arrival).otherwise(at)


def _rows(raw: DataFrame, specs, ahead_s: int, keep=()) -> DataFrame:
    topics = list(dict.fromkeys(s.topic for s in specs))
    parsed = parse(raw.where(F.col("topic").isin(topics)), fields_of(specs),
                   keep=["partition", "offset", *keep], position="nth")
    return parsed.where(F.col("malformed").isNull()).withColumn("event_ts", event_time(ahead_s))


def closed_windows(raw: DataFrame, specs, window_s: int = 300, delay_s: int = 600,
                   ahead_s: int = 3600, once: bool = False) -> DataFrame:
    """Aggregates of the windows as they close, of all ``specs``; ``table_of`` reads one table off.

    ``once`` drops records that are delivered again, by topic, partition and offset, for as long
    as the watermark lets them in.
    """
    rows = _rows(raw, specs, ahead_s).withWatermark("event_ts", f"{delay_s} seconds")
    if once:
        rows = rows.dropDuplicatesWithinWatermark([*IDENTITY, "nth"])
    window = F.window("event_ts", f"{window_s} seconds").alias("window")
    return grouped_by(rows, specs, window).withColumn(
        "dealTime", F.unix_millis(F.col("window.start"))).drop("window")


def stream_documents(closed: DataFrame, spec, path: str, checkpoint: str, batch: str,
                     trigger_s: int = 300, compat_float32: bool = False) -> StreamingQuery:
    """Upsert the closed windows of one roll-up into its collection as they come, without
    ``foreachBatch``.  ``batch`` names the query among all that write to the collection."""
    register(closed.sparkSession)
    writer = table_of(closed, spec, compat_float32).writeStream.outputMode("append") \
        .format("documents").option("path", path).option("collection", spec.table) \
        .option("batch", batch)
    return start(writer, checkpoint, trigger_s, False)


class LateLines:
    """The lines that a query's closed windows do not hold, by batch."""

    def __init__(self, spark: SparkSession, checkpoint: str, path: str, read: RangeReader,
                 is_late: Callable[[DataFrame, int], DataFrame]):
        self.spark, self.checkpoint, self.path = spark, checkpoint, path
        self.read, self.is_late = read, is_late
        self.done = self._last()

    def _greatest(self, rows: Callable[[], DataFrame]) -> int:
        """The one number of ``rows``; -1 if there are none."""
        try:
            last = rows().first()[0]
            return -1 if last is None else last
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return -1
            raise

    def _last(self) -> int:
        """The last batch that was looked at."""
        return self._greatest(lambda: self.spark.read.parquet(f"{self.path}/batches").agg(
            F.max("batch")))

    def committed(self) -> int:
        """The last batch that the query has finished."""
        return self._greatest(lambda: self.spark.read.text(f"{self.checkpoint}/commits/*").agg(
            F.max(F.col("_metadata.file_name").cast("int"))))

    def _log(self, batch: int) -> tuple[int, dict]:
        """Watermark (ms) and end offsets that the checkpoint has for a batch."""
        if batch < 0:
            return 0, {}
        lines = [r.value for r in self.spark.read.text(
            f"{self.checkpoint}/offsets/{batch}").coalesce(1).collect()]
        return json.loads(lines[1])["batchWatermarkMs"], \
            json.loads(lines[2]) if lines[2] != "-" else {}

    def _none_dropped(self, batch: int) -> bool:
        """Whether the running query says that this batch dropped nothing."""
        own = query_id(self.spark, self.checkpoint)
        for query in self.spark.streams.active:
            said = query.lastProgress if query.id == own else None
            if said and said["batchId"] == batch:
                return not any(s["numRowsDroppedByWatermark"] for s in said["stateOperators"])
        return False

    def catch_up(self, last: int) -> None:
        """Keep the late lines of all batches up to ``last`` that were not looked at yet."""
        for batch in range(self.done + 1, last + 1):
            n_late = 0
            if not self._none_dropped(batch):
                # Late is what the batch before has closed.
                closed, begin = self._log(batch - 1)
                _, end = self._log(batch)
                late = self.is_late(self.read(begin, end), closed)
                where = f"{self.path}/lines/batch={batch}"
                late.write.mode("overwrite").parquet(where)
                n_late = self.spark.read.schema(late.schema).parquet(where).count()
                if n_late:
                    _LOG.warning("batch %d: %d late lines, kept", batch, n_late)
            self.spark.createDataFrame([(n_late,)], "n_late bigint").coalesce(1).write.mode(
                "overwrite").parquet(f"{self.path}/batches/batch={batch}")
            self.done = batch


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """(batch, topic, partition, offset, arrival, value, event_ts) of the late lines."""
    schema = ("topic string, arrival timestamp, partition int, offset bigint, value string,"
              " event_ts timestamp, batch int")
    return spark.read.schema(schema).parquet(f"{path}/lines")


class StatefulStream:
    """A running query and its late lines."""

    def __init__(self, query: StreamingQuery, late: LateLines):
        self.query, self.late = query, late

    def drain(self) -> None:
        """Work off what the source holds, windows that this closes included, and stop."""
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()
        self.late.catch_up(self.late.committed())

    def stop(self, timeout_s: float = 600.0) -> None:
        """Stop between two batches, with their late lines kept."""
        stop_gracefully(self.query, timeout_s)
        self.late.catch_up(self.late.committed())


def stateful_stream(raw: DataFrame, specs, sink: Sink, checkpoint: str, read: RangeReader,
                    late_path: str, window_s: int = 300, delay_s: int = 600, ahead_s: int = 3600,
                    once: bool = False, trigger_s: int = 300, compat_float32: bool = False,
                    name: str | None = None) -> StatefulStream:
    """Write the tables of ``specs``, each window once when it closes, and keep late lines.

    ``raw`` has offsets (``read_kafka`` or ``stream_segments``); ``read`` reads a range of them.
    """
    specs = list(specs)
    spark = raw.sparkSession
    closed = closed_windows(raw, specs, window_s, delay_s, ahead_s, once)

    def is_late(lines: DataFrame, watermark_ms: int) -> DataFrame:
        rows = _rows(lines, specs, ahead_s, keep=["value"])
        # With ``once`` a line is turned away by its own time, otherwise by its window's end.
        until = F.col("event_ts") if once else F.window("event_ts", f"{window_s} seconds")["end"]
        return rows.withColumn("until", until).where(
            F.unix_millis("until") <= watermark_ms).select(
            "topic", "arrival", "partition", "offset", "value", "event_ts").distinct()

    late = LateLines(spark, checkpoint, late_path, read, is_late)

    def write_windows(batch: DataFrame, batch_id: int) -> None:
        late.catch_up(batch_id - 1)
        made = write_stage(batch, ["rollup"], rebalance=True)
        try:
            grouped = read_stage(spark, made, batch)
            write_tables(spark, [(table_of(grouped, s, compat_float32), s) for s in specs], sink)
        finally:
            remove(spark, made)

    query = start_batches(closed.writeStream.outputMode("append"), write_windows,
                          lambda writer: start(writer, checkpoint, trigger_s, False, name))
    return StatefulStream(query, late)
