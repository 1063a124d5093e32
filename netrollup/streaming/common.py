"""What the arrival-window and the event-time streams share."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from netrollup.operators.parse import quarantine
from netrollup.sinks.documents import write_documents
from netrollup.sinks.merge import merge
from netrollup.sinks.other import write_external

_LOG = logging.getLogger("netrollup")

# Receives the finished rows of one table and the roll-up that made them.
Sink = Callable[[DataFrame, object], None]


def table_sink(root: str, slice_s: int = 3600) -> Sink:
    """Upsert each roll-up into the parquet table ``root/<table name>``; rows that lost
    to another with the same key are counted in the log."""
    def write(rows: DataFrame, spec) -> None:
        lost = merge(rows, f"{root}/{spec.table}", list(spec.keys), slice_s)
        if lost:
            _LOG.warning("%s: %d rows lost to another row with the same key", spec.table, lost)

    return write


def external_sink(fmt: str, options: dict[str, str] | None = None,
                  table_option: str = "collection") -> Sink:
    """Hand each roll-up to a connector that upserts on ``_id`` itself."""
    def write(rows: DataFrame, spec) -> None:
        write_external(rows, spec.table, fmt, table_option, options)

    return write


def document_sink(path: str) -> Sink:
    """Upsert each roll-up into its collection of the document store at ``path``."""
    def write(rows: DataFrame, spec) -> None:
        write_documents(rows, path, spec.table, list(spec.keys))

    return write


def write_tables(spark: SparkSession, tables, sink: Sink, at_once: int = 4) -> None:
    """Hand (rows, roll-up) pairs to ``sink``, some side by side: each is a few short
    jobs that would leave a cluster idle one after the other."""
    write = inheritable_thread_target(spark)(lambda table: sink(*table))
    with ThreadPoolExecutor(at_once) as pool:
        for _ in pool.map(write, tables):
            pass


def write_quarantine(parsed: DataFrame, path: str, batch: str) -> None:
    """Keep the malformed lines of a batch, which ``batch`` names among all queries that
    write here; a repeated batch replaces its own."""
    (
        quarantine(parsed).withColumn("batch", F.lit(batch))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch").parquet(path)
    )


def start(writer: DataStreamWriter, checkpoint: str, trigger_s: int, available_now: bool,
          name: str | None = None) -> StreamingQuery:
    """Start with one batch per ``trigger_s``, or drain what is there and end."""
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_s} seconds")
    return writer.option("checkpointLocation", checkpoint).start()


def await_any(spark: SparkSession) -> None:
    """Block while all streams of the session run; raise what ended the first."""
    spark.streams.awaitAnyTermination()
