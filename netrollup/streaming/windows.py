"""Window streams: mergeable partial aggregates, and rows rebuilt from all of them.

A batch writes the partial aggregates of its lines below
``<partials>/window=<dealTime>/batch=<query id>-<batch number>``; a batch run again
replaces its own.  The rows of the windows a batch touches are then computed from all
their partials.  So several batches, restarts and late lines add to a window and never
replace what is there, and there is no state and no watermark: a wrong clock makes rows in
its own window only.
"""

from __future__ import annotations

import json
import logging

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netrollup.operators.parse import parse
from netrollup.operators.rollup import combine, partials_many, table_of
from netrollup.plans.batch import fields_of
from netrollup.shared import read_stage, remove, write_stage
from netrollup.streaming.common import Sink, start, write_quarantine, write_tables
from netrollup.streaming.control import start_batches

_LOG = logging.getLogger("netrollup")
_NO_WINDOW = "__HIVE_DEFAULT_PARTITION__"
# Windows whose partials one read names.
_BLOCK = 500


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query for life."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def write_partials(partials: DataFrame, path: str, batch: str) -> list[int | None]:
    """Keep a batch's partials; returns the windows they are of."""
    spark = partials.sparkSession
    keyed = partials.withColumn("window", F.col("dealTime")).withColumn("batch", F.lit(batch))
    # One window's rows together; the count of windows is that of the batch's time range.
    made = write_stage(keyed, ["window"], rebalance=True)
    try:
        own = read_stage(spark, made, keyed)
        windows = [r.window for r in own.select("window").distinct().collect()]
        (
            own.hint("rebalance", F.col("window")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window", "batch").parquet(path)
        )
        return sorted(windows, key=lambda w: (w is None, w or 0))
    finally:
        remove(spark, made)


def read_partials(spark: SparkSession, path: str, windows: list, like: DataFrame) -> DataFrame:
    """All batches' partials of the given windows, whose folders alone are listed."""
    names = ",".join(str(_NO_WINDOW if w is None else w) for w in windows)
    return spark.read.option("basePath", path).schema(like.schema) \
        .parquet(f"{path}/window={{{names}}}").select(like.columns)


def window_stream(raw: DataFrame, specs, sink: Sink, checkpoint: str, deal_time,
                  trigger_s: int, partials: str | None = None,
                  quarantine_path: str | None = None, compat_float32: bool = False,
                  available_now: bool = False, name: str | None = None,
                  before_parse: Column | None = None) -> StreamingQuery:
    """Roll up each trigger's lines into the windows that ``deal_time`` assigns.

    ``before_parse`` gives the window from the raw line, otherwise ``deal_time`` is
    applied to the parsed rows.  ``partials`` is the folder of the partial aggregates,
    by default in the checkpoint, with which it belongs.
    """
    specs = list(specs)
    topics = list(dict.fromkeys(s.topic for s in specs))
    lines = raw.where(F.col("topic").isin(topics))
    if before_parse is not None:
        lines = lines.withColumn("dealTime", before_parse)
        parsed = parse(lines, fields_of(specs), keep=["dealTime"])
    else:
        parsed = deal_time(parse(lines, fields_of(specs)))
    folder = partials or f"{checkpoint}/partials"
    known: dict[str, str] = {}

    def write_windows(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known:
            known["id"] = query_id(spark, checkpoint)
        label = f"{known['id']}-{batch_id}"
        bad = Observation()
        counted = batch.observe(bad, F.count("malformed").alias("n"))
        if quarantine_path is not None:
            # Parsed once for two uses.  What does not fit in memory goes to disk.
            counted.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            own = partials_many(counted, specs)
            windows = write_partials(own, folder, label)
            if quarantine_path is not None:
                write_quarantine(counted, quarantine_path, label)
        finally:
            if quarantine_path is not None:
                counted.unpersist()
        n_bad = bad.get.get("n") or 0
        if n_bad:
            _LOG.warning("%s: %d malformed lines in batch %s%s", name or "stream", n_bad, label,
                         "" if quarantine_path else ", not kept")
        for at in range(0, len(windows), _BLOCK):
            everything = read_partials(spark, folder, windows[at:at + _BLOCK], own)
            whole = combine(everything, specs)
            made = write_stage(whole, ["rollup"], rebalance=True)
            try:
                grouped = read_stage(spark, made, whole)
                write_tables(spark, [(table_of(grouped, s, compat_float32), s) for s in specs],
                             sink)
            finally:
                remove(spark, made)

    return start_batches(
        parsed.writeStream, write_windows,
        lambda writer: start(writer, checkpoint, trigger_s, available_now, name))
