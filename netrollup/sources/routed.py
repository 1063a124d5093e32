"""An archive laid out by route, so that a roll-up reads its own lines only.

Lines lie below ``topic=<name>/tag=<tag>/``, the tag being what the parser reads, and within a file by
the CPE flag, then by time, with a bloom filter on the device.  A roll-up's read prunes by folder, by
the flag's and the time's ranges in row groups, and by device.  The line's text is kept as it came, so
a replay from here gives what one from the plain archive gives.

Lines that the typed read does not take (arrays of messages, odd numbers, no JSON) may carry any tag,
device and time; they lie under their own tag, which every read includes.  Tags that no roll-up knows
share one folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.operators.parse import parse
from netrollup.operators.rollup import event_seconds, with_event_window
from netrollup.operators.rollup import rollup as roll_up
from netrollup.operators.route import route
from netrollup.plans.specs import ROLLUPS
from netrollup.schema import EVENT_TIME, MISFIT, typed_schema

#: Folder of the lines that have to be read whatever the route.
OTHER = "_other"
UNKNOWN = "_unknown"
SCHEMA = ("value string, arrival timestamp, is_cpe boolean, event_s bigint, device string,"
          " topic string, tag string")
_FIELDS = ["resourceLogo", "isCpe", "resourceUuid", "switchUuid", EVENT_TIME]
_TAGS = sorted({s.tag for s in ROLLUPS if s.tag is not None})


def with_route(raw: DataFrame) -> DataFrame:
    """Raw records with the columns that the layout is made of."""
    lines = raw.withColumn("message", F.from_json(
        "value", typed_schema(_FIELDS), {"columnNameOfCorruptRecord": MISFIT}))
    fits = F.col(f"message.{MISFIT}").isNull()
    logo = F.col("message.resourceLogo")

    def of_fit(value: Column) -> Column:
        return F.when(fits, value)

    tag = F.when(~fits, OTHER).when(logo.isin(_TAGS), logo).when(logo.isNotNull(), UNKNOWN)
    return (
        lines.withColumn(EVENT_TIME, F.col(f"message.{EVENT_TIME}"))
        .select("topic", tag.alias("tag"), "value", "arrival",
                of_fit(F.coalesce(F.col("message.isCpe") == "y", F.lit(False))).alias("is_cpe"),
                of_fit(F.floor(event_seconds())).alias("event_s"),
                of_fit(F.coalesce("message.resourceUuid", "message.switchUuid")).alias("device"))
    )


def write_routed(raw: DataFrame, path: str, row_group_mb: int = 64,
                 devices: int = 1_000_000) -> None:
    """Append raw records to the archive; ``devices`` is what the bloom filters are sized for."""
    (
        with_route(raw).hint("rebalance", F.col("topic"), F.col("tag"))
        .sortWithinPartitions("topic", "tag", "is_cpe", "event_s")
        .write.mode("append").partitionBy("topic", "tag")
        .option("parquet.block.size", row_group_mb << 20)
        .option("parquet.bloom.filter.enabled#device", "true")
        .option("parquet.bloom.filter.expected.ndv#device", devices)
        .parquet(path)
    )


def read_routed(spark: SparkSession, path: str, spec, since_s: int | None = None,
                until_s: int | None = None, device: str | None = None) -> DataFrame:
    """The raw records that can feed ``spec``, of ``since_s <= time < until_s`` and of one device
    where given; and the lines that may be anything."""
    rows = spark.read.schema(SCHEMA).parquet(path).where(F.col("topic") == spec.topic)
    own = rows if spec.tag is None else rows.where(F.col("tag") == spec.tag)
    if spec.tag is None:
        own = own.where(F.coalesce("tag", F.lit("")) != OTHER)
    if spec.cpe_only:
        own = own.where("is_cpe")
    if since_s is not None:
        own = own.where(F.col("event_s") >= since_s)
    if until_s is not None:
        own = own.where(F.col("event_s") < until_s)
    if device is not None:
        own = own.where(F.col("device") == device)
    columns = ["topic", "value", "arrival"]
    return own.select(columns).unionByName(rows.where(F.col("tag") == OTHER).select(columns))


def replay_routed(spark: SparkSession, path: str, spec, window_s: int = 300,
                  since_s: int | None = None, until_s: int | None = None,
                  device: str | None = None, compat_float32: bool = False) -> DataFrame:
    """One roll-up over its own part of the archive, by event time.  ``since_s`` and ``until_s`` are
    bounds of windows; ``device`` is a value of the roll-up's first key."""
    for bound in (since_s, until_s):
        if bound is not None and bound % window_s:
            raise ValueError("a range ends between windows, not inside one")
    if device is not None and spec.keys[0] not in ("resourceUuid", "switchUuid"):
        raise ValueError(f"{spec.key} is not kept by device")
    raw = read_routed(spark, path, spec, since_s, until_s, device)
    rows = with_event_window(route(parse(raw, spec.fields), spec), window_s)
    # What the lines of any route have brought along.
    if since_s is not None:
        rows = rows.where(F.col("dealTime") >= since_s * 1000)
    if until_s is not None:
        rows = rows.where(F.col("dealTime") < until_s * 1000)
    if device is not None:
        rows = rows.where(F.col(spec.keys[0]) == device)
    return roll_up(rows, spec, compat_float32)
