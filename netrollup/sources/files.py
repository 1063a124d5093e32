"""Files as raw records, for replay and tests.

Lines lie below ``<path>/topic=<name>/``, so a query for one topic reads only that
topic's folder.  A line's arrival is the modification time of its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.schema import RAW_SCHEMA

_LINES = "value string, topic string"


def _with_arrival(lines: DataFrame) -> DataFrame:
    return lines.select(
        "topic", "value", F.col("_metadata.file_modification_time").alias("arrival")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files (plain or compressed), one message per line."""
    return _with_arrival(spark.read.schema(_LINES).text(path))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same files as a stream; new files are picked up as they appear."""
    reader = spark.readStream.schema(_LINES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _with_arrival(reader.text(path))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Raw records kept as parquet."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def stream_archive(spark: SparkSession, path: str,
                   files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_archive(raw: DataFrame, path: str) -> None:
    """Append raw records to a parquet archive, one folder per topic."""
    raw.write.mode("append").partitionBy("topic").parquet(path)
