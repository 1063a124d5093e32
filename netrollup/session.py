"""Session settings the engine is laid out for.  The caller owns the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

_COMMON = {
    # Coalesces the small partitions left after aggregation and splits large slices
    # when tables are written.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Replay of a large archive.  Partitions are an upper bound that adaptive execution
# shrinks: some 250 MB of partial aggregates each where 100 TB of lines leave 2 TB.
REPLAY = _COMMON | {"spark.sql.shuffle.partitions": "8000"}

# Streams.  Windows are kept as files of partial aggregates, so there is no state to lay out.
STREAM = _COMMON | {"spark.sql.shuffle.partitions": "400"}


def tune(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Apply ``settings`` except where the session was started with its own value."""
    own = spark.sparkContext.getConf()
    for key, value in settings.items():
        if not own.contains(key):
            spark.conf.set(key, value)
    return spark
