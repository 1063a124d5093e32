"""Kafka topics as raw records.

Needs Spark's Kafka connector package on the session's class path.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# Topic, partition and offset are a record's identity: what is delivered twice has them twice.
RAW_COLUMNS = ("topic", "cast(value as string) as value", "timestamp as arrival", "partition",
               "offset")


def kafka_options(servers: str, topics, starting: str = "latest",
                  rate_per_partition: int | None = None, partitions: int | None = None,
                  trigger_s: int = 300, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options.  The ingest cap is records per second and partition; Spark
    takes it as records per trigger over all ``partitions``."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if rate_per_partition is not None:
        if not partitions:
            raise ValueError("a rate cap needs the number of topic partitions")
        options["maxOffsetsPerTrigger"] = str(rate_per_partition * trigger_s * partitions)
    return options | (extra or {})


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming raw records."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr(*RAW_COLUMNS)


def batch_options(options: dict[str, str]) -> dict[str, str]:
    """Stream options for a bounded read: given offsets stay, but a batch cannot start
    at the latest ones, and knows no cap for each trigger."""
    kept = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    if kept.get("startingOffsets") == "latest":
        kept["startingOffsets"] = "earliest"
    return kept


def read_kafka_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The records between the given offsets, by default all that the topics hold now."""
    return spark.read.format("kafka").options(**batch_options(options)).load() \
        .selectExpr(*RAW_COLUMNS)


def read_kafka_range(spark: SparkSession, options: dict[str, str], start: dict,
                     end: dict) -> DataFrame:
    """The records between two sets of offsets, by topic and partition as a checkpoint has them."""
    def at(offsets: dict, missing: int) -> str:
        # A partition that one side lacks is read from its beginning.
        return json.dumps({topic: {p: offsets.get(topic, {}).get(p, missing) for p in parts}
                           for topic, parts in end.items()})

    kept = {k: v for k, v in batch_options(options).items() if k != "subscribe"}
    return read_kafka_batch(spark, kept | {
        "assign": json.dumps({t: sorted(map(int, parts)) for t, parts in end.items()}),
        "startingOffsets": at(start, -2), "endingOffsets": at(end, -1)})
