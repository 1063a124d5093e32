"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CONF = "spark.checkpoint.dir"
_OWN = "netrollup.local.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    A local session (tests) that names none gets a temporary folder, kept for the
    session.  On a cluster such a folder would not be shared, so there it is an error.
    """
    folder = spark.conf.get(_CONF, None) or spark.conf.get(_OWN, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") \
                and spark.sparkContext.master != "local":
            raise ValueError(f"set {_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="netrollup-")
        spark.conf.set(_OWN, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, partition_by: list[str], rebalance: bool = False) -> DataFrame:
    """Write ``df`` to a new shared table and read it back.

    The result no longer depends on the lineage of ``df``: losing an executor
    costs a re-read, not a recomputation.  ``rebalance`` brings a partition's rows
    together first, so that each gets few files.
    """
    return read_stage(df.sparkSession, write_stage(df, partition_by, rebalance), df)


def write_stage(df: DataFrame, partition_by: list[str], rebalance: bool = False) -> str:
    path = new_path(df.sparkSession, "stage")
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The staged table at ``path`` with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(like.columns)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and ``path`` for it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder this program has made; none there is no error."""
    system, where = file_system(spark, path)
    system.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)
