"""Comparing all rows of a bucket with each other in bounded blocks.

Rows of a bucket with more than ``size`` rows are dealt to as many blocks as it takes; a task
gets two blocks (or one, with itself), so all pairs of rows meet in exactly one task and no task
gets more than two blocks.  A small bucket is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import small_side, staged


def deal(rows: DataFrame, bucket: str, row_hash: str, size: int) -> DataFrame:
    """``rows`` of buckets with at least two rows, once for each task they take part in, with
    ``block`` (their own), ``left`` and ``right`` (the task's blocks, left <= right).

    ``row_hash`` is a column that spreads the rows of a bucket evenly.
    """
    sizes = rows.groupBy(F.col(bucket).alias("of")).agg(F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("of", F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    sizes = staged(sizes, "blocks")
    own = F.pmod(F.col(row_hash), F.col("blocks")).cast("int")
    pair = F.struct(F.least("block", "other").alias("left"),
                    F.greatest("block", "other").alias("right"))
    return (
        rows.join(small_side(sizes), F.col(bucket) == F.col("of")).drop("of")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pair", pair).drop("other", "blocks")
        .select("*", "pair.left", "pair.right").drop("pair")
    )
