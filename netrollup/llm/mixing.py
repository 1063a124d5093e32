"""Mixing sources to target weights.

Every row gets a hash-random key.  Rows are range-sorted by (source, key); each range writes
running sums of its sizes, the ranges' totals are summed up per source, and both together give
every row the words that stand before it.  A source takes as many whole epochs as its target
holds, and of one more epoch the rows up to the key at which the rest is used up; the row there
is cut off, so the budget is met to the word.  Whether a row is taken so depends on its key and
one row for each source: the texts are not shuffled.

Defined cases: a null text has size 0; null is a source of its own, last in order; equal rows
have equal keys and are treated alike: where they stand at the cut, each takes the same share of
the words left; a row of size 0 is taken with the epochs and with what stands before the cut; no
rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netrollup.llm.common import SPACE, WORD, quoted, small_side, staged, text_or_empty, whole_row

ROWS_PER_RANGE = 100_000


def _running(batches):
    """Words before each row of its source within this range; rows come sorted."""
    source, total, part = object(), 0, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = batch.column("part")[0].as_py() if part is None else part
        words = batch.column("words").to_numpy()
        names = batch.column("source").to_pylist()
        before = np.cumsum(words) - words
        starts = [i for i, s in enumerate(names) if i == 0 or s != names[i - 1]]
        for i, end in zip(starts, starts[1:] + [len(names)], strict=True):
            if names[i] != source:
                source, total = names[i], 0
            stretch = before[i:end] - before[i] + total
            total = int(stretch[-1] + words[end - 1])
            before[i:end] = stretch
        yield pa.RecordBatch.from_arrays(
            [batch.column("source"), batch.column("key"), batch.column("size"),
             batch.column("copies"), batch.column("part"), pa.array(before, pa.int64())],
            names=["source", "key", "size", "copies", "part", "before"])


def targets(sources: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources in order weigh ``weights``, repeating, and share the sum of all sizes; none gets more
    than ``max_epochs`` times its size.  Ordered by how soon the limit binds, the limited sources
    are a prefix; the others share what is left by weight.  One row for each source.
    """
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("nth") % len(weights) + 1).cast("int"))
    soonest = Window.orderBy(F.col("limit_words") / F.col("weight"), "nth")
    ranked = (
        sources
        .withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight)
        .withColumn("limit_words", F.col("source_size") * F.lit(max_epochs))
        .withColumn("rank", F.row_number().over(soonest))
        .withColumn("limits", F.coalesce(F.sum("limit_words").over(
            soonest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(
            soonest.rowsBetween(0, Window.unboundedFollowing)))
        # Words for one unit of weight if exactly the sources before this one are limited.
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("limits"))
                    .cast("double") / F.col("weights"))
        .withColumn("free_from", F.min(F.when(
            F.col("level") * F.col("weight") <= F.col("limit_words"), F.col("rank")))
            .over(everything))
    )
    free = F.col("rank") >= F.col("free_from")
    final = F.min(F.when(F.col("rank") == F.col("free_from"), F.col("level"))).over(everything)
    return (
        ranked.withColumn("final", final)
        .withColumn("target", F.when(free, F.col("final") * F.col("weight"))
                    .otherwise(F.col("limit_words").cast("double")))
        .select("source", "source_size", "target")
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc`` (the whole row), ``size``, ``source_size``, ``target`` and
    ``times``, how often the mix takes it whole (0 to ``max_epochs``), and ``part``, the words that
    it takes of it besides."""
    spark = docs.sparkSession
    keyed = docs.select(
        whole_row(docs),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"),
                          text_or_empty(text))).alias("key"),
    )
    units = staged(keyed.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("copies")),
                   "mix-units")
    sources = staged(targets(
        units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")),
        weights, max_epochs), "mix-sources")
    ranges = max(units.count() // ROWS_PER_RANGE + 1,
                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (
        units.repartitionByRange(ranges, F.col("source").asc_nulls_last(), "key")
        .sortWithinPartitions(F.col("source").asc_nulls_last(), "key")
        .select("*", F.spark_partition_id().alias("part"),
                (F.col("size") * F.col("copies")).alias("words"))
    )
    placed = staged(ranged.mapInArrow(
        _running, "source string, key string, size long, copies long, part int, before long"),
        "mix-ranges")
    parts = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("source", "part").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words")
    ).select("source", "part", F.coalesce(F.sum("words").over(parts), F.lit(0)).alias("offset"))

    epochs = F.when(F.col("source_size") == 0, 0).when(
        F.col("target") >= F.col("source_size") * max_epochs, max_epochs
    ).otherwise(F.floor(F.col("target") / F.col("source_size")))
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    # Words that a row of a group of equal ones takes of what the group may take.
    part = F.floor(F.least(F.col("size") * F.col("copies"),
                           F.col("rest") - F.col("before") - F.col("offset")) / F.col("copies"))
    budget = sources.withColumn("epochs", epochs.cast("int"))
    last = (
        placed.join(small_side(staged(offsets, "mix-offsets")
                               .select(F.col("source").alias("s"), F.col("part").alias("p"),
                                       "offset")),
                    F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
        .drop("s")
        .join(small_side(staged(budget.withColumn("rest", rest).select(
            F.col("source").alias("s"), "epochs", "rest"), "mix-budget")),
            F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("epochs") < max_epochs)
               & (F.col("before") + F.col("offset") < F.col("rest")))
        .groupBy("source").agg(F.max("key").alias("cut"),
                               F.max_by(part, "key").alias("cut_words"))
    )
    plan = staged(
        budget.join(last.withColumnRenamed("source", "s"),
                    F.col("source").eqNullSafe(F.col("s")), "left")
        .select(F.col("source").alias("of"), "source_size", "target", "epochs", "cut",
                "cut_words"),
        "mix-plan")
    at_cut = F.coalesce(F.col("key") == F.col("cut"), F.lit(False))
    whole = F.coalesce(F.col("key") < F.col("cut"), F.lit(False)) | (
        at_cut & (F.col("cut_words") >= F.col("size")))
    return keyed.join(small_side(plan), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc", "size", "source_size", "target",
        (F.col("epochs") + F.when(whole, 1).otherwise(0)).alias("times"),
        F.when(at_cut & ~whole, F.col("cut_words")).otherwise(0).cast("long").alias("part"))


def mixed_rows(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs`` alone.

    The row at a source's cut is cut off after the words that the source may still take.
    """
    words = F.concat(F.lit("^(?:"), F.lit(SPACE[:-1] + "*+"), F.lit(WORD + "+"), F.lit("){"),
                     F.col("part").cast("string"), F.lit("}+"))
    cut_text = F.regexp_substr(F.col("doc")[text].cast("string"), words)
    copies = F.array_repeat(F.col("doc"), F.col("times"))
    every = F.when(F.col("part") > 0, F.concat(copies, F.array(
        F.col("doc").withField(quoted(text), cut_text)))).otherwise(copies)
    return mix(docs, text=text, **options).select(F.explode(every).alias("doc")).select("doc.*")
