"""Keyed upsert of metric rows into a parquet table.

One row per ``_id``.  Incoming fields replace stored ones, an incoming null
included; columns the incoming rows lack keep their stored values.  A key
contains its ``dealTime``, so a key lives in exactly one time slice: the table is
partitioned by slice, and a merge reads and rewrites only the slices it touches,
a bounded number of named folders at a time.  Merging the same rows again leaves
the table as it is.  One writer per table.

The new content of a block of slices is written beside the table before it
replaces the stored one.  If the driver dies in between, the next merge finishes
the replacement first, so no stored row is lost.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.functions import slice_ms
from netrollup.shared import exists, read_stage, remove, write_stage

SLICE = "dealSlice"
_DAY_MS = 86400000
_NO_SLICE = "__HIVE_DEFAULT_PARTITION__"

# Folders that one read names.  More slices are merged in several rounds.
_BLOCK = 200
# Of a table's folder, what readers skip: content on its way into the table.
_PENDING = "_pending"
# Ids of at most so many colliding rows are broadcast.
_BROADCAST_IDS = 200_000


def resolve_collisions(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per ``_id``: of several, the greatest by ``order_by``, nulls lowest.

    Aggregated rather than ranked in a window, so a key with very many rows is
    combined before the shuffle.  ``n_rows`` tells how many rows a key had.
    """
    rank = F.struct(*[c for name in order_by
                      for c in (F.col(name).isNotNull(), F.col(name))])
    rest = [c for c in rows.columns if c != "_id"]
    return (
        rows.groupBy("_id")
        .agg(F.max_by(F.struct(*rest), rank).alias("best"), F.count(F.lit(1)).alias("n_rows"))
        .select("_id", *[F.col("best")[c].alias(c) for c in rest], "n_rows")
    )


def colliding(rows: DataFrame) -> DataFrame:
    """The ids that several rows have, and how many; a hash aggregate of the ids alone."""
    return rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def one_row_each(rows: DataFrame, ids: DataFrame | None, order_by: list[str]) -> DataFrame:
    """``rows`` with one row per ``_id``, where ``ids`` are those that several have.
    Only their rows are ranked; all others pass."""
    if ids is None:
        return rows
    is_one = F.col("_id").eqNullSafe(F.col("id"))
    ids = ids.select(F.col("_id").alias("id"))
    best = resolve_collisions(rows.join(ids, is_one, "left_semi"), order_by).drop("n_rows")
    return rows.join(ids, is_one, "left_anti").unionByName(best)


def collision_order(rows: DataFrame, keys: list[str] | None) -> list[str]:
    """Latest ``timestamp`` first, then the group keys, then every other column,
    so the choice among colliding rows is the same on every run."""
    first = [c for c in ["timestamp", *(keys or [])] if c in rows.columns]
    return first + [c for c in rows.columns if c not in first and c not in ("_id", SLICE)]


def _folder(slice_: int | None) -> str:
    return f"{SLICE}={_NO_SLICE if slice_ is None else slice_}"


def stored_slices(spark: SparkSession, path: str, slices: list) -> DataFrame | None:
    """Stored rows of the given slices; None if there are none.

    Naming the slices in the path leaves all other folders unlisted.
    """
    where = f"{path}/{{{','.join(_folder(s) for s in slices)}}}"
    try:
        return (
            spark.read.option("basePath", path).option("mergeSchema", True)
            .parquet(where)
            .withColumn(SLICE, F.col(SLICE).cast("bigint"))
        )
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _overlay(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Full outer join on the key; incoming fields win where the row is incoming."""
    old, new = stored.alias("old"), incoming.withColumn("_arrived", F.lit(True)).alias("new")
    arrived = F.col("new._arrived").isNotNull()

    def pick(name: str) -> Column:
        if name not in incoming.columns:
            return F.col(f"old.{name}")
        if name not in stored.columns:
            return F.col(f"new.{name}")
        return F.when(arrived, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    names = list(dict.fromkeys(stored.columns + incoming.columns))
    joined = old.join(new, F.col("old._id") == F.col("new._id"), "full_outer")
    return joined.select(*[pick(n).alias(n) for n in names])


def _replace(spark: SparkSession, path: str) -> None:
    """Put the pending content, if it is complete, in the place of its slices."""
    pending = f"{path}/{_PENDING}"
    if not exists(spark, pending):
        return
    if exists(spark, f"{pending}/_SUCCESS"):
        files = spark.read.option("mergeSchema", True).parquet(pending)
        (
            files.withColumn(SLICE, F.col(SLICE).cast("bigint")).hint("rebalance", F.col(SLICE))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(SLICE).parquet(path)
        )
    remove(spark, pending)


def _write_block(spark: SparkSession, path: str, slices: list, incoming: DataFrame) -> None:
    stored = stored_slices(spark, path, slices)
    merged = incoming if stored is None else _overlay(stored, incoming)
    # A slice's rows together, split again by AQE where a slice is large.
    merged.hint("rebalance", F.col(SLICE)).write.partitionBy(SLICE).parquet(f"{path}/{_PENDING}")
    _replace(spark, path)


def merge(rows: DataFrame, path: str, keys: list[str] | None = None,
          slice_s: int = 3600) -> int:
    """Upsert ``rows`` into the table at ``path``; returns the collision count, the
    number of incoming rows that lost to another row with the same ``_id``.

    ``slice_s`` is the width of a stored slice, a day at most; keep it the same for a
    table's life.
    """
    if not 0 < slice_s <= 86400:
        raise ValueError("slice_s must be between 1 second and one day")
    spark = rows.sparkSession
    _replace(spark, path)  # what a merge before has left
    sliced = rows.withColumn(SLICE, slice_ms(F.col("dealTime"), slice_s))
    # By slice, so a block of slices reads its own folders; lost executors cost a re-read.
    staged_path = write_stage(sliced, [SLICE], rebalance=True)
    ids_path = None
    try:
        staged = read_stage(spark, staged_path, sliced)
        # One number for each slice of time.
        slices = sorted((r[SLICE] for r in staged.select(SLICE).distinct().collect()),
                        key=lambda s: (s is None, s or 0))
        shared = colliding(staged)
        ids_path = write_stage(shared, [])
        ids, lost = read_stage(spark, ids_path, shared), 0
        found = ids.agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows")).first()
        if found.n:
            lost = found.rows - found.n
            ids = F.broadcast(ids) if found.n <= _BROADCAST_IDS else ids
        for at in range(0, len(slices), _BLOCK):
            block = slices[at:at + _BLOCK]
            is_in = F.col(SLICE).isin([s for s in block if s is not None])
            mine = staged.where(is_in | F.col(SLICE).isNull() if None in block else is_in)
            _write_block(spark, path, block,
                         one_row_each(mine, ids if found.n else None, collision_order(rows, keys)))
        return lost
    finally:
        for made in filter(None, (staged_path, ids_path)):
            remove(spark, made)


def read_table(spark: SparkSession, path: str, schema=None, since: int | None = None,
               until: int | None = None) -> DataFrame:
    """The stored metric rows, of ``since <= dealTime < until`` (ms) where given.

    A time range reads only its slices.  Give ``schema`` for a large table: without
    it Spark opens every file to learn the columns.
    """
    reader = spark.read
    if schema is None:
        reader = reader.option("mergeSchema", True)
    else:
        reader = reader.schema(f"{schema}, {SLICE} bigint")
    rows = reader.parquet(path)
    if since is not None:
        # A slice starts at or before its rows; slices are at most a day wide.
        rows = rows.where((F.col(SLICE) > since - _DAY_MS) & (F.col("dealTime") >= since))
    if until is not None:
        rows = rows.where((F.col(SLICE) < until) & (F.col("dealTime") < until))
    return rows.drop(SLICE)
