"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.shared import new_path

#: Words: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: A side of at most so many short rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
#: The same for rows that may be long, by their summed sizes.
BROADCAST_BYTES = 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column's name, whatever characters it has, as one part of an expression."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct ``doc``, so that its names clash with no others."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("doc")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the folder that all executors share and read it back:
    the result depends on files alone, so a lost executor costs a re-read."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of short rows, marked for broadcast if its counted rows allow it;
    otherwise as it is, so that the join shuffles."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def small_bytes(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a stored table, marked for broadcast if the ``size`` of its rows allows it."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df


def gives_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` that returns the memory it has freed to the system when it ends: its worker lives on
    beside those of other stages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def map_batches(df: DataFrame, schema: str,
                work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    return df.mapInArrow(gives_back(work), schema)
