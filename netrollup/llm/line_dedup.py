"""Line deduplication against levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z in lower case; keys shorter than
``min_chars`` are never dropped.  Documents come in batches.  A batch's distinct key hashes are
merge-anti-joined with all runs: those that no run holds are the batch's own, and become a new sorted
run of level 0; the others are noted as seen again.  When a level has ``fan`` runs they are
compacted into one run of the next level.  So every hash lies in exactly one run, with the documents
of the batch that brought it, and the notes hold only what several batches share.  Keys found in
at least ``min_docs`` documents in all lose their lines except in the greatest id that holds them.

Runs, batches and notes are tables bucketed and sorted by hash with one number of buckets, so the
merge joins read bucket beside bucket and shuffle no stored hash.  A key is two 64-bit hashes.  Lines are counted per document before anything meets by key, so a line that a third of all
documents share is one row for each task.  Everything is DataFrame functions.

Defined cases: a null text counts as one empty line; a text without a line break is one line;
rows of one id are one document, with a line counted once; a null id is a document of its own, less
than all others; equal rows are treated alike; no rows give no rows; the columns of the documents
lie in one struct, so their names clash with none of these.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.llm.common import quoted, small_bytes, staged, text_or_empty, whole_row
from netrollup.shared import new_path, remove

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FAN = 3
_ENDS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


class LineRuns:
    """Levelled runs of (h1, h2, docs, last): a key's hash, the documents of the batch that brought
    it and the greatest of their ids.  One writer.  A document belongs to one batch."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan: int = FAN):
        self.spark, self.fan = spark, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.notes: list[str] = []
        self._paths: dict[str, str] = {}

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        """A table of ``rows``, bucketed and sorted by hash."""
        name, path = f"line_run_{uuid.uuid4().hex}", new_path(self.spark, "line-run")
        self._paths[name] = path
        (
            rows.repartition(self.buckets, *_HASH).write.format("parquet")
            .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", path).saveAsTable(name)
        )
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self._paths.pop(name))

    def _without(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """``rows`` whose hash none of the tables holds, by merge joins of sorted buckets."""
        return reduce(lambda left, name: left.join(
            self.spark.table(name).select(*_HASH).hint("merge"), _HASH, "left_anti"), names, rows)

    def add(self, lines: DataFrame) -> None:
        """Add a batch, (h1, h2, id) for each line."""
        batch = self._write(
            lines.select(*_HASH, "id").distinct()
            .groupBy(*_HASH).agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last")))
        if self.runs:
            own = self._write(self._without(self.spark.table(batch), self.runs))
            self.notes.append(self._write(self._without(self.spark.table(batch), [own])))
            self._remove(batch)
        else:
            own = batch
        self.levels[0].append(own)
        self._compact()

    def _compact(self) -> None:
        at = 0
        while at < len(self.levels) and len(self.levels[at]) >= self.fan:
            merged = self._write(self._all(self.levels[at]))
            for name in self.levels[at]:
                self._remove(name)
            self.levels[at] = []
            at += 1
            if at == len(self.levels):
                self.levels.append([])
            self.levels[at].append(merged)

    def _all(self, names: list[str]) -> DataFrame:
        """The rows of several tables, read as plain files: not taken for one bucketed table."""
        like = self.spark.table(names[0]).schema
        return self.spark.read.schema(like).parquet(*[self._paths[n] for n in names])

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(h1, h2, last) of the keys in at least ``min_docs`` documents of all batches."""
        if not self.notes:
            return self._all(self.runs).where(F.col("docs") >= min_docs).select(*_HASH, "last")
        again = self._write(self._all(self.notes).groupBy(*_HASH).agg(
            F.sum("docs").alias("more"), F.max("last").alias("later")))
        found = []
        for name in self.runs:
            both = self.spark.table(name).join(
                self.spark.table(again).hint("merge"), _HASH, "left")
            found.append(both.where(F.col("docs") + F.coalesce("more", F.lit(0)) >= min_docs)
                         .select(*_HASH, F.greatest("last", "later").alias("last")))
        return reduce(DataFrame.unionByName, found)

    def release(self) -> None:
        """Remove all tables."""
        for name in list(self._paths):
            self._remove(name)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_ENDS))
    # Lower case of ASCII alone: other letters stay.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_rows(docs: DataFrame, id_column: str, min_chars: int, batches: int) -> DataFrame:
    """(id, digest, pos, h1, h2, batch) for every line that is long enough."""
    text = text_or_empty("text")
    rows = docs.select(F.col("doc")[id_column].alias("id"), F.xxhash64(text).alias("digest"),
                       F.posexplode(_lines(text)).alias("pos", "line"))
    # White space goes before the length is taken; a line short with it is short without it.
    key = rows.where(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return key.where(F.length("key") >= min_chars).select(
        "id", "digest", "pos", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"))


def drop_lines(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
               fan: int = FAN) -> DataFrame:
    """One row per document: ``doc`` (the whole row), ``n_lines`` before and ``n_dropped``, and
    ``kept``, the text that is left (empty for a null one)."""
    spark = docs.sparkSession
    rows = docs.select(whole_row(docs), F.col(quoted(text)).cast("string").alias("text"))
    path = new_path(spark, "line-hashes")
    made = _line_rows(rows, id_column, min_chars, batches)
    made.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(made.schema).parquet(path)
    runs = LineRuns(spark, fan=fan)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch).select(*_HASH, "id"))
    often = staged(runs.frequent(min_docs), "line-frequent")
    runs.release()
    drops = (
        lines.join(small_bytes(often, F.lit(48)), _HASH)
        .where(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy(F.col("id").alias("of"), "digest").agg(F.collect_set("pos").alias("drop"))
    )
    drops = staged(drops, "line-drops")
    remove(spark, path)
    size = F.size("drop") * 4 + 64
    keyed = rows.withColumn("text", text_or_empty("text")).withColumn("key", F.xxhash64("text"))
    found = keyed.join(
        small_bytes(drops, size),
        F.col("doc")[id_column].eqNullSafe(F.col("of")) & (F.col("key") == F.col("digest")), "left")
    lines_of = _lines(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), F.col("drop"))
    # The lines are split once for a row, not once for each line that is left.
    kept = F.get(F.transform(F.array(lines_of), lambda every: F.array_join(
        F.transform(left, lambda i: F.get(every, i)), "\n")), F.lit(0))
    return found.select(
        "doc", F.size(lines_of).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("kept"))


def deduplicated(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines that are dropped; a null text stays null."""
    found = drop_lines(docs, text=text, **options)
    kept = F.when(F.col("doc")[text].isNotNull(), F.col("kept"))
    return found.select(F.col("doc").withField(quoted(text), kept).alias("doc")).select("doc.*")
