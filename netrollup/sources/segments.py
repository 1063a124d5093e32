"""An archive of topics that keeps record offsets, as a stream source and for ranges.

Records lie as parquet below ``topic=<name>/partition=<n>/segment=<first offset>/``.  The stream
reader works like that of a broker: an offset for each partition, a cap on the records that a
batch takes from each partition, and a restart from the offsets in the query's checkpoint.  What
the archive holds is learned from folder names and the footers of the newest segments.

Register it with ``spark.dataSource.register(SegmentSource)``; ``stream_segments`` does.  The reader's
tasks open files by themselves: the path must be one that ``pyarrow.fs`` knows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "topic string, partition int, offset bigint, value string, arrival timestamp"
SEGMENT_ROWS = 1_000_000
#: Records that one task of a batch reads, at most.
_TASK_ROWS = 500_000
_FOLDER = re.compile(r"topic=([^/]+)/partition=(\d+)/segment=(\d+)$")


def with_offsets(raw: DataFrame, partition: Column, *order: Column) -> DataFrame:
    """Raw records with a partition and an offset by arrival, as a broker gives them; records
    that arrive at one time are put in ``order``, then in that of their texts."""
    own = Window.partitionBy("topic", "partition").orderBy("arrival", *order, "value")
    return raw.withColumn("partition", partition.cast("int")).withColumn(
        "offset", (F.row_number().over(own) - 1).cast("bigint"))


def write_segments(records: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> None:
    """Append records (topic, partition, offset, value, arrival) to the archive."""
    first = F.col("offset") - F.pmod(F.col("offset"), F.lit(segment_rows))
    folders = ["topic", "partition", "segment"]
    (
        records.select("topic", "partition", "offset", "value", "arrival")
        .withColumn("segment", first).hint("rebalance", *[F.col(c) for c in folders])
        .sortWithinPartitions(*folders, "offset")
        .write.mode("append").partitionBy(*folders).parquet(path)
    )


def read_range(spark: SparkSession, path: str, start: dict, end: dict) -> DataFrame:
    """The records from ``start`` to before ``end``, offsets by ``topic/partition``; a partition that
    ``start`` lacks is read from its beginning."""
    rows = spark.read.schema(f"{SCHEMA}, segment bigint").parquet(path)
    tests = []
    for name, until in sorted(end.items()):
        topic, _, partition = name.rpartition("/")
        tests.append((F.col("topic") == topic) & (F.col("partition") == int(partition))
                     & (F.col("segment") < until) & (F.col("offset") >= start.get(name, 0))
                     & (F.col("offset") < until))
    test = reduce(lambda a, b: a | b, tests, F.lit(False))
    return rows.where(test).drop("segment")


@dataclass
class Range(InputPartition):
    topic: str
    number: int
    first: int
    until: int

    def __post_init__(self):
        super().__init__((self.topic, self.number, self.first, self.until))


class SegmentSource(DataSource):
    """Options: ``path``; ``topics``, comma-separated, by default all; ``starting``, ``earliest`` or
    ``latest``; ``perPartition``, the cap on a batch's records of each partition, by default none;
    ``position``, a file beside the checkpoint that a capped query keeps its last planned offsets
    in."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentStreamReader:
        return SegmentStreamReader(dict(self.options))


class SegmentStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.path = options["path"].rstrip("/")
        self.topics = set(filter(None, options.get("topics", "").split(",")))
        self.starting = options.get("starting", "earliest")
        self.cap = int(options.get("perpartition", 0))
        self.position = options.get("position")
        if self.starting not in ("earliest", "latest"):
            raise ValueError("starting must be earliest or latest")
        if self.cap and not self.position:
            raise ValueError("a cap needs a position file, to know after a restart where it is")
        self.at: dict[str, int] | None = None

    # --- on the driver -----------------------------------------------------------------------

    def _segments(self) -> dict[str, dict[int, str]]:
        """Folders by partition and first offset."""
        files, root = fs.FileSystem.from_uri(self.path)
        found: dict[str, dict[int, str]] = {}
        every = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        for info in every:
            match = _FOLDER.search(info.path) if info.type == fs.FileType.Directory else None
            if match and (not self.topics or match[1] in self.topics):
                found.setdefault(f"{match[1]}/{match[2]}", {})[int(match[3])] = info.path
        return found

    def _ends(self) -> dict[str, int]:
        """The offset after the last record of every partition."""
        files, _ = fs.FileSystem.from_uri(self.path)
        ends = {}
        for name, segments in self._segments().items():
            newest = max(segments)
            ends[name] = newest
            for file in _files(files, segments[newest]):
                meta = pq.ParquetFile(files.open_input_file(file)).metadata
                at = meta.schema.names.index("offset")
                for group in range(meta.num_row_groups):
                    last = meta.row_group(group).column(at).statistics.max
                    ends[name] = max(ends[name], last + 1)
        return ends

    def _begin(self, ends: dict[str, int]) -> dict[str, int]:
        return dict(ends) if self.starting == "latest" else dict.fromkeys(ends, 0)

    def initialOffset(self) -> dict:
        # Asked for by a new query only, and after the first latestOffset.
        if self.at is None:
            self.at = self._begin(self._ends())
        return self.at

    def latestOffset(self) -> dict:
        ends = self._ends()
        if self.at is None:
            self.at = self._kept() if self.cap else None
            if self.at is None:
                self.at = self._begin(ends)
                self._keep()
                if self.starting == "latest":
                    return ends
        if not self.cap:
            return ends
        return {name: min(end, self.at.get(name, 0) + self.cap) for name, end in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.at = end
        self._keep()
        out = []
        for name, until in sorted(end.items()):
            topic, _, number = name.rpartition("/")
            for first in range(start.get(name, 0), until, _TASK_ROWS):
                out.append(Range(topic, int(number), first, min(until, first + _TASK_ROWS)))
        return out

    def _keep(self) -> None:
        if self.position:
            files, where = fs.FileSystem.from_uri(self.position)
            files.create_dir(where.rpartition("/")[0], recursive=True)
            with files.open_output_stream(where) as out:
                out.write(json.dumps(self.at).encode())

    def _kept(self) -> dict[str, int] | None:
        """The offsets planned last; none for a new query."""
        files, where = fs.FileSystem.from_uri(self.position)
        if files.get_file_info(where).type == fs.FileType.NotFound:
            return None
        with files.open_input_stream(where) as kept:
            return json.loads(kept.read())

    # --- in tasks ----------------------------------------------------------------------------

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(self.path)
        folder = f"{root}/topic={partition.topic}/partition={partition.number}"
        first_of = {int(i.base_name.partition("=")[2]): i.path
                    for i in files.get_file_info(fs.FileSelector(folder))
                    if i.base_name.startswith("segment=")}
        # The segments that begin in the range, and the one that holds its first record.
        begin = max((s for s in first_of if s <= partition.first), default=partition.first)
        for segment in sorted(s for s in first_of if begin <= s < partition.until):
            for file in _files(files, first_of[segment]):
                for batch in pq.ParquetFile(files.open_input_file(file)).iter_batches(
                        columns=["offset", "value", "arrival"]):
                    offset = batch.column("offset")
                    own = batch.filter(pc.and_(pc.greater_equal(offset, partition.first),
                                               pc.less(offset, partition.until)))
                    if own.num_rows:
                        yield _record(own, partition)


def _files(files: fs.FileSystem, folder: str) -> list[str]:
    return sorted(i.path for i in files.get_file_info(fs.FileSelector(folder))
                  if i.base_name.endswith(".parquet"))


def _record(batch: pa.RecordBatch, of: Range) -> pa.RecordBatch:
    n = batch.num_rows
    arrival = batch.column("arrival").cast(pa.timestamp("us", "UTC"))
    return pa.RecordBatch.from_arrays(
        [pa.array([of.topic] * n), pa.array([of.number] * n, pa.int32()), batch.column("offset"),
         batch.column("value").cast(pa.string()), arrival],
        ["topic", "partition", "offset", "value", "arrival"])


def stream_segments(spark: SparkSession, path: str, topics=(), starting: str = "earliest",
                    rate_per_partition: int | None = None, trigger_s: int = 300,
                    position: str | None = None) -> DataFrame:
    """Streaming records.  ``rate_per_partition`` is the ingest cap, records a second and
    partition: a batch takes a trigger's worth of each partition, so one that is behind
    cannot use up what the others may have."""
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format("segments").option("path", path).option("starting", starting)
    if topics:
        reader = reader.option("topics", ",".join(topics))
    if rate_per_partition is not None:
        reader = reader.option("perPartition", rate_per_partition * trigger_s)
    if position:
        reader = reader.option("position", position)
    return reader.load()
