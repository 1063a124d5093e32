"""A keyed document store behind Spark's data source interface: upsert on ``_id``, in two phases.

A collection is a folder with one SQLite file for each bucket of ids, which no server and no other
program needs to see.  Tasks put their rows aside in the buckets' files.  The driver's commit is one
small file that names what the tasks have put aside; from then on the rows count, and whoever opens a
bucket next, a later write or a read, applies them in the order of the commits.  Without a commit
they never count, so a batch that fails leaves the documents as they were, and a batch that is
committed again under its name changes nothing.

Incoming fields replace stored ones, an incoming null included; fields that the rows lack keep
their values.  A path on a file system that all executors share and that can lock files is needed.
Not-a-number is stored as null.
"""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing, suppress
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)

from netrollup.sinks.merge import collision_order, resolve_collisions

KEY = "_id"
BUCKETS = 16
_WAIT_S = 600
_ROWS = 5000
_TYPES = (T.StringType, T.LongType, T.IntegerType, T.DoubleType, T.FloatType)


def local_folder(path: str) -> str:
    """``path`` as the file system's own, from a plain path or a ``file:`` address."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"a document store needs a path that files can be opened at, not {path}")
    return parts.path.rstrip("/")


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Collection:
    def __init__(self, path: str, name: str, buckets: int = BUCKETS):
        self.folder, self.buckets = f"{local_folder(path)}/{name}", buckets

    def bucket_of(self, key: str | None) -> int:
        return 0 if key is None else zlib.crc32(key.encode()) % self.buckets

    def open(self, bucket: int) -> sqlite3.Connection:
        os.makedirs(f"{self.folder}/commits", exist_ok=True)
        db = sqlite3.connect(f"{self.folder}/bucket-{bucket}.db", timeout=_WAIT_S,
                             isolation_level=None)
        db.execute(f"CREATE TABLE IF NOT EXISTS docs ({_quoted(KEY)} TEXT PRIMARY KEY)")
        db.execute("CREATE TABLE IF NOT EXISTS applied (number INTEGER PRIMARY KEY)")
        return db

    def known(self) -> list[int]:
        """The buckets there are."""
        if not os.path.isdir(self.folder):
            return []
        return sorted(int(f[7:-3]) for f in os.listdir(self.folder)
                      if f.startswith("bucket-") and f.endswith(".db"))

    def commits(self) -> list[tuple[int, str]]:
        """Number and file of every commit, in order."""
        names = [f for f in os.listdir(f"{self.folder}/commits") if f.endswith(".json")]
        return sorted((int(f.partition("-")[0]), f) for f in names)

    def commit(self, batch: str, attempts: list[tuple[int, str]]) -> bool:
        """Let what the attempts have put aside count; False if the batch has been committed.

        One writer for each collection."""
        os.makedirs(f"{self.folder}/commits", exist_ok=True)
        there, batch = self.commits(), quote(batch, safe="")
        if any(f.partition("-")[2] == f"{batch}.json" for _, f in there):
            return False
        number = there[-1][0] + 1 if there else 1
        target = f"{self.folder}/commits/{number:012d}-{batch}.json"
        with open(f"{target}.new", "w") as out:
            json.dump(attempts, out)
        os.replace(f"{target}.new", target)
        return True

    def settle(self, db: sqlite3.Connection, bucket: int) -> None:
        """Apply the commits that this bucket does not have yet."""
        db.execute("BEGIN IMMEDIATE")
        done = db.execute("SELECT coalesce(max(number), 0) FROM applied").fetchone()[0]
        for number, file in self.commits():
            if number > done:
                with open(f"{self.folder}/commits/{file}") as made:
                    attempts = [a for b, a in json.load(made) if b == bucket]
                for attempt in attempts:
                    _apply(db, attempt)
                db.execute("INSERT INTO applied VALUES (?)", (number,))
        db.execute("DELETE FROM applied WHERE number < (SELECT max(number) FROM applied)")
        db.execute("COMMIT")


def _columns(db: sqlite3.Connection, table: str) -> list[str]:
    return [row[1] for row in db.execute(f"PRAGMA table_info({_quoted(table)})")]


def _apply(db: sqlite3.Connection, attempt: str) -> None:
    fields, stored = _columns(db, attempt), set(_columns(db, "docs"))
    for field in fields:
        if field not in stored:
            db.execute(f"ALTER TABLE docs ADD COLUMN {_quoted(field)}")
    names = ", ".join(map(_quoted, fields))
    new = ", ".join(f"{_quoted(f)} = excluded.{_quoted(f)}" for f in fields if f != KEY)
    # "WHERE true" keeps the parser from taking ON for a join's.
    db.execute(f"INSERT INTO docs ({names}) SELECT {names} FROM {_quoted(attempt)} WHERE true "
               f"ON CONFLICT ({_quoted(KEY)}) DO {'UPDATE SET ' + new if new else 'NOTHING'}")
    db.execute(f"DROP TABLE {_quoted(attempt)}")


@dataclass
class PutAside(WriterCommitMessage):
    attempts: list[tuple[int, str]]


class _Writer:
    """What the batch and the stream writer share."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        options = {k.lower(): v for k, v in options.items()}
        self.store = Collection(options["path"], options["collection"],
                                int(options.get("buckets", BUCKETS)))
        self.batch = options.get("batch") or uuid.uuid4().hex
        self.fields = schema.names
        if KEY not in self.fields:
            raise ValueError(f"rows without {KEY}")
        odd = [f.name for f in schema if not isinstance(f.dataType, _TYPES)]
        if odd:
            raise ValueError(f"columns of types that a document cannot hold: {odd}")

    def put_aside(self, batches: Iterator[pa.RecordBatch]) -> PutAside:
        open_: dict[int, sqlite3.Connection] = {}
        attempt = f"aside_{uuid.uuid4().hex}"
        key = self.fields.index(KEY)
        names = ", ".join(map(_quoted, self.fields))
        insert = f"INSERT INTO {attempt} VALUES ({', '.join('?' * len(self.fields))})"
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, _ROWS):
                    rows: dict[int, list[tuple]] = {}
                    part = batch.slice(at, _ROWS)
                    for row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                        rows.setdefault(self.store.bucket_of(row[key]), []).append(row)
                    for bucket, own in rows.items():
                        if bucket not in open_:
                            open_[bucket] = self.store.open(bucket)
                            open_[bucket].execute(f"CREATE TABLE {attempt} ({names})")
                        db = open_[bucket]
                        db.execute("BEGIN IMMEDIATE")
                        db.executemany(insert, own)
                        db.execute("COMMIT")
            return PutAside([(bucket, attempt) for bucket in open_])
        except BaseException:
            self.drop([(bucket, attempt) for bucket in open_])
            raise
        finally:
            for db in open_.values():
                db.close()

    def drop(self, attempts: list[tuple[int, str]]) -> None:
        for bucket, attempt in attempts:
            with suppress(sqlite3.Error), closing(self.store.open(bucket)) as db:
                db.execute(f"DROP TABLE IF EXISTS {attempt}")

    def finish(self, batch: str, messages: list) -> None:
        attempts = [a for m in messages if m is not None for a in m.attempts]
        if not self.store.commit(batch, attempts):
            self.drop(attempts)

    def undo(self, messages: list) -> None:
        self.drop([a for m in messages if m is not None for a in m.attempts])


class DocumentWriter(_Writer, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> PutAside:
        return self.put_aside(iterator)

    def commit(self, messages) -> None:
        self.finish(self.batch, messages)

    def abort(self, messages) -> None:
        self.undo(messages)


class DocumentStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> PutAside:
        return self.put_aside(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.finish(f"{self.batch}-{batchId}", messages)

    def abort(self, messages, batchId: int) -> None:
        self.undo(messages)


@dataclass
class Bucket(InputPartition):
    number: int

    def __post_init__(self):
        super().__init__(self.number)


class DocumentReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        options = {k.lower(): v for k, v in options.items()}
        self.store = Collection(options["path"], options["collection"])
        self.schema = schema

    def partitions(self) -> list[Bucket]:
        return [Bucket(n) for n in self.store.known()] or [Bucket(-1)]

    def read(self, partition: Bucket) -> Iterator[tuple]:
        if partition.number < 0:
            return
        with closing(self.store.open(partition.number)) as db:
            self.store.settle(db, partition.number)
            stored = set(_columns(db, "docs"))
            wanted = ", ".join(_quoted(f) if f in stored else "NULL" for f in self.schema.names)
            kinds = [float if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else None
                     for f in self.schema]
            for row in db.execute(f"SELECT {wanted} FROM docs"):
                yield tuple(v if v is None or k is None else k(v)
                            for v, k in zip(row, kinds, strict=True))


class DocumentSource(DataSource):
    """Options: ``path``, ``collection``, ``buckets`` (the same for a collection's life), and
    ``batch``, the name under which a write is committed once; a stream adds the batch's number."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def reader(self, schema) -> DocumentReader:
        return DocumentReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        if overwrite:
            raise ValueError("documents are upserted: use mode append")
        return DocumentWriter(dict(self.options), schema)

    def streamWriter(self, schema, overwrite: bool) -> DocumentStreamWriter:
        if not self.options.get("batch"):
            raise ValueError("a stream of documents needs a name in the option batch")
        return DocumentStreamWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentSource)


def write_documents(rows: DataFrame, path: str, collection: str, keys: list[str] | None = None,
                    batch: str | None = None) -> None:
    """Upsert ``rows``; of several with one id the one that ``merge`` would keep."""
    register(rows.sparkSession)
    one = resolve_collisions(rows, collision_order(rows, keys)).drop("n_rows")
    writer = one.write.format("documents").mode("append").option("path", path)
    if batch:
        writer = writer.option("batch", batch)
    writer.option("collection", collection).save()


def read_documents(spark: SparkSession, path: str, collection: str, schema) -> DataFrame:
    """All documents of a collection, with the fields of ``schema``."""
    register(spark)
    return spark.read.format("documents").schema(schema).option("path", path) \
        .option("collection", collection).load()
