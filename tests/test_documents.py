"""The document store: upsert, commit, abort, and streams that write to it."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from netrollup.sinks import documents
from netrollup.sinks.documents import Collection, read_documents, write_documents
from netrollup.streaming.common import document_sink, external_sink

ROW = "_id string, a long, b double, c string"


def rows(spark, *values, schema=ROW):
    return spark.createDataFrame(list(values), schema)


def stored(spark, path, schema=ROW):
    return sorted((tuple(r) for r in read_documents(spark, path, "t", schema).collect()), key=str)


def test_fields_replace_and_absent_ones_stay(spark, tmp):
    write_documents(rows(spark, ("x", 1, 0.5, "one"), ("y", 2, None, None)), tmp, "t")
    write_documents(rows(spark, ("x", None, "p"), ("z", 9, "q"), schema="_id string, a long, d string"),
                    tmp, "t")
    full = ROW + ", d string"
    assert stored(spark, tmp, full) == [
        ("x", None, 0.5, "one", "p"), ("y", 2, None, None, None), ("z", 9, None, None, "q")]
    # A field that no document has is null; one is enough.
    assert stored(spark, tmp, "_id string, e long") == [("x", None), ("y", None), ("z", None)]


def test_a_batch_counts_once_under_its_name(spark, tmp):
    write_documents(rows(spark, ("x", 1, 1.0, "first")), tmp, "t", batch="one")
    write_documents(rows(spark, ("x", 2, 2.0, "second")), tmp, "t", batch="two/2")
    write_documents(rows(spark, ("x", 1, 1.0, "first")), tmp, "t", batch="one")
    assert stored(spark, tmp) == [("x", 2, 2.0, "second")]
    assert tables_aside(tmp) == []


def test_of_rows_with_one_id_the_greatest_stays(spark, tmp):
    write_documents(rows(spark, *[("x", i, float(i), str(i)) for i in range(50)]), tmp, "t")
    assert stored(spark, tmp) == [("x", 49, 49.0, "49")]


def tables_aside(path):
    store, names = Collection(path, "t"), []
    for bucket in store.known():
        with sqlite3.connect(f"{store.folder}/bucket-{bucket}.db") as db:
            names += [n for (n,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")
                      if n.startswith("aside")]
    return names


def test_a_failed_write_leaves_the_documents_as_they_were(spark, tmp):
    write_documents(rows(spark, ("x", 1, 1.0, "old"), ("y", 1, 1.0, "old")), tmp, "t")
    broken = spark.range(200).select(
        F.concat(F.lit("k"), "id").alias("_id"),
        F.when(F.col("id") == 150, F.raise_error(F.lit("broken")).cast("long"))
        .otherwise(F.col("id")).alias("a")).unionByName(
        rows(spark, ("x", 7), schema="_id string, a long"))
    documents.register(spark)
    with pytest.raises(Exception, match="broken"):
        broken.write.format("documents").mode("append").option("path", tmp) \
            .option("collection", "t").save()
    assert stored(spark, tmp) == [("x", 1, 1.0, "old"), ("y", 1, 1.0, "old")]


def test_rows_without_commit_never_count(spark, tmp):
    """A driver that died before its commit; the batch is written again."""
    store = Collection(tmp, "t")
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("_id", StringType()), StructField("a", LongType())])
    options = {"path": tmp, "collection": "t", "batch": "q"}
    batch = pa.RecordBatch.from_pydict({"_id": ["x", "y", None], "a": [1, 2, 3]})
    first = documents.DocumentStreamWriter(options, schema).write(iter([batch]))
    assert len(first.attempts) > 1 and stored(spark, tmp) == []
    again = documents.DocumentStreamWriter(options, schema)
    done = again.write(iter([batch]))
    again.commit([done, None], 4)
    assert [r[:2] for r in stored(spark, tmp)] == [("x", 1), ("y", 2), (None, 3)] or \
        sorted((r[:2] for r in stored(spark, tmp)), key=str) == [(None, 3), ("x", 1), ("y", 2)]
    third = documents.DocumentStreamWriter(options, schema)
    other = third.write(iter([pa.RecordBatch.from_pydict({"_id": ["x"], "a": [99]})]))
    third.commit([other], 4)          # batch 4 has been committed
    assert ("x", 1) in [r[:2] for r in stored(spark, tmp)]
    third.abort([third.write(iter([batch]))], 5)
    assert store.commits()[-1][1].endswith("q-4.json")
    assert set(tables_aside(tmp)) == {a for _, a in first.attempts}


def test_refused_rows_and_paths(spark, tmp):
    with pytest.raises(Exception, match="without _id"):
        documents.DocumentWriter({"path": tmp, "collection": "t"}, spark.range(1).schema)
    odd = spark.range(1).select(F.lit("x").alias("_id"), F.array("id").alias("list"))
    with pytest.raises(Exception, match="list"):
        documents.DocumentWriter({"path": tmp, "collection": "t"}, odd.schema)
    with pytest.raises(ValueError):
        Collection("hdfs://host/path", "t")
    assert Collection("file:///tmp/a/", "t").folder == "/tmp/a/t"
    assert stored(spark, f"{tmp}/none") == []


def test_sinks_of_the_streams(spark, tmp):
    class Spec:
        table, keys = "t", ("a",)

    frame = rows(spark, ("x", 1, 1.5, "v"))
    document_sink(tmp)(frame, Spec)
    # The sink for connectors, through this one.
    external_sink("documents", {"path": tmp})(
        rows(spark, ("x", 2), schema="_id string, a long"), Spec)
    assert stored(spark, tmp) == [("x", 2, 1.5, "v")]
