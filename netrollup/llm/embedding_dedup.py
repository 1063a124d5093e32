"""Near-duplicate embeddings: random-hyperplane hashing, exact verification, components.

Each of several tables hashes a vector to the signs of its products with random hyperplanes;
vectors at a small angle share most signs.  Within a bucket all pairs are compared exactly, in
double precision and in bounded blocks.  A pair that shares buckets of several tables is counted
in the first of them, which both vectors' codes tell, so links are counted where they are found
and never listed pair by pair: a bucket hands on sums, and edges that span its linked vectors.

Equal vectors are one class, compared once and counted with its size: a huge group of copies costs
as much as a vector that stands alone.

The number of signs grows with the logarithm of the number of classes, so buckets keep their size;
the number of tables follows from it and from ``recall`` at the threshold.

Defined cases: a vector that is null, empty, zero or has null or non-finite components links with
nothing; so do vectors of different lengths with each other; rows with equal ids are vectors like
others (their rows show the links of all of them), and a null id is never a component's name; no
rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.llm.blocks import deal
from netrollup.llm.common import small_side, staged
from netrollup.llm.components import components

THRESHOLD = 0.9
RECALL = 0.9999
BUCKET_ROWS = 256   # classes in a bucket, about
BLOCK_ROWS = 2048
SEED = 20


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Signs per table and tables for ``n`` classes.  Two vectors at the threshold agree on a
    sign with probability 1 - angle / pi."""
    bits = max(4, min(30, math.ceil(math.log2(max(n, 1) / BUCKET_ROWS)))) if n > BUCKET_ROWS else 4
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def planes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def codes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Code of each vector in each table."""
    signs = vectors @ planes(vectors.shape[1], bits, tables) >= 0
    weights = 1 << np.arange(bits)
    return (signs.reshape(len(vectors), tables, bits) * weights).sum(axis=2).astype(np.int32)


def _comparable(values: pa.Array, kind: str) -> list[bytes | None]:
    """Vectors as bytes; None for those that cannot be compared."""
    out = []
    for value in values.to_pylist():
        v = np.array([math.nan if x is None else x for x in value], kind) if value else None
        out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
    return out


def _units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Directions in double precision, of vectors of one length."""
    rows = np.frombuffer(b"".join(vectors), kind).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _as_bytes(kind: str):
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_comparable(batch.column(1), kind), pa.binary())],
                names=["vec_id", "vector"])

    return work


def _hashed(kind: str, bits: int, tables: int):
    def work(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            rows: list = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for i, vector in enumerate(vectors):
                by_size.setdefault(len(vector), []).append(i)
            for at in by_size.values():
                units = _units([vectors[i] for i in at], kind)
                for i, code in zip(at, codes(units, bits, tables), strict=True):
                    rows[i] = code.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(rows, pa.list_(pa.int32()))], names=["node", "vector", "copies", "codes"])

    return work


def _compare(kind: str, threshold: float):
    """Compares the rows of a task.  Out: per class its links found first here (``links``), and
    edges (``node``, ``to``) that span what is linked."""
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        table, left, right = (key[k].as_py() for k in (1, 3, 4))
        vectors = _units(rows.column("vector").to_pylist(), kind)
        code = np.array(rows.column("codes").to_pylist(), np.int32)[:, :table]
        copies, nodes = rows.column("copies").to_numpy(), rows.column("node").to_pylist()
        block = rows.column("block").to_numpy()
        ours = np.flatnonzero(block == left)
        theirs = ours if left == right else np.flatnonzero(block == right)
        links = np.zeros(rows.num_rows, np.int64)
        parent = list(range(rows.num_rows))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        edges = []
        for at in range(0, len(ours), 256):
            part = ours[at:at + 256]
            i, j = np.nonzero(vectors[part] @ vectors[theirs].T >= threshold)
            i, j = part[i], theirs[j]
            if left == right:
                i, j = i[i < j], j[i < j]
            # Counted where both share a bucket for the first time.
            first = np.empty(len(i), bool)
            for a in range(0, len(i), 65536):
                first[a:a + 65536] = ~(code[i[a:a + 65536]] == code[j[a:a + 65536]]).any(axis=1)
            i, j = i[first], j[first]
            if not len(i):
                continue
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            label = np.array([root(x) for x in range(rows.num_rows)])
            apart = np.unique(np.stack([label[i], label[j]], 1)[label[i] != label[j]], axis=0)
            for a, b in apart.tolist():
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((nodes[a], nodes[b]))
        some = np.flatnonzero(links).tolist()
        return pa.table({
            "node": pa.array([nodes[i] for i in some] + [a for a, _ in edges], pa.string()),
            "to": pa.array([None] * len(some) + [b for _, b in edges], pa.string()),
            "links": pa.array(links[some].tolist() + [None] * len(edges), pa.int64())})

    return work


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    kind = "f4" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "f8"
    rows = staged(
        vectors.select(F.col(id_col).cast("long"),
                       F.col(vector).cast("array<float>" if kind == "f4" else "array<double>"))
        .mapInArrow(_as_bytes(kind), "vec_id long, vector binary"), "vectors")
    classes = staged(
        rows.where("vector IS NOT NULL").groupBy("vector").agg(
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .select(F.md5("vector").alias("node"), "vector", "copies", "least"), "classes")
    bits, tables = plan(classes.count(), threshold, recall)
    hashed = staged(
        classes.select("node", "vector", "copies").mapInArrow(
            _hashed(kind, bits, tables),
            "node string, vector binary, copies long, codes array<int>"), "hashed")
    members = hashed.select(
        "node", "copies", F.length("vector").alias("dim"), "codes", "vector",
        F.posexplode("codes").alias("table", "code")
    ).withColumn("bucket", F.xxhash64("table", "code", "dim")).withColumn(
        "spread", F.xxhash64("node"))
    dealt = deal(members, "bucket", "spread", block_rows)
    found = staged(
        dealt.groupBy("bucket", "table", "dim", "left", "right").applyInArrow(
            _compare(kind, threshold), "node string, to string, links long"), "found")
    linked = found.where("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("to IS NOT NULL").select(
        F.col("node").alias("a"), F.col("to").alias("b")))
    own = staged(
        classes.join(joined.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
        .select("node", "copies", "least", F.coalesce("component", "node").alias("component")),
        "class-components")
    least = own.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    known = staged(
        own.join(least, F.col("component") == F.col("c"))
        .join(linked.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
        .select(F.col("node").alias("u"), "component_id",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")),
        "class-links")
    alone = F.col("u").isNull()
    return rows.withColumn("node", F.md5("vector")).join(
        small_side(known), F.col("node") == F.col("u"), "left"
    ).select(
        "vec_id", F.when(alone, 0).otherwise(F.col("links")).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
