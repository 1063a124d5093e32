"""MinHash near-duplicates: SuperMinHash signatures, banding, exact verification, components.

SuperMinHash gives every element of a set a random permutation of the signature's places, in
place of independent hashes: in step j an element offers j plus a random fraction to the j-th
place of its permutation, and the least offer wins.  Offers grow with the step, so once every
place is taken no further step can change it and the work stops early; most documents need one
step.  Estimates vary less than those of independent hashes, above all for small sets.

Bands of the signature are bucket keys.  Equal sets are one class, so exact copies are one node.
First each class is compared with a few leaders of its buckets (those with the least hashes),
which joins most of a large group of near copies at a cost that is linear in its size.  What is
left are buckets whose classes are in different components; there all pairs in different
components are compared by their signatures in bounded blocks, and those that may be links are
verified on the full sets.  The result is the components of all verified links.

Defined cases: a document without words links with nothing and is its own component, whatever
else is empty; a null text counts as empty; rows with null ids are compared like others, and
the smallest id of a component is that of the rows that have one; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.llm.blocks import deal
from netrollup.llm.common import gives_back, small_side, staged, whole_row
from netrollup.llm.components import components

WORDS = 5          # words in a shingle
#: 100 * intersection >= PERCENT * union.  The bands are laid out for 80 and more.
PERCENT = 80
BANDS, ROWS = 32, 5
LEADERS = 4
BLOCK_ROWS = 2048
#: Pairs whose signatures agree in a share of places that is this much under the threshold are
#: not verified: at a similarity of 0.8 the share's standard deviation is at most 0.032, so this
#: is over four of them.
DOUBT = 0.14
_CHUNK = 50_000    # elements permuted at a time

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit numbers that looks random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    n = max(1, len(hashes) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(hashes))):
        out = mix(out + hashes[k:k + n] + _GOLDEN)
    return np.unique(out)


def signatures(sets: list[np.ndarray], places: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signatures of non-empty sets, as 64-bit numbers: the step in the upper bits,
    the fraction in the others."""
    out = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    order, start = np.arange(len(sets)), 0
    while start < len(order):  # so many sets at a time that their elements fit a chunk
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), _CHUNK, "right")))
        group = order[start:stop]
        _fill(out, group, np.concatenate([sets[i] for i in group]),
              np.repeat(group, sizes[group]), places)
        start = stop
    return out


def _fill(out: np.ndarray, group: np.ndarray, elements: np.ndarray, owner: np.ndarray,
          places: int) -> None:
    swaps: list[np.ndarray] = []  # the place each element of the group chose, by step
    perm = None
    for step in range(places):
        x = mix(elements + np.uint64((step + 1) * int(_GOLDEN) % (1 << 64)))
        choice = step + ((x >> np.uint64(32)) * np.uint64(places - step)
                         >> np.uint64(32)).astype(np.int64)
        offer = (np.uint64(step) << np.uint64(56)) | (mix(x) >> np.uint64(8))
        if step == 0:
            place = choice
        else:
            rows = np.arange(len(elements))
            if perm is None:
                perm = np.tile(np.arange(places, dtype=np.int16), (len(elements), 1))
                perm[rows, swaps[0]] = 0  # what step 0 has exchanged
                perm[:, 0] = swaps[0]
            place = perm[rows, choice].astype(np.int64)
            perm[rows, choice] = perm[:, step]
        swaps = [choice]
        np.minimum.at(out.reshape(-1), owner * places + place, offer)
        # A set all of whose places hold an offer of this step or before is done.
        open_ = out[group].max(axis=1) >> np.uint64(56) > step
        if not open_.any():
            return
        if not open_.all():
            keep = np.isin(owner, group[open_])
            elements, owner, swaps = elements[keep], owner[keep], [choice[keep]]
            perm = perm[keep] if perm is not None else None
            group = group[open_]


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; bands do not share keys."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (len(signature), 1))
    for r in range(rows):
        key = mix(key + parts[:, :, r] + _GOLDEN)
    return key.view(np.int64)


def _digest(elements: np.ndarray) -> str | None:
    return hashlib.md5(elements.tobytes()).hexdigest() if len(elements) else None


def _sign(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingles(t.as_py() or "", words) for t in part.column(1)]
                some = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                short: list = [None] * len(sets)
                if some:
                    sigs = signatures([sets[i] for i in some])
                    brief = mix(sigs).astype(np.uint8)
                    for i, key, one in zip(some, band_keys(sigs), brief, strict=True):
                        keys[i], short[i] = key.tolist(), one.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) for s in sets], pa.string()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                    names=["doc_id", "digest", "n_shingles", "node", "bands", "brief"])

    return work


def _sets(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                sets = [shingles(t.as_py() or "", words) for t in batch.column(0).slice(at, 200)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.string()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["node", "elements"])

    return work


def _likely_pairs(key: tuple, rows: pa.Table, percent: int):
    """Of the rows of a task, each i with the js that it may be linked with: in another component,
    signatures that agree well enough, and no earlier bucket that both share."""
    at, left, right = (key[k].as_py() for k in (1, 2, 3))
    brief = np.frombuffer(b"".join(rows.column("brief").to_pylist()), np.uint8) \
        .reshape(rows.num_rows, -1)
    earlier = np.array(rows.column("bands").to_pylist(), np.int64)[:, :at]
    own = np.unique(np.array(rows.column("component").to_pylist()), return_inverse=True)[1]
    n, block = rows.column("n_shingles").to_numpy(), rows.column("block").to_numpy()
    ours, theirs = np.flatnonzero(block == left), np.flatnonzero(block == right)
    for i in ours.tolist():
        js = theirs[theirs > i] if left == right else theirs
        js = js[(own[js] != own[i]) & (100 * np.minimum(n[js], n[i])
                                       >= percent * np.maximum(n[js], n[i]))]
        js = js[~(earlier[js] == earlier[i]).any(axis=1)]
        js = js[(brief[js] == brief[i]).mean(axis=1) >= percent / 100 - DOUBT]
        if len(js):
            yield i, js


def _promising(percent: int):
    """The rows of a task that have likely pairs."""
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        some: set[int] = set()
        for i, js in _likely_pairs(key, rows, percent):
            some.update([i, *js.tolist()])
        nodes = rows.column("node").to_pylist()
        return pa.table({"band": pa.array([key[0].as_py()] * len(some), pa.int64()),
                         "node": pa.array([nodes[i] for i in sorted(some)], pa.string())})

    return work


def _links(percent: int):
    """Links between the components of a task's rows, verified on the full sets."""
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        nodes, component = rows.column("node").to_pylist(), rows.column("component").to_pylist()
        sets = [e.values.to_numpy() for e in rows.column("elements")]
        parent = {c: c for c in component}

        def root(c: str) -> str:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        found = []
        for i, js in _likely_pairs(key, rows, percent):
            for j in js.tolist():
                a, b = root(component[i]), root(component[j])
                if a == b:  # joined by links of this task
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    parent[a] = b
                    found.append((nodes[i], nodes[j]))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return work


def _text_digest(text: str):
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on their full sets."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(f"node_{name}"),
                           F.col("elements").alias(f"elements_{name}"))

    both = F.size(F.array_intersect("elements_a", "elements_b"))
    together = F.size("elements_a") + F.size("elements_b") - both
    return staged(
        pairs.join(side("a"), F.col("a") == F.col("node_a"))
        .join(side("b"), F.col("b") == F.col("node_b"))
        .where(100 * both >= percent * together).select("a", "b"), "links")


def _links_between(members: DataFrame, classes: DataFrame, joined: DataFrame, sets: DataFrame,
                   block_rows: int, percent: int) -> DataFrame:
    """Links between different components within the buckets that hold several.

    Signatures tell which rows have likely pairs at all; only those are dealt out again, now with
    their full sets, so pairs are verified where they meet and need not be listed."""
    placed = staged(
        members.join(joined.select(F.col("node").alias("n"), "component"),
                     F.col("node") == F.col("n"), "left")
        .select("band", "at", "node", F.coalesce("component", "node").alias("component")), "placed")
    mixed = staged(
        placed.groupBy(F.col("band").alias("of")).agg(
            F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x != y").select("of"), "mixed")
    rows = staged(
        placed.join(mixed, F.col("band") == F.col("of")).drop("of")
        .join(classes.select(F.col("node").alias("n"), "n_shingles", "brief", "bands"),
              F.col("node") == F.col("n")).drop("n")
        .withColumn("spread", F.xxhash64("node")), "open")
    task = ("band", "at", "left", "right")
    some = staged(
        deal(rows, "band", "spread", block_rows).groupBy(*task)
        .applyInArrow(_promising(percent), "band long, node string")
        .select(F.col("band").alias("b"), F.col("node").alias("n")).distinct(), "promising")
    flagged = staged(
        rows.join(some, (F.col("band") == F.col("b")) & (F.col("node") == F.col("n")), "left_semi"),
        "flagged")
    full = deal(flagged, "band", "spread", max(1, block_rows // 4)).join(
        sets.select(F.col("node").alias("n"), "elements"), F.col("node") == F.col("n")).drop("n")
    return staged(full.groupBy(*task).applyInArrow(
        _links(percent), "a string, b string").distinct(), "links-between")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                    words: int = WORDS, percent: int = PERCENT,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, component (null for an empty text's),
    component_id and kept for every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text).cast("string").alias("text"))
    rows = staged(texts.withColumn("digest", _text_digest("text")).mapInArrow(
        gives_back(_sign(words)), "doc_id long, digest string, n_shingles long, node string, "
                      "bands array<long>, brief binary"), "signed")
    classes = staged(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("brief").alias("brief")), "classes")
    # Bucket rows; a class that shares no bucket is done.
    bands = classes.select("node", F.posexplode("bands").alias("at", "band"))
    leader = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node"))["node"]
              .alias(f"leader_{k}") for k in range(LEADERS)]
    buckets = staged(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), *leader)
                     .where("n > 1").drop("n").withColumnRenamed("band", "of"), "buckets")
    members = staged(bands.join(buckets.select("of"), F.col("band") == F.col("of"))
                     .select("band", "at", "node"), "members")
    # The full sets of all classes that share a bucket, computed once more from their texts.
    wanted = staged(
        members.select(F.col("node").alias("wanted")).distinct()
        .join(classes, F.col("wanted") == F.col("node"))
        .select("wanted", F.col("least").alias("id")), "wanted")
    sets = staged(
        texts.join(small_side(wanted.select("id").distinct()),
                   F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
        .select("text").mapInArrow(gives_back(_sets(words)), "node string, elements array<long>")
        .join(small_side(wanted.select("wanted")), F.col("node") == F.col("wanted"), "left_semi")
        .dropDuplicates(["node"]), "sets")

    leaders = F.array_distinct(F.array(*[F.col(f"leader_{k}") for k in range(LEADERS)]))
    pairs = staged(
        members.join(buckets, F.col("band") == F.col("of"))
        .select("node", F.explode(leaders).alias("leader")).where("node != leader")
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        .distinct(), "pairs")
    links = _verified(pairs, sets, percent)
    joined = staged(components(links), "components")
    links = links.unionByName(_links_between(members, classes, joined, sets, block_rows, percent))
    joined = components(links).select(F.col("node").alias("n"), "component")

    own = staged(
        classes.select("node", "least").join(joined, F.col("node") == F.col("n"), "left")
        .select("node", "least", F.coalesce("component", "node").alias("component")), "owned")
    least = own.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    known = staged(own.join(least, F.col("component") == F.col("c"))
                   .select(F.col("node").alias("k"), "component", "component_id"), "known")
    alone = F.col("node").isNull()
    return rows.join(known, F.col("node") == F.col("k"), "left").select(
        "doc_id", "digest", "n_shingles", "component",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """The rows of ``docs`` of which one of each group stays: that with the smallest id, or of
    rows without ids that with the smallest text digest; of equal rows one stays.  Documents
    without words all stay."""
    found = staged(near_duplicates(docs, id_col=id_col, text=text, **options)
                   .where("component IS NOT NULL")
                   .select("doc_id", "digest", "component"), "groups")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "digest"))
    winners = found.groupBy(F.col("component").alias("of")).agg(first.alias("w"))
    placed = staged(
        found.join(winners, F.col("component") == F.col("of"))
        .select("doc_id", "digest", (F.col("doc_id").eqNullSafe(F.col("w.doc_id"))
                                     & (F.col("digest") == F.col("w.digest"))).alias("stays"))
        .groupBy(F.col("doc_id").alias("the_id"), F.col("digest").alias("the_digest"), "stays")
        .agg(F.count(F.lit(1)).alias("n")), "winners")
    rows = docs.select(whole_row(docs),
                       F.col(id_col).cast("long").alias("own_id"),
                       _text_digest(text).alias("own_digest"))
    same = F.col("own_id").eqNullSafe(F.col("the_id")) & (F.col("own_digest") == F.col("the_digest"))
    kept = rows.join(small_side(placed.where("NOT stays")), same, "left_anti")
    again = placed.where("stays AND n > 1")
    if not again.isEmpty():
        again = small_side(again)
        kept = kept.join(again, same, "left_anti").unionByName(
            kept.join(again, same, "left_semi").dropDuplicates(["own_id", "own_digest"]))
    return kept.select("doc.*")
