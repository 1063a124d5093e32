"""Ranked lexical search by scanning the documents with an automaton, without a document index.

The distinct terms of all items are broadcast and built into one Aho-Corasick automaton.  A text is
brought into a form in which one space stands for every character that is in no term, with a space
at each end, and a term is a pattern with a space on either side: so the automaton finds whole terms
alone, and its matches are the term frequencies.  One scan counts, over all documents, the terms of
a document, N, L and the df of every pattern; a second one scores.  A pattern's outputs are the
items that hold it, so a document adds up the scores of all items it has a term of.  Each task keeps
the best rows of each item, and two windows, the first over parts of an item, rank them.

Items are a query set in blocks: a block's texts are collected and broadcast, and their size is
bounded by ``block_bytes``; more items take more scans of the documents, not more memory.

Defined cases: a null text has no terms and is never found, and an item without terms finds nothing;
equal rows of documents are ranked each, equal scores by ascending id with a null id last, and rows
that are equal in both in any order; items with one id are ranked together as if their terms stood
in one item; a null item id is an id; empty tables give no rows; columns with other names do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netrollup.llm.common import map_batches, quoted, staged

TOP = 50
#: Texts of items that one automaton is made of.
BLOCK_BYTES = 8_000_000
#: Parts that the best rows of an item are ranked in before they meet.
PARTS = 64
_SCALE = 1_000_000_000
_EXACT = 2 ** 52

#: A-Z to a-z; what is in no term to a space; all else, also every byte of other letters, stays.
_FORM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def normal(text: str) -> bytes:
    """The terms of ``text``, with a space in place of every character that is in none."""
    return text.encode("utf-8", "surrogatepass").translate(_FORM)


def terms_of(text: str | None) -> list[str]:
    return [t.decode("utf-8", "surrogatepass") for t in normal(text or "").split()]


def automaton(terms: list[str]):
    """Finds a term of the sorted ``terms`` by its number, in a text with a space at each end."""
    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(f" {term} ", i)
    if terms:
        found.make_automaton()
    return found


def frequencies(found, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of terms in ``text``, and the patterns in it with their frequencies."""
    form = normal(text)
    n = len(form.split())
    if not n or not len(found):
        return n, np.empty(0, np.int64), np.empty(0, np.int64)
    padded = f" {form.decode('utf-8', 'surrogatepass')} "
    hits = np.fromiter(map(itemgetter(1), found.iter(padded)), np.int64)
    return n, *np.unique(hits, return_counts=True)


def _texts(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(name).to_pylist()


def _count(docs: DataFrame, terms) -> DataFrame:
    """(term, df) of the broadcast ``terms``, and under term -1 the counts N and L."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms.value)
        df, n_docs, n_terms = np.zeros(len(terms.value), np.int64), 0, 0
        for batch in batches:
            for text in filter(None, _texts(batch, "text")):
                n, which, _ = frequencies(found, text)
                df[which] += 1
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(df[some], n_docs)),
             pa.array(np.append(np.zeros(len(some), np.int64), n_terms))], ["term", "df", "total"])

    counted = map_batches(docs.select("text"), "term long, df long, total long", work)
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def _best(rows: pa.Table, top: int) -> pa.Table:
    """The ``top`` first rows of each item: highest score, then least id."""
    rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    item = rows.column("item").to_numpy()
    first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
    place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
    return rows.filter(pa.array(place < top))


def _score(docs: DataFrame, terms, items, weights, n_docs: int, n_terms: int, n_items: int,
           top: int) -> DataFrame:
    """Each task's best rows: ``item`` (its number), ``id``, ``score``."""
    id_type = docs.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms.value)
        starts, postings = items.value
        w = weights.value
        bound = np.zeros(n_items, np.int64)
        waiting: list[pa.Table] = []
        most = max(200_000, 2 * top * n_items)

        def settle() -> None:
            best = _best(pa.concat_tables(waiting), top)
            item, score = best.column("item").to_numpy(), best.column("score").to_numpy()
            last = np.flatnonzero(np.append(item[1:] != item[:-1], True))
            # Below the worst of a full list nothing can enter.
            full = np.diff(np.append(-1, last)) >= top
            bound[item[last]] = np.where(full, score[last], 0)
            waiting[:] = [best]

        def gains(which: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
            """Items that can still take a document, and its scores for them."""
            m = 50 + (50 * n * n_docs) // n_terms
            gain = w[which] * ((_SCALE * tf) // (1000 * tf + 20 * m))
            # The outputs of the patterns: the items that hold them.
            counts = starts[which + 1] - starts[which]
            begin = np.repeat(starts[which] - np.append(0, np.cumsum(counts)[:-1]), counts)
            held = postings[begin + np.arange(counts.sum())]
            touched, where = np.unique(held, return_inverse=True)
            if gain.sum() < _EXACT:      # doubles add whole numbers of this size exactly
                score = np.bincount(where, np.repeat(gain, counts)).astype(np.int64)
            else:
                score = np.zeros(len(touched), np.int64)
                np.add.at(score, where, np.repeat(gain, counts))
            good = (score > 0) & (score >= bound[touched])
            return touched[good], score[good]

        for batch in batches:
            ids, got = batch.column("id"), []

            def keep(ids=ids, got=got) -> None:
                if got:
                    waiting.append(pa.table({
                        "item": np.concatenate([x[1] for x in got]),
                        "id": ids.take(pa.array(np.repeat([x[0] for x in got],
                                                          [len(x[1]) for x in got]))),
                        "score": np.concatenate([x[2] for x in got])}))
                    got.clear()

            size = sum(map(len, waiting))
            for row, text in enumerate(_texts(batch, "text")):
                n, which, tf = frequencies(found, text or "")
                held, score = gains(which, tf, n) if len(which) else ((), ())
                if len(held):
                    got.append((row, held, score))
                    size += len(held)
                    if size > most:
                        keep()
                        settle()
                        size = len(waiting[0])
            keep()
        if waiting:
            settle()
            yield from waiting[0].combine_chunks().to_batches()

    out = f"item long, id {id_type.simpleString()}, score long"
    return map_batches(docs.select("id", "text"), out, work)


def _block(items: DataFrame, docs: DataFrame, top: int) -> DataFrame:
    """Ranks for one block of items (item, text), whose size its caller has bounded."""
    spark = items.sparkSession
    held: dict = {}
    for row in items.collect():
        held.setdefault(row.item, set()).update(terms_of(row.text))
    names = [item for item, terms in held.items() if terms]
    terms = sorted(set().union(*held.values())) if held else []
    number = {t: i for i, t in enumerate(terms)}
    pairs = sorted((number[t], i) for i, item in enumerate(names) for t in held[item])
    postings = np.array([i for _, i in pairs], np.int64)
    starts = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(terms) + 1))
    sent = spark.sparkContext.broadcast
    the_terms = sent(terms)
    counted = {r.term: r for r in _count(docs, the_terms).collect()}  # a row for each term
    n_docs, n_terms = (counted[-1].df, counted[-1].total) if -1 in counted else (0, 0)
    weights = np.array([weight(n_docs, counted[i].df) if i in counted else 0
                        for i in range(len(terms))], np.int64)
    best = _score(docs, the_terms, sent((starts, postings)), sent(weights), n_docs,
                  max(n_terms, 1), len(names), top)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    part = best.withColumn("part", F.spark_partition_id() % PARTS)
    first = Window.partitionBy("item", "part").orderBy(*order)
    last = Window.partitionBy("item").orderBy(*order)
    ranked = (
        part.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    )
    known = spark.createDataFrame(list(enumerate(names)), f"item long, item_id "
                                  f"{items.schema['item'].dataType.simpleString()}")
    return ranked.join(F.broadcast(known), "item").select("item_id", "rank", "id", "score")


def search(items: DataFrame, docs: DataFrame, *, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text", top: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each item's ``top`` documents with a score above 0: ``item_id``, ``rank`` from 1, ``doc_id``
    and ``score``."""
    queries = items.select(F.col(quoted(item_id)).alias("item"),
                           F.col(quoted(item_text)).cast("string").alias("text"))
    rows = docs.select(F.col(quoted(doc_id)).alias("id"),
                       F.col(quoted(text)).cast("string").alias("text"))
    size = queries.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    # By hash of the id, so that rows of one item stay together; half full on the average.
    blocks = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    done = []
    for at in range(blocks):
        own = queries if blocks == 1 else queries.where(
            F.pmod(F.xxhash64("item"), F.lit(blocks)) == at)
        done.append(_block(own, rows, top))
        if blocks > 1:
            done[-1] = staged(done[-1], "search-block")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"),
                        F.col("id").alias("doc_id"), "score")
