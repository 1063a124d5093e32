"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors: one for each hashed word and each hashed
character 3- and 4-gram of its words, and one for a word that repeats the word before it.  A
softmax layer on top gives the two classes.  Both are trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows.  As the layer is linear, a word adds a fixed amount
to the score, which is computed once and looked up.

Defined cases: a null or empty text gets the bias alone; without labelled rows every score is
0.5; where a doc_id has several labels or texts, training takes the greatest label and the
smallest text; every row is scored, repeated ones too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
DIM = 8
#: At most so many labelled documents are learned from: those with the least hash of doc_id.
SAMPLE = 4000
EPOCHS = 6
RATE = 2.0
_REPEAT = BUCKETS  # feature of a word that equals the word before
_CACHED_WORDS = 300_000

_worker: dict = {}


def word_features(word: bytes) -> list[int]:
    """Buckets of a word and of its character 3- and 4-grams."""
    text = b"<" + word + b">"
    out = [crc32(text) % BUCKETS]
    chars = text.decode("utf-8", "replace")
    if len(chars) == len(text):
        grams = (text[i:i + n] for n in (3, 4) for i in range(len(text) - n + 1))
    else:
        grams = (chars[i:i + n].encode() for n in (3, 4) for i in range(len(chars) - n + 1))
    out.extend([crc32(g) % BUCKETS for g in grams])
    return out


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a whole text and how often each occurs."""
    words = text.encode("utf-8", "surrogatepass").split()
    features = [f for w in words for f in word_features(w)]
    features.extend([_REPEAT] * sum(map(eq, words, words[1:])))
    return np.unique(np.array(features, np.int32), return_counts=True)


@dataclass
class Model:
    """``worth`` of a feature: its vector times the difference of the two classes' weights."""

    worth: np.ndarray
    bias: float

    def probability(self, total: float, features: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + (
            total / features if features else 0.0)))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], *, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over (features, counts, label), one document at a time."""
    if not rows:
        return Model(np.zeros(BUCKETS + 1), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS + 1, dim))
    weights, bias = np.zeros((dim, 2)), np.zeros(2)
    steps, step = epochs * len(rows), 0
    # Both classes weigh the same, whatever their shares in the sample.
    ones = sum(label for *_, label in rows)
    weight = [len(rows) / 2 / max(1, len(rows) - ones), len(rows) / 2 / max(1, ones)]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            features, counts, label = rows[i]
            now = rate * (1 - step / steps) * min(2.0, weight[label])
            step += 1
            share = counts / max(1, counts.sum())
            hidden = share @ vectors[features]
            scores = hidden @ weights + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[label] -= 1
            back = weights @ p
            weights -= now * np.outer(hidden, p)
            bias -= 0.1 * now * p
            # The average spreads the gradient over all features; each moves by its share.
            vectors[features] -= now * 20 * share[:, None] * back
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


def _scorer(model: Model):
    """Scores texts; words' worths are kept for the life of the model in this worker."""
    if _worker.get("worth") is not model.worth:
        _worker.update(worth=model.worth, place={}, sums=[], counts=[])
    place, sums, counts = _worker["place"], _worker["sums"], _worker["counts"]
    repeat = float(model.worth[_REPEAT])

    def score(text: str) -> float:
        words = text.encode("utf-8", "surrogatepass").split()
        if not words:
            return model.probability(0.0, 0.0)
        try:
            at = [place[w] for w in words]
        except KeyError:
            if len(place) > _CACHED_WORDS:
                place.clear(), sums.clear(), counts.clear()
            for w in words:
                if w not in place:
                    features = word_features(w)
                    place[w] = len(sums)
                    sums.append(float(model.worth[features].sum()))
                    counts.append(len(features))
            at = [place[w] for w in words]
        again = sum(map(eq, words, words[1:]))
        return model.probability(sum([sums[i] for i in at]) + again * repeat,
                                 sum([counts[i] for i in at]) + again)

    return score


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
                  text: str = "text", label: str = "quality", sample: int = SAMPLE) -> list:
    """Features of at most ``sample`` labelled documents, in a fixed order, on the driver."""
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    # The chosen ids are at most ``sample``.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            found = [document_features(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()),
                 pa.array([f for f, _ in found], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32()))],
                names=["id", "label", "features", "counts"])

    table = texts.mapInArrow(
        features, "id long, label int, features array<int>, counts array<int>").toArrow()
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    label_of = table.column("label").to_pylist()
    of, counts = table.column("features"), table.column("counts")
    return [(of[i].values.to_numpy(), counts[i].values.to_numpy(), label_of[i])
            for i in order.tolist()]


def score_documents(docs: DataFrame, model: Model, *, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id and score, the probability of label 1, for every row's whole text."""
    # Two arrays of fixed size: BUCKETS + 1 numbers and one.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        score = _scorer(shared.value)
        for batch in batches:
            scores = [score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string")).mapInArrow(work, "doc_id long, score double")
