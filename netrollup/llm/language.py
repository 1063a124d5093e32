"""Language identification by Bayesian evidence fusion.

The text's evidence is the likelihood of its byte trigrams under each language, learned from a
bounded sample of each language's labelled rows.  Languages the texts point to are then counted in groups: by
host, by address suffix, over all, and by declared language.  A host's prior is its own counts
smoothed by its suffix's, and that by the overall counts; the declared language adds how often
texts of a language carry such a declaration.  The posterior is the product of the three.  A
further class, ``und``, stands for text that fits no language: all trigrams are as likely.

Rejected are rows without letters, rows whose best class is ``und``, and rows whose best language
has a posterior under ``least``.

Defined cases: a null or empty text has no letters; a null host or declaration is no evidence;
without labelled rows every row is ``und`` and rejected; repeated rows are identified each on
its own; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netrollup.llm.common import gives_back, quoted, small_side, staged, text_or_empty, whole_row

BITS = 14
#: About so many distinct labelled texts of each language are learned from, those with the least
#: hashes.
SAMPLE = 4000
TRAIN_PARTS = 8
MIN_ROWS = 5          # labelled rows that make a language known, whatever the table's size
#: At most so many languages are known, those with the most rows; the rest are ``und``.
MOST_LANGUAGES = 200
GRAMS_COUNT = 100     # trigrams that a text counts as at most: they do not occur independently
ODD = 0.1             # share of a text that may be names and codes of no language
SMOOTHING = 20.0      # documents that a wider group counts as in a narrower one
LEAST = 0.5
UNKNOWN = "und"

# A-Z to a-z; all other ASCII but letters to spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket of byte trigrams occurs in a whole text."""
    folded = np.frombuffer(
        b" " + text.encode("utf-8", "surrogatepass").translate(_FOLD) + b" ", np.uint8)
    if len(folded) < 3:
        return np.zeros(1 << BITS, np.int64)
    a, b, c = folded[:-2], folded[1:-1], folded[2:]
    letters = (a == 32).astype(np.int8) + (b == 32) + (c == 32) < 2
    code = (a.astype(np.uint32) | b.astype(np.uint32) << 8 | c.astype(np.uint32) << 16)[letters]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - BITS),
                       minlength=1 << BITS)


@dataclass
class Model:
    """Log probability of each bucket, by language; the last row is ``und``."""

    languages: list[str]
    log_p: np.ndarray

    def log_likelihoods(self, text: str) -> tuple[int, np.ndarray]:
        counts = gram_counts(text)
        n = int(counts.sum())
        return n, (self.log_p @ counts) * (min(n, GRAMS_COUNT) / max(n, 1))


def train(docs: DataFrame, *, text: str = "text", label: str = "lang",
          sample: int = SAMPLE) -> Model:
    rows = docs.select(text_or_empty(text).alias("text"), F.col(label).alias("lang")).where(
        F.col("lang").isNotNull())
    # Copies are one text.  Labels are counted as rows, whether sampled or not.
    sizes = rows.groupBy("lang", F.md5("text").alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")) \
        .where(F.col("n") >= MIN_ROWS).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    bounds = rows.sparkSession.createDataFrame(
        [(r.lang, int(min(1.0, sample / r.texts) * (1 << 40))) for r in sizes],
        "of string, bound long")
    chosen = (
        rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
        .join(F.broadcast(bounds), (F.col("lang") == F.col("of")) & (F.col("h") < F.col("bound")))
        .withColumn("key", F.md5("text")).dropDuplicates(["lang", "key"]).coalesce(TRAIN_PARTS)
    )

    def count(batches):
        per: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                per[lang] = per.get(lang, 0) + gram_counts(t.as_py())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(per), pa.string()),
             pa.array([c.tolist() for c in per.values()], pa.list_(pa.int64()))],
            names=["lang", "counts"])

    counted: dict[str, np.ndarray] = {}
    # At most one row for each language and part of the bounded sample.
    for row in chosen.select("text", "lang").mapInArrow(
            count, "lang string, counts array<long>").collect():
        counted[row.lang] = counted.get(row.lang, 0) + np.array(row.counts)
    languages = sorted(counted)
    log_p = [np.log((1 - ODD) * (counted[x] + 0.5) / (counted[x].sum() + 0.5 * (1 << BITS))
                    + ODD / (1 << BITS)) for x in languages]
    log_p.append(np.full(1 << BITS, -BITS * np.log(2.0)))
    return Model([*languages, UNKNOWN], np.array(log_p))


def host_of(url: Column) -> tuple[Column, Column]:
    """Host and address suffix of an address; null where it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    return host, F.substring_index(host, ".", -1)


def declared_of(html: Column) -> Column:
    """Language that a page's markup declares, without its region; null where it has none."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def _with_text_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (doc, text, declared, host, suffix) with ``grams`` and ``evidence``, the log
    likelihoods by class, in place of ``text``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # languages times 2 ** BITS numbers
    at = rows.columns.index("text")

    def work(batches):
        model = shared.value
        for batch in batches:
            found = [model.log_likelihoods(t.as_py() or "") for t in batch.column(at)]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([n for n, _ in found], pa.int64()),
                 pa.array([x.tolist() for _, x in found], pa.list_(pa.float64()))],
                names=[*names, "grams", "evidence"])

    schema = T.StructType([f for f in rows.schema if f.name != "text"])
    return rows.mapInArrow(gives_back(work), schema.add("grams", T.LongType()).add(
        "evidence", T.ArrayType(T.DoubleType())))


def _best(scores: Column) -> Column:
    """Place of the greatest of an array of numbers; the first of equal ones."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def _log_prior(counts: str, wider: Column) -> Column:
    """Smoothed log shares of an array of counts."""
    return F.transform(F.col(counts), lambda n, k: F.log(
        (n + SMOOTHING * F.exp(F.get(wider, k)))
        / (F.aggregate(F.col(counts), F.lit(0.0), lambda a, b: a + b) + SMOOTHING)))


def _summed(rows: DataFrame, by: str, classes: int) -> DataFrame:
    return rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.array(*[
        F.sum(F.when(F.col("best") == k, F.col("n")).otherwise(0)).cast("double")
        for k in range(classes)]).alias(f"{by}_counts"))


def identify(docs: DataFrame, model: Model, *, text: Column | str = "text",
             declared: Column | None = None, host: Column | None = None,
             suffix: Column | None = None, least: float = LEAST) -> DataFrame:
    """One row per document: ``doc`` (the whole row), ``text_lang`` (by the text alone),
    ``lang``, ``confidence`` (its posterior), ``grams`` and ``kept``."""
    nothing = F.lit(None).cast("string")
    body = text_or_empty(text) if isinstance(text, str) else F.coalesce(text, F.lit(""))
    pick = {name: (nothing if c is None else c.cast("string")).alias(name)
            for name, c in (("declared", declared), ("host", host), ("suffix", suffix))}
    classes = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages])

    # Pass one: languages that the texts alone point to, counted by group.
    slim = _with_text_evidence(docs.select(body.alias("text"), *pick.values()), model)
    groups = staged(
        slim.where("grams > 0").withColumn("best", _best(F.col("evidence")))
        .groupBy("declared", "host", "suffix", "best").agg(F.count(F.lit(1)).alias("n")),
        "language-groups")
    # One number for each class.
    seen = {r.best: r.n for r in groups.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    every = sum(seen.values())
    overall = F.array(*[F.lit(float(np.log((seen.get(k, 0) + 1) / (every + classes))))
                        for k in range(classes)])
    suffixes = _summed(groups, "suffix", classes).select(
        F.col("suffix").alias("s"), _log_prior("suffix_counts", overall).alias("suffix_prior"))
    suffixes = staged(suffixes, "language-suffixes")
    hosts = _summed(groups.groupBy("host", "best").agg(
        F.sum("n").alias("n"), F.max("suffix").alias("suffix")), "host", classes).join(
        groups.where("host IS NOT NULL").groupBy(F.col("host").alias("h"))
        .agg(F.max("suffix").alias("of")), F.col("host") == F.col("h"))
    hosts = staged(
        hosts.join(small_side(suffixes), F.col("of") == F.col("s"), "left").select(
            "h", _log_prior("host_counts", F.coalesce("suffix_prior", overall)).alias("host_prior")),
        "language-hosts")
    # log P(declaration | language), smoothed towards the declaration's overall share.
    per_class = F.array(*[F.lit(float(seen.get(k, 0))) for k in range(classes)])
    says = _summed(groups, "declared", classes).withColumn(
        "share", F.aggregate("declared_counts", F.lit(0.0), lambda a, b: a + b)
        / F.lit(float(max(every, 1))))
    says = staged(says.select(F.col("declared").alias("d"), F.transform(
        "declared_counts", lambda n, k: F.log((n + F.col("share"))
                                              / (F.get(per_class, k) + 1))).alias("says")),
        "language-declared")

    # Pass two: all evidence together.
    rows = _with_text_evidence(docs.select(
        whole_row(docs), body.alias("text"),
        *pick.values()), model)
    zeros = F.array(*[F.lit(0.0)] * classes)
    joined = (
        rows.join(small_side(hosts), F.col("host") == F.col("h"), "left")
        .join(small_side(suffixes), F.col("suffix") == F.col("s"), "left")
        .join(small_side(says), F.col("declared") == F.col("d"), "left")
        .withColumn("prior", F.coalesce("host_prior", "suffix_prior", overall))
        .withColumn("says", F.coalesce("says", zeros))
        .withColumn("scores", F.transform("evidence", lambda e, k: e + F.get(
            F.col("prior"), k) + F.get(F.col("says"), k)))
    )
    total = F.aggregate("scores", F.lit(0.0),
                        lambda a, x: a + F.exp(x - F.array_max("scores")))
    return joined.select(
        "doc", "grams",
        F.when(F.col("grams") == 0, UNKNOWN).otherwise(
            F.get(names, _best(F.col("evidence")))).alias("text_lang"),
        F.when(F.col("grams") == 0, UNKNOWN).otherwise(
            F.get(names, _best(F.col("scores")))).alias("lang"),
        F.when(F.col("grams") == 0, 0.0).otherwise(1 / total).alias("confidence"),
    ).withColumn("kept", (F.col("lang") != UNKNOWN) & (F.col("confidence") >= least))


def identified(docs: DataFrame, *, text: str = "text", label: str = "lang",
               host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with ``label`` set to the language found; the
    label given is the declared language and ``host`` names the rows' origin."""
    found = identify(docs, train(docs, text=text, label=label), text=text,
                     declared=F.col(label), host=F.col(host)).where("kept")
    return found.select(F.col("doc").withField(quoted(label), F.col("lang")).alias("doc")) \
        .select("doc.*")
