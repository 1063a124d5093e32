"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one integer
whose bit i says that rule i failed.  A policy is a named set of rules; applying one, comparing
versions or leaving rules out reads the integers alone.

Everything is DataFrame functions.  A text's words, lines and 5-word windows are arrays inside one
row, so nothing is shuffled.  Windows are compared by 64-bit hashes.

Defined cases: a null text counts as empty and fails ``few_words``; every row has its own ledger
entry, repeated ones and such with null ids too; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import SPACE, text_or_empty

WINDOW = 5
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"

#: Bit i of the ledger is rule i.  A rule is a condition under which a document fails; it reads
#: the ledger's measurements.  Add rules at the end: stored bits keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 15 * word_chars",
    "duplicate_lines": "n_lines > 4 AND 100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars > 40 * n_words",
    "exclamations": "n_words >= 10 AND n_exclamations > n_words",
}

#: Versioned policies: the rules that decide.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "v2": list(RULES),
}


def mask(policy: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in POLICIES[policy])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(words: Column) -> Column:
    """Hashes of the windows of WINDOW words."""
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) < WINDOW, F.array().cast("array<bigint>")
    ).otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(
        *[F.get(h, i + k) for k in range(WINDOW)]))))


def _covered(starts: Column) -> Column:
    """Words in the windows that begin at ``starts`` (ascending)."""
    return F.aggregate(
        F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(
            F.get(starts, j + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)


def _repeat_words(words: Column) -> Column:
    def of(windows: Column) -> Column:
        in_order = F.array_sort(F.transform(
            windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _let(in_order, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, j: (x["h"] == F.get(s, j + 1)["h"]) | F.coalesce(
                (j > 0) & (x["h"] == F.get(s, F.greatest(j - 1, F.lit(0)))["h"]), F.lit(False))),
            lambda x: x["i"])))
        # Most texts repeat no window; a hash set tells them without sorting.
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            _let(twice, _covered))

    return _let(_windows(words), of)


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of every row's whole text."""
    value = F.col("text")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text).alias("text"))
    of_words = _let(
        F.filter(F.split(value, SPACE, -1), lambda w: w != ""),
        lambda words: F.struct(F.size(words).cast("long").alias("n"),
                               _repeat_words(words).cast("long").alias("repeated")))
    of_lines = _let(
        F.filter(F.split(value, "\n", -1), lambda x: F.translate(x, _SPACES, "") != ""),
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("repeated")))
    return texts.select(
        "doc_id", of_words.alias("words"), of_lines.alias("lines"),
        (F.length(value) - _count_chars(value, _SPACES)).cast("long").alias("word_chars"),
        _count_chars(value, _SYMBOLS).cast("long").alias("n_symbols"),
        _count_chars(value, "!").cast("long").alias("n_exclamations"),
    ).select(
        "doc_id", F.col("words.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.repeated").alias("n_dup_lines"),
        F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"), "n_exclamations")


def ledger(docs: DataFrame, **columns) -> DataFrame:
    """The measurements and ``failed``, the bits of the rules that a document fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, **columns).withColumn("failed", total)


def fails(policy: str, failed: Column | None = None) -> Column:
    """Whether a ledger entry fails any rule of ``policy``."""
    bits = F.col("failed") if failed is None else failed
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of ``policy``: the documents that fail it, and those that would be kept without
    it.  Documents are first counted by their bits, of which there are few combinations."""
    names = list(RULES)
    held = F.lit(mask(policy)).cast("long")
    patterns = entries.groupBy(F.col("failed").bitwiseAND(held).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(
        F.lit(rule).alias("rule"), F.lit(1 << names.index(rule)).cast("long").alias("bit"))
        for rule in POLICIES[policy]]))
    return (
        patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
        .groupBy("rule").agg(
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n"))),
                       F.lit(0)).alias("failing"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))),
                       F.lit(0)).alias("failing_this_alone"))
    )
