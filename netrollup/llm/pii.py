"""Information-theoretic sanitisation of personal data.

Base spans (mail and network addresses, card and telephone numbers) come from patterns.  Besides,
terms that stand in the texts of a value may give it away once it is gone.  A value stands for
several entities c: itself, its digits, and what it shares with other values (mail domain, network,
number prefix).  Over the whole corpus, the information that a term t carries about an entity is
PMI(c; t) = log2(n(c,t) N / (df(c) df(t))), and the entity itself holds IC(c) = log2(N / df(c)).
In a document that holds c, a term with PMI / IC >= ``generalise_at`` is replaced by a general mark,
one with a share of ``remove_at`` or more is removed.  All counts are of distinct whole texts:
df(t) of those that hold the term, n(c,t) of those that hold both, wherever they stand; fewer than
``support`` are no evidence.  Documents without a base span stay as they are.

The kind of a value is no entity: the mark that takes the value's place tells it anyway.

Everything is DataFrame functions.  Only texts with base spans take part in the co-occurrence
counts; the text counts of their terms come from one pass over all texts.  Pairs that cannot reach
the share by the counts of their value and term alone are left out before they are made.  What is
joined to the texts in the end is one row for each text that has such terms.

Defined cases: a null text counts as empty and has no spans; equal texts get equal spans, whatever
their ids; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import (
    quoted,
    small_bytes,
    staged,
    text_or_empty,
    whole_row,
)

KINDS = ("email", "ip", "card", "phone")
#: The patterns with the same matches as the plain ones, in linear time: what cannot be given
#: back is possessive, and a run of characters is not entered in its middle, except where the
#: match before has ended (``\G``).
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = r"[\p{L}\p{N}]+"
MIN_TERM = 3       # characters
SUPPORT = 3        # distinct texts
GENERALISE_AT = 0.9
REMOVE_AT = 1.0
_BLOCK = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _running(numbers: Column) -> Column:
    """Running sums.  Summed in blocks, so that a text with very many matches stays cheap."""
    def of(xs: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(xs, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(blocks, lambda bs: _let(F.transform(bs, _total), lambda sums: F.flatten(
            F.transform(bs, lambda block, k: _let(
                _total(F.slice(sums, F.lit(1), k)), lambda before: F.transform(
                    block, lambda x, i: before + _total(F.slice(block, F.lit(1), i + 1))))))))

    return _let(numbers, lambda xs: F.when(F.size(xs) > 0, of(xs)).otherwise(
        F.array().cast("array<int>")))


def matches(text: Column, pattern: str) -> Column:
    """All matches as (s, e, v): code points of start and end, and the matched text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    return _let(found, lambda f: F.when(
        F.size(f) == 0, F.array().cast("array<struct<s: int, e: int, v: string>>")
    ).otherwise(_let(between, lambda gaps: _let(
        _running(F.transform(f, lambda v, i: F.get(gaps, i) + F.length(v))),
        lambda ends: F.transform(f, lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).alias("s"), F.get(ends, i).alias("e"),
            v.alias("v")))))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(char: Column, i: Column) -> Column:
        d = char.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return _total(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                              worth)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Struct of one array of spans for each kind."""
    maybe = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    digit = text.rlike("[0-9]")

    def of(kind: str) -> Column:
        return F.when(maybe.get(kind, digit), F.filter(
            matches(text, PATTERNS[kind]), lambda m: _holds(kind, m["v"]))).otherwise(
            F.array().cast("array<struct<s: int, e: int, v: string>>")).alias(kind)

    return F.struct(*[of(k) for k in KINDS])


def _terms(text: Column) -> Column:
    """Distinct terms of a whole text."""
    return F.filter(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))),
                    lambda t: F.length(t) >= MIN_TERM)


def _entities(kind: str, value: Column) -> Column:
    """Names of what a value stands for, itself first."""
    of = [F.concat(F.lit(f"{kind}:"), value)]
    if kind == "email":
        of.append(F.concat(F.lit("email-domain:"), F.lower(F.substring_index(value, "@", -1))))
    elif kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
        of += [F.concat(F.lit("ip-number:"), F.array_join(parts, ".")),
               F.concat(F.lit("ip-network:"), F.array_join(F.slice(parts, 1, 3), "."))]
    else:
        # A card's issuer; of a telephone number all but the subscriber's last four digits.
        digits = _digits(value)
        prefix = F.substring(digits, 1, 6) if kind == "card" else F.substring(
            digits, F.lit(1), F.length(digits) - 4)
        of += [F.concat(F.lit(f"{kind}-digits:"), digits),
               F.concat(F.lit(f"{kind}-prefix:"), prefix)]
    return F.array(*of)


def _based(docs: DataFrame) -> DataFrame:
    """Per distinct text with base spans: its key, the entities its values stand for, and all its
    terms."""
    def named(kind: str) -> Column:
        return F.flatten(F.transform(F.col("base")[kind], lambda m: _entities(kind, m["v"])))

    return (
        docs.where(F.greatest(*[F.size(F.col("base")[k]) for k in KINDS]) > 0)
        .select(F.md5("text").alias("key"),
                F.array_distinct(F.concat(*[named(k) for k in KINDS])).alias("values"),
                _terms(F.col("text")).alias("terms"))
        .dropDuplicates(["key"])
    )


def _distinct_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct text of ``docs`` once, and their number.  Only texts that occur more than
    once are brought together by their digests; all others stay where they are."""
    digests = docs.groupBy(F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    copies = staged(digests.where("n > 1"), "pii-copies")
    n_rows, counted = docs.count(), copies.agg(F.count(F.lit(1)), F.sum("n")).first()
    keyed = docs.select("text", F.md5("text").alias("digest"))
    known = small_bytes(copies.select("digest"), F.lit(64))
    once = keyed.join(known, "digest", "left_anti").select("text")
    several = keyed.join(known, "digest", "left_semi").dropDuplicates(["digest"]).select("text")
    return once.unionByName(several), n_rows - (counted[1] or 0) + counted[0]


def _pairs(based: DataFrame, per_value: DataFrame, per_term: DataFrame, n_docs: int,
           generalise_at: float) -> DataFrame:
    """(key, value, term, df_value, df_term) for the pairs of a text that can carry the share.

    A share of g asks for n(c,t) >= df(t) (df(c) / N) ^ (1 - g).  As n(c,t) is at most df(c) and
    at most the number of texts with values that hold t, most pairs are out before they are
    made; what is left is exploded, and nothing that could pass is missing.
    """
    held = F.collect_list(F.struct("term", "df_based", "df_term")).alias("terms")
    terms = based.select("key", F.explode("terms").alias("term")).join(
        small_bytes(per_term, F.octet_length("term") + 64), "term").groupBy("key").agg(held)
    values = based.select("key", F.explode("values").alias("value")).join(
        small_bytes(per_value, F.octet_length("value") + 64), "value").groupBy("key").agg(
        F.collect_list(F.struct("value", "df_value")).alias("values"))

    def of(c: Column) -> Column:
        needed = F.pow(c["df_value"] / F.lit(float(max(n_docs, 1))), F.lit(1 - generalise_at))
        can = F.filter("terms", lambda t: F.least(t["df_based"], c["df_value"])
                       >= t["df_term"] * (needed - 1e-9))
        return F.transform(can, lambda t: F.struct(
            c["value"].alias("value"), t["term"].alias("term"),
            c["df_value"].alias("df_value"), t["df_term"].alias("df_term")))

    return terms.join(values, "key").select(
        "key", F.explode(F.flatten(F.transform("values", of))).alias("pair")).select(
        "key", "pair.*")


def _told(docs: DataFrame, based: DataFrame, support: int,
          generalise_at: float) -> tuple[DataFrame, DataFrame]:
    """``value`` (an entity), ``term`` and ``share``, the part of its information that the term
    carries; and the stored pairs of each text that they were counted from."""
    per_value = staged(
        based.select(F.explode("values").alias("value")).groupBy("value")
        .agg(F.count(F.lit(1)).alias("df_value")).where(F.col("df_value") >= support), "pii-values")
    wanted = staged(
        based.select(F.explode("terms").alias("term")).groupBy("term")
        .agg(F.count(F.lit(1)).alias("df_based")).where(F.col("df_based") >= support), "pii-terms")
    texts, n_docs = _distinct_texts(docs)
    least = (support / max(n_docs, 1)) ** (1 - generalise_at)
    # Counted before the join, so that what is shuffled is each task's vocabulary.
    per_term = staged(
        texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term")
        .agg(F.count(F.lit(1)).alias("df_term"))
        .join(small_bytes(wanted, F.octet_length("term") + 64), "term")
        .where(F.col("df_based") >= F.col("df_term") * (least - 1e-9)), "pii-term-counts")
    pairs = staged(_pairs(based, per_value, per_term, n_docs, generalise_at), "pii-pairs")
    together = pairs.groupBy("value", "term").agg(
        F.first("df_value").alias("df_value"), F.first("df_term").alias("df_term"),
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    pmi = F.log2(F.col("n") * F.lit(float(n_docs)) / (F.col("df_value") * F.col("df_term")))
    content = F.log2(F.lit(float(n_docs)) / F.col("df_value"))
    # A term found with the value alone carries all of it, whatever the rounding.
    share = F.when(F.col("n") == F.col("df_term"), 1.0).when(content > 0, pmi / content)
    told = together.select("value", "term", share.alias("share")).where(
        F.col("share") >= generalise_at)
    return staged(told, "pii-told"), pairs


def disclosing_terms(docs: DataFrame, *, text: str = "text", support: int = SUPPORT,
                     generalise_at: float = GENERALISE_AT) -> DataFrame:
    """The (value, term, share) that the texts of ``docs`` give evidence of."""
    rows = docs.select(text_or_empty(text).alias("text"))
    based = staged(_based(rows.withColumn("base", base_spans(F.col("text")))), "pii-based")
    return _told(rows, based, support, generalise_at)[0]


def _own_terms(pairs: DataFrame, told: DataFrame, remove_at: float) -> DataFrame:
    """Per key of a text, a map ``told`` of the disclosing terms that stand in it: whether they
    are to be removed."""
    size = F.octet_length("value") + F.octet_length("term") + 64
    return (
        pairs.join(small_bytes(told, size), ["value", "term"])
        .groupBy("key", "term").agg(F.max("share").alias("share"))
        .groupBy("key").agg(F.map_from_entries(F.collect_list(
            F.struct("term", F.col("share") >= remove_at))).alias("told"))
    )


def find(docs: DataFrame, *, text: str = "text", support: int = SUPPORT,
         generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """One row per document: ``doc`` (the whole row), ``text``, ``base`` (spans by kind) and
    ``terms``, the spans (s, e, v, remove) of disclosing terms outside the base spans."""
    rows = docs.select(whole_row(docs),
                       text_or_empty(text).alias("text"))
    based = rows.withColumn("base", base_spans(F.col("text")))
    stored = staged(_based(based), "pii-based")
    told, pairs = _told(rows, stored, support, generalise_at)
    per_text = staged(_own_terms(pairs, told, remove_at), "pii-texts")
    size = F.aggregate(F.map_keys("told"), F.lit(64), lambda n, t: n + F.octet_length(t) + 16)
    every_base = F.concat(*[F.col("base")[k] for k in KINDS])
    spans = _let(every_base, lambda base: F.filter(
        F.transform(
            F.filter(matches(F.col("text"), TERM),
                     lambda m: F.map_contains_key(F.col("told"), F.lower(m["v"]))),
            lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("v"),
                               F.element_at(F.col("told"), F.lower(m["v"])).alias("remove"))),
        lambda m: ~F.exists(base, lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))))
    none = F.array().cast("array<struct<s: int, e: int, v: string, remove: boolean>>")
    return (
        based.withColumn("key", F.md5("text"))
        .join(small_bytes(per_text, size), "key", "left")
        .select("doc", "text", "base",
                F.when(F.col("told").isNull(), none).otherwise(spans).alias("terms"))
    )


def span_list(named: list[tuple[str, Column]]) -> Column:
    """``kind:start:end`` of all spans, by kind as given, comma-joined."""
    def of(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda m: F.concat_ws(
            ":", F.lit(kind), m["s"].cast("string"), m["e"].cast("string")))

    return F.array_join(F.concat(*[of(*pair) for pair in named]), ",")


def sanitised(found: DataFrame) -> Column:
    """The text of a row of :func:`find` with values replaced by their kind, disclosing terms
    generalised or removed.  Of spans that overlap, all are covered by the first one's mark."""
    def mark(kind: str) -> Column:
        return F.transform(F.col("base")[kind], lambda m: F.struct(
            m["s"].alias("s"), m["e"].alias("e"), F.lit(f"[{kind.upper()}]").alias("by")))

    marks = [mark(k) for k in KINDS]
    marks.append(F.transform("terms", lambda m: F.struct(
        m["s"].alias("s"), m["e"].alias("e"),
        F.when(m["remove"], "").otherwise("[TERM]").alias("by"))))
    text = F.col("text")

    def step(state: Column, m: Column) -> Column:
        # What stands between, then the mark unless the span begins inside an earlier one.
        inside = m["s"] < state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(m["s"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], m["e"]).alias("at"),
            F.when(inside, state["out"]).otherwise(
                F.concat(state["out"], F.array(gap, m["by"]))).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return _let(F.array_sort(F.concat(*marks)), lambda spans: F.when(
        F.size(spans) == 0, text).otherwise(F.aggregate(
            spans, empty, step, lambda end: F.concat(
                F.array_join(end["out"], ""),
                F.substring(text, end["at"] + 1, F.lit(2147483647))))))


def sanitise(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` with sanitised texts; a null text stays null."""
    found = find(docs, text=text, **options)
    kept = F.when(F.col("doc")[text].isNull(), F.lit(None).cast("string")).otherwise(
        sanitised(found))
    return found.select(F.col("doc").withField(quoted(text), kept).alias("doc")).select("doc.*")
