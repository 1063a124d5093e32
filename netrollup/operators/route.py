"""Routing: which parsed rows belong to which roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.operators.parse import may_carry_tag


def belongs(spec) -> Column:
    """True for the parsed rows that feed ``spec``; other rows give false or null."""
    tests = [F.col("topic") == spec.topic, F.col("malformed").isNull()]
    if spec.tag is not None:
        tests.append(F.col("resourceLogo") == spec.tag)
    if spec.cpe_only:
        tests.append(F.col("isCpe") == "y")
    return reduce(lambda a, b: a & b, tests)


def route(parsed: DataFrame, spec) -> DataFrame:
    return parsed.where(belongs(spec))


def rollups_fed(specs) -> Column:
    """Keys of the ``specs`` a parsed row feeds, as an array; null for none.

    Built as a choice among constant arrays, one per topic and tag, so a row costs
    a few comparisons and no array is made for it.
    """
    choice = None
    for topic, tag in dict.fromkeys((s.topic, s.tag) for s in specs):
        same = [s for s in specs if (s.topic, s.tag) == (topic, tag)]
        if tag is None and any(s.topic == topic and s.tag is not None for s in specs):
            raise ValueError(f"topic {topic!r} has both tagged and untagged roll-ups")
        match = (F.col("topic") == topic) & F.col("malformed").isNull()
        if tag is not None:
            match = match & (F.col("resourceLogo") == tag)
        always = [s.key for s in same if not s.cpe_only]
        cases = [(match, always)] if always else []
        if len(always) < len(same):
            cases.insert(0, (match & (F.col("isCpe") == "y"), [s.key for s in same]))
        for test, keys in cases:
            value = F.array(*[F.lit(k) for k in keys])
            choice = F.when(test, value) if choice is None else choice.when(test, value)
    return choice


def candidate_lines(raw: DataFrame, spec) -> DataFrame:
    """The lines that can feed ``spec``: its topic's, and of those only the ones
    that may carry its tag."""
    lines = raw.where(F.col("topic") == spec.topic)
    return lines if spec.tag is None else lines.where(may_carry_tag([spec.tag]))
