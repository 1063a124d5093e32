"""Gauge and counter arithmetic.

Nothing here raises under ANSI mode: one absurd reading must give null in its
own cell, not end the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(x: Column) -> Column:
    """HALF_UP to two places.

    Rounding goes through decimal(38,8), which absorbs the last-bit noise of binary
    fractions: 0.145 counts as that.  Values a decimal cannot hold
    (NaN, infinities, 1e30 and up) take the plain double rounding.
    """
    exact = F.round(x.try_cast("decimal(38,8)"), 2).cast("double")
    return F.coalesce(exact, F.round(x, 2))


def whole(x: Column) -> Column:
    """Floor; what binary fractions leave below a whole number counts as that, as in ``round2``."""
    exact = F.floor(x.try_cast("decimal(38,8)")).try_cast("bigint")
    return F.coalesce(exact, F.floor(x))


#: Below this, a value is added up as a whole number and a fraction in parts of 2^-36.
_EXACT = 2.0 ** 36


def sum_parts(x: Column) -> dict[str, Column]:
    """Aggregates that give the sum of ``x`` whatever the order of the rows: sums of the whole
    numbers and of the fractions, both integers, a plain sum of what is too great for that, and
    the count.  Those of several batches add up, column by column."""
    small = F.abs(x) < _EXACT
    whole = F.floor(x)
    part = F.rint((x - whole) * _EXACT).cast("bigint")
    return {
        "whole": F.try_sum(F.when(small, whole)), "part": F.try_sum(F.when(small, part)),
        "rest": F.sum(F.when(~small, x)), "n": F.count(x),
    }


def mean_of_parts(whole: Column, part: Column, rest: Column, n: Column) -> Column:
    """The mean from the results of :func:`sum_parts`; null where nothing was counted."""
    def or_zero(value: Column) -> Column:
        return F.coalesce(value.cast("double"), F.lit(0.0))

    total = or_zero(whole) + or_zero(part) / _EXACT + or_zero(rest)
    return F.try_divide(total, n.cast("double"))


def exact_mean(x: Column) -> Column:
    """``avg`` that does not depend on the order in which rows are added."""
    return mean_of_parts(**sum_parts(x))


def percent(x: Column) -> Column:
    return x * 100


def to_mega(x: Column) -> Column:
    return x / 1024 / 1024


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null where ``whole`` is zero."""
    return F.try_divide(part, whole)


def delta(counter: Column) -> Column:
    """Growth of a monotone counter; a reset is not corrected."""
    return F.try_subtract(F.max(counter), F.min(counter))


def span(seconds: Column) -> Column:
    """Seconds between the first and the last sample."""
    return F.max(seconds) - F.min(seconds)


def bit_rate(growth: Column, seconds: Column) -> Column:
    """Bits per second; null for a single sample (zero span)."""
    return round2(F.try_divide(growth.cast("double"), seconds) * 8)
