"""Column helpers on hand-made values."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netrollup.functions import (
    bit_rate,
    bucket_ms,
    delta,
    doc_key,
    epoch_seconds_ntz,
    exact_mean,
    mean_of_parts,
    ratio,
    round2,
    slice_ms,
    span,
    sum_parts,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def double(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize("seconds,start", [
    (1591760099.0, 1591759800000),
    (1591760100.0, 1591760100000),
    (1591760100.9, 1591760100000),
    (0.0, 0),
    (-1.0, -300000),
])
def test_bucket_edges(spark, seconds, start):
    assert one(spark, bucket_ms(double(seconds))) == start


def test_bucket_through_float32_lands_in_the_next_bucket(spark):
    x = double(1591760070.0)
    assert one(spark, bucket_ms(x)) == 1591759800000
    assert one(spark, bucket_ms(x, compat_float32=True)) == 1591760100000


@pytest.mark.parametrize("seconds", [float("nan"), float("inf"), 1e300, None])
def test_bucket_of_no_time_is_null(spark, seconds):
    assert one(spark, bucket_ms(double(seconds))) is None


def test_bucket_float32_step_matches_numpy(spark):
    import numpy as np

    seconds = list(range(1591760000, 1591761000, 7))
    df = spark.createDataFrame([(float(s),) for s in seconds], "c double")
    got = [r[0] for r in df.select(bucket_ms(F.col("c"), 300, True)).collect()]
    want = [int(np.float32(s)) // 300 * 300000 for s in seconds]
    assert got == want


@pytest.mark.parametrize("x,want", [
    (2.845, 2.85), (2.8449999999999998, 2.85), (-2.845, -2.85), (0.005, 0.01), (None, None),
    (1e35, 1e35), (float("inf"), float("inf")),
])
def test_round2(spark, x, want):
    assert one(spark, round2(double(x))) == want


def test_round2_keeps_nan(spark):
    got = one(spark, round2(double(float("nan"))))
    assert got != got


def test_ratio_of_zero_total_is_null(spark):
    assert one(spark, ratio(double(1.0), double(0.0))) is None
    assert one(spark, ratio(double(1.0), double(4.0))) == 0.25


def test_key_spells_missing_parts(spark):
    text, none = F.lit("a"), F.lit(None).cast("string")
    assert one(spark, doc_key(text, F.lit(300000))) == "a_300000"
    assert one(spark, doc_key(none, text, F.lit(300000))) == "null_a_300000"
    assert one(spark, doc_key(none, none, none)) == "null_null_null"


def test_rates_and_growth(spark):
    df = spark.createDataFrame([(100, 0.0), (900, 10.0), (20, 20.0)], "n bigint, t double")
    row = df.agg(delta(F.col("n")).alias("d"), span(F.col("t")).alias("s")).first()
    assert (row.d, row.s) == (880, 20.0)  # the reset is not corrected
    assert one(spark, bit_rate(F.lit(880), double(20.0))) == 352.0
    assert one(spark, bit_rate(F.lit(0), double(0.0))) is None


def test_growth_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "n bigint")
    assert df.agg(delta(F.col("n"))).first()[0] is None


def test_slices(spark):
    assert one(spark, slice_ms(F.lit(7500000).cast("bigint"), 3600)) == 7200000
    assert one(spark, slice_ms(F.lit(None).cast("bigint"), 3600)) is None


@settings(max_examples=20, deadline=None)
@given(when=st.datetimes(dt.datetime(1970, 1, 1), dt.datetime(2200, 1, 1)))
def test_epoch_seconds_ignore_the_session_zone(spark, when):
    want = int((when.replace(microsecond=0) - dt.datetime(1970, 1, 1)).total_seconds())
    ts = F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, epoch_seconds_ntz(ts)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_means_do_not_depend_on_the_order_of_rows(spark):
    """Two devices at an edge of rounding; doubles added in other orders fall on either side."""
    values = [0.1, 0.2, 0.3, 0.4, 0.005, 1e10, -1e10, 33.335, 1 / 3, -7.77] * 30
    rows = [(d, v) for d in ("a", "b") for v in values]
    means = set()
    for parts in (1, 3, 7):
        for order in (rows, rows[::-1], sorted(rows, key=str)):
            df = spark.createDataFrame(order, "d string, v double").repartition(parts)
            got = df.groupBy("d").agg(exact_mean(F.col("v")).alias("m")).collect()
            means |= {r.m for r in got}
    assert len(means) == 1
    assert means.pop() == pytest.approx(math.fsum(values) / len(values), abs=1e-11)


def test_means_of_odd_values(spark):
    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(exact_mean(F.col("v")).alias("m")).first().m

    assert mean(None, None) is None and mean() is None
    assert mean(1.0, None, 2.0) == 1.5 and mean(-0.25, -0.5) == -0.375
    assert mean(1e300, 1e300) == 1e300 and mean(float("inf"), 1.0) == float("inf")
    assert math.isnan(mean(float("nan"), 1.0))
    assert mean(2.0 ** 40, 1.0) == (2.0 ** 40 + 1) / 2


def test_parts_of_batches_add_up(spark):
    df = spark.createDataFrame([(i % 4, 0.1 * i) for i in range(100)], "batch int, v double")
    whole = df.agg(exact_mean(F.col("v")).alias("m")).first().m
    parts = df.groupBy("batch").agg(*[c.alias(n) for n, c in sum_parts(F.col("v")).items()])
    assert parts.agg(mean_of_parts(**{n: F.sum(n) for n in ("whole", "part", "rest", "n")})
                     .alias("m")).first().m == whole
