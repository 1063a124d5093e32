"""Group parsed rows and compute a roll-up's output columns.

Rows carry ``dealTime`` (ms), the window they belong to.  All aggregates are sums,
counts, ``max`` and ``min``, so Spark combines them before the shuffle and a hot key
costs one partial row per task, however many samples it has.  Means come from sums of
integers, so a value at the edge of rounding falls on the same side on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.functions import (
    bucket_ms,
    delta,
    doc_key,
    exact_mean,
    mean_of_parts,
    span,
    sum_parts,
)
from netrollup.operators.route import rollups_fed
from netrollup.plans.specs import row_value
from netrollup.schema import EVENT_TIME

PERIOD_TAG = "5"

# Stands in the place of a roll-up's key for malformed lines.
MALFORMED = "malformed"

# Epoch seconds outside this range are no usable event time (year 1 to 9999).
_MIN_EPOCH, _MAX_EPOCH = -62135596800, 253402300799


def event_seconds() -> Column:
    """Event time in epoch seconds; arrival where a message has no usable one."""
    seconds = F.col(EVENT_TIME)
    return F.coalesce(
        F.when(seconds.between(_MIN_EPOCH, _MAX_EPOCH), seconds),
        F.unix_seconds("arrival").cast("double"),
    )


def with_event_window(rows: DataFrame, window_s: int = 300) -> DataFrame:
    """Assign each row to the ``window_s`` window of its event time."""
    return rows.withColumn("dealTime", bucket_ms(event_seconds(), window_s))


def with_arrival_window(rows: DataFrame, window_s: int = 300) -> DataFrame:
    """Assign each row to the ``window_s`` window in which it arrived."""
    return rows.withColumn("dealTime", bucket_ms(F.unix_seconds("arrival"), window_s))


def aggregates(specs) -> list[Column]:
    """Means of all gauge inputs of ``specs``, growth of all their counter inputs,
    and the group's sample span and mean time."""
    gauges = dict.fromkeys(n for s in specs for n in s.inputs(gauges=True))
    counters = dict.fromkeys(n for s in specs for n in s.inputs(gauges=False))
    seconds = F.col(EVENT_TIME)
    columns = [exact_mean(row_value(n)).alias(f"mean_{n}") for n in gauges]
    columns += [delta(row_value(n)).alias(f"growth_{n}") for n in counters]
    if counters:
        columns.append(span(seconds).alias("span_s"))
    return columns + [exact_mean(seconds).alias("mean_s")]


def finish(grouped: DataFrame, spec, compat_float32: bool = False) -> DataFrame:
    """Output columns of ``spec`` from its aggregates, in table order."""
    out = {name: F.col(name) for name in spec.keys}
    for m in spec.all_measures:
        aggregate = F.col(f"mean_{m.field}" if m.is_gauge else f"growth_{m.field}")
        out[m.name] = m.value(aggregate, F.col("span_s"))
    out["timestamp"] = bucket_ms(F.col("mean_s"), 300, compat_float32)
    out["dealTime"] = F.col("dealTime")
    out["_id"] = doc_key(*[F.col(p) for p in spec.id_parts], F.col("dealTime"))
    out["timeType"] = F.lit(PERIOD_TAG)
    return grouped.select(*[out[c].alias(c) for c in spec.columns])


def rollup(rows: DataFrame, spec, compat_float32: bool = False) -> DataFrame:
    """Roll up routed ``rows`` per ``dealTime`` window and group key."""
    grouped = rows.groupBy("dealTime", *spec.keys).agg(*aggregates([spec]))
    return finish(grouped, spec, compat_float32)


def _tagged(parsed: DataFrame, specs,
            keep_malformed: bool = False) -> tuple[DataFrame, list[Column]]:
    """Each row once for every roll-up it feeds, and the grouping keys: those of all
    roll-ups, blanked out for the others."""
    fed = rollups_fed(specs)
    if keep_malformed:
        fed = F.when(F.col("malformed").isNotNull(), F.array(F.lit(MALFORMED))).otherwise(fed)
    tagged = parsed.withColumn("rollup", F.explode(fed))
    keys = []
    for name in key_names(specs):
        users = [s.key for s in specs if name in s.keys]
        value = F.col(name)
        if len(users) < len(specs):
            value = F.when(F.col("rollup").isin(users), value)
        keys.append(value.alias(name))
    return tagged, keys


def key_names(specs) -> list[str]:
    return list(dict.fromkeys(k for s in specs for k in s.keys))


def rollup_many(parsed: DataFrame, specs, keep_malformed: bool = False) -> DataFrame:
    """Aggregates of several roll-ups in one pass and one shuffle.

    Each parsed row is tagged with the roll-ups it feeds and grouped on all their
    keys, those of other roll-ups blanked out.  Read one table off the result with
    ``table_of``; keep the result (persist or write it) if you read several.

    ``keep_malformed`` carries malformed lines along as groups of their own, which
    ``malformed_of`` turns into lines again.
    """
    tagged, keys = _tagged(parsed, specs, keep_malformed)
    aggs = aggregates(specs)
    if keep_malformed:
        bad = F.col("malformed").isNotNull()
        line = F.when(bad, F.struct("topic", "arrival", F.col("malformed").alias("value")))
        keys.append(line.alias("line"))
        aggs.append(F.count_if(bad).alias("n_lines"))
    return tagged.groupBy("rollup", "dealTime", *keys).agg(*aggs)


def grouped_by(parsed: DataFrame, specs, window: Column) -> DataFrame:
    """Aggregates of several roll-ups by another window than ``dealTime``."""
    tagged, keys = _tagged(parsed, specs)
    return tagged.groupBy("rollup", window, *keys).agg(*aggregates(specs))


def malformed_of(grouped: DataFrame) -> DataFrame:
    """The malformed lines in the result of ``rollup_many``, each as often as it came."""
    return grouped.where(F.col("rollup") == MALFORMED).select(
        "line", F.explode(F.sequence(F.lit(1), F.col("n_lines")))).select("line.*")


def _inputs(specs) -> tuple[list[str], list[str]]:
    gauges = dict.fromkeys(n for s in specs for n in s.inputs(gauges=True))
    counters = dict.fromkeys(n for s in specs for n in s.inputs(gauges=False))
    return list(gauges), list(counters)


def partials_many(parsed: DataFrame, specs) -> DataFrame:
    """What :func:`rollup_many` aggregates, in a form that can be added up: sums and
    counts of gauges, extremes of counters.  Partials of several batches together
    (``combine``) give what one batch with all their lines would."""
    gauges, counters = _inputs(specs)
    tagged, keys = _tagged(parsed, specs)
    columns = []
    for name, value in [*((n, row_value(n)) for n in gauges), ("s", F.col(EVENT_TIME))]:
        columns += [c.alias(f"{part}_{name}") for part, c in sum_parts(value).items()]
    for name, value in [*((n, row_value(n)) for n in counters), ("s", F.col(EVENT_TIME))]:
        columns += [F.max(value).alias(f"max_{name}"), F.min(value).alias(f"min_{name}")]
    return tagged.groupBy("rollup", "dealTime", *keys).agg(*columns)


def combine(partials: DataFrame, specs) -> DataFrame:
    """The result of :func:`rollup_many` from partials of any number of batches."""
    gauges, counters = _inputs(specs)
    columns = []
    for name in [*gauges, "s"]:
        added = {part: F.try_sum(f"{part}_{name}") for part in ("whole", "part", "rest", "n")}
        columns.append(mean_of_parts(**added).alias(f"mean_{name}"))
    for name in counters:
        columns.append(F.try_subtract(F.max(f"max_{name}"), F.min(f"min_{name}"))
                       .alias(f"growth_{name}"))
    if counters:
        columns.append((F.max("max_s") - F.min("min_s")).alias("span_s"))
    return partials.groupBy("rollup", "dealTime", *key_names(specs)).agg(*columns)


def table_of(grouped: DataFrame, spec, compat_float32: bool = False) -> DataFrame:
    """The table of ``spec`` from the result of ``rollup_many`` or ``combine``."""
    return finish(grouped.where(F.col("rollup") == spec.key), spec, compat_float32)
