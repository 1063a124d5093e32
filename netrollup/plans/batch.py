"""Batch replay: raw lines -> metric tables.

Same parse, route and roll-up functions as the streams.  A window is the
``window_s`` slice of event time (default) or of arrival time that a row falls in.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.operators.parse import parse
from netrollup.operators.rollup import (
    malformed_of,
    rollup,
    rollup_many,
    table_of,
    with_arrival_window,
    with_event_window,
)
from netrollup.operators.route import candidate_lines, route
from netrollup.shared import read_stage, remove, write_stage


def fields_of(specs) -> list[str]:
    return list(dict.fromkeys(f for s in specs for f in s.fields))


def windowed(rows: DataFrame, window_s: int = 300, on: str = "event") -> DataFrame:
    if on == "event":
        return with_event_window(rows, window_s)
    if on == "arrival":
        return with_arrival_window(rows, window_s)
    raise ValueError(f"on must be 'event' or 'arrival', not {on!r}")


def replay(raw: DataFrame, spec, window_s: int = 300, on: str = "event",
           compat_float32: bool = False) -> DataFrame:
    """One roll-up over ``raw``; only its own lines and fields are parsed."""
    parsed = parse(candidate_lines(raw, spec), spec.fields)
    rows = windowed(route(parsed, spec), window_s, on)
    return rollup(rows, spec, compat_float32)


def aggregate_pass(raw: DataFrame, specs, window_s: int = 300, on: str = "event") -> DataFrame:
    """Aggregates of all ``specs`` from one scan, one parse and one shuffle."""
    topics = list(dict.fromkeys(s.topic for s in specs))
    parsed = parse(raw.where(F.col("topic").isin(topics)), fields_of(specs))
    return rollup_many(windowed(parsed, window_s, on), specs, keep_malformed=True)


@dataclass
class Replayed:
    """Result of a replay: tables by name, malformed lines, and how to let go of the
    intermediate files once both are written."""

    tables: dict[str, DataFrame]
    malformed: DataFrame
    release: Callable[[], None]


def replay_all(raw: DataFrame, specs, window_s: int = 300, on: str = "event",
               compat_float32: bool = False) -> Replayed:
    """Every roll-up of ``specs``, by table name, reading each raw line once.

    One aggregation pass per topic, so a topic's rows carry only its own columns
    through the shuffle.  On an archive kept by topic a pass reads its topic's folder;
    on any other source it reads everything, once for each topic.  The aggregates, far
    smaller than the input, are written to the shared folder once; each table then reads
    only its own partition.  Malformed lines come out of the same pass.
    """
    tables, bad, paths = {}, [], []
    spark = raw.sparkSession
    for topic in dict.fromkeys(s.topic for s in specs):
        of_topic = [s for s in specs if s.topic == topic]
        grouped = aggregate_pass(raw, of_topic, window_s, on)
        paths.append(write_stage(grouped, ["rollup"], rebalance=True))
        staged = read_stage(spark, paths[-1], grouped)
        for spec in of_topic:
            tables[spec.table] = table_of(staged, spec, compat_float32)
        bad.append(malformed_of(staged))

    def release() -> None:
        for path in paths:
            remove(spark, path)

    return Replayed(tables, reduce(DataFrame.unionByName, bad), release)


def replay_tables(raw: DataFrame, specs, window_s: int = 300, on: str = "event",
                  compat_float32: bool = False) -> dict[str, DataFrame]:
    """The tables of :func:`replay_all` alone; their intermediate files stay."""
    return replay_all(raw, specs, window_s, on, compat_float32).tables


def route_counts(parsed: DataFrame) -> DataFrame:
    """Lines per topic and type tag; malformed lines are counted apart."""
    return parsed.groupBy("topic", "resourceLogo").agg(
        F.count_if(F.col("malformed").isNull()).alias("n_rows"),
        F.count("malformed").alias("n_malformed"),
    )
