"""Parsing, quarantine and routing."""

import pytest
from pyspark.sql import functions as F

from netrollup.operators.parse import parse, quarantine
from netrollup.operators.route import candidate_lines, route
from netrollup.plans.batch import route_counts
from netrollup.plans.specs import BY_KEY, ROLLUPS
from netrollup.schema import ALL_FIELDS

FIELDS = ["host", "cpu", "rxBytes"]


def parsed(raw_of, *lines):
    rows = parse(raw_of([("cpe", m) for m in lines]), FIELDS).collect()
    return [(r.host, r.cpu, r.rxBytes, r.malformed) for r in rows]


@pytest.mark.parametrize("line,want", [
    ('{"host":"a","cpu":0.5,"rxBytes":7}', [("a", 0.5, 7, None)]),
    ('{"rxBytes":9007199254740993}', [(None, None, 9007199254740993, None)]),
    ('{"rxBytes":"9007199254740993"}', [(None, None, 9007199254740993, None)]),
    ('{"cpu":"0.7","rxBytes":5.0}', [(None, 0.7, 5, None)]),
    ('{"cpu":1,"rxBytes":"5"}', [(None, 1.0, 5, None)]),
    ('{"host":5}', [("5", None, None, None)]),
    ('{"cpu":"n/a","host":"a"}', [("a", None, None, None)]),
    ('{"cpu":true,"host":"a"}', [("a", None, None, None)]),
    ('{"rxBytes":99999999999999999999,"host":"a"}', [("a", None, None, None)]),
    ('{"unknown":{"host":"b"}}', [(None, None, None, None)]),
    ('[{"host":"a","cpu":1},{"host":"b","cpu":"2"}]', [("a", 1.0, None, None),
                                                       ("b", 2.0, None, None)]),
    ("[]", []),
    ("", []),
    (" \t ", []),
    (None, []),
    ('{"host":"a"', [(None, None, None, '{"host":"a"')]),
    ("[1]", [(None, None, None, "[1]")]),
    ("plain text", [(None, None, None, "plain text")]),
])
def test_line_shapes(raw_of, line, want):
    assert sorted(parsed(raw_of, line), key=str) == sorted(want, key=str)


def test_one_bad_value_leaves_other_lines_alone(raw_of):
    got = parsed(raw_of, '{"cpu":0.5}', '{"cpu":"x"}', '{"cpu":0.25}')
    assert [g[1] for g in got] == [0.5, None, 0.25]


def test_quarantine_keeps_raw_text(raw_of):
    raw = raw_of([("cpe", '{"host":"a"}'), ("vpe", '{"host":'), ("vpe", "")])
    rows = quarantine(parse(raw)).collect()
    assert [(r.topic, r.value) for r in rows] == [("vpe", '{"host":')]


def test_all_fields_have_types(raw_of):
    df = parse(raw_of([]))
    assert df.columns == ["topic", "arrival", "malformed", *ALL_FIELDS]
    kinds = dict(df.dtypes)
    assert (kinds["cpu"], kinds["rxBytes"], kinds["collectdate"], kinds["host"]) == (
        "double", "bigint", "double", "string")


LINES = [
    ("cpe", '{"resourceLogo":"cpe"}'),
    ("cpe", '{"resourceLogo":"cpePort"}'),
    ("cpe", '{"resourceLogo": "cpe"}'),
    ("cpe", '{"inner":{"resourceLogo":"cpe"}}'),
    ("cpe", '{"resourceLogo":"\\u0063pe"}'),
    ("cpe", "{'resourceLogo':'cpe'}"),
    ("cpe", '{"resourceLogo":"cpe"'),
    ("vpe", '{"resourceLogo":"cpe"}'),
    ("vpe", '{"resourceLogo":"vpe"}'),
    ("vpe", '{"resourceLogo":"vpePort","isCpe":"y"}'),
    ("vpe", '{"resourceLogo":"vpePort","isCpe":"n"}'),
    ("vpe", '{"resourceLogo":"vpePort"}'),
    ("sdwan", '{"resourceLogo":"anything"}'),
    ("sdwan", "{}"),
    ("sdwan", "{"),
    ("switch", '{"resourceLogo":"switch"}'),
    ("switch", '[{"resourceLogo":"switchPort"},{"resourceLogo":"switch"}]'),
]


@pytest.mark.parametrize("key,n", [
    ("r01_cpe_basic", 4), ("r04_cpe_interface", 1), ("r02_cpe_chain", 0),
    ("r05_cpe_pop", 1), ("r06_vpe_basic", 1), ("r09_vpe_interface", 3),
    ("r11_vpe_delay", 2), ("r12_ce_basic", 2), ("r13_ce_port", 1),
])
def test_routes(raw_of, key, n):
    assert route(parse(raw_of(LINES)), BY_KEY[key]).count() == n


@pytest.mark.parametrize("spec", ROLLUPS, ids=lambda s: s.key)
def test_text_test_loses_no_line(raw_of, spec):
    raw = raw_of(LINES)
    assert route(parse(candidate_lines(raw, spec)), spec).count() == \
        route(parse(raw), spec).count()


def test_route_counts(raw_of):
    rows = route_counts(parse(raw_of(LINES), ["resourceLogo"])).where("topic = 'vpe'")
    assert {r.resourceLogo: (r.n_rows, r.n_malformed) for r in rows.collect()} == {
        "cpe": (1, 0), "vpe": (1, 0), "vpePort": (3, 0)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_line_is_parsed_once(spark, raw_of, tmp):
    from netrollup.plans.batch import aggregate_pass, replay

    raw_of(LINES).write.partitionBy("topic").parquet(f"{tmp}/raw")
    raw = spark.read.parquet(f"{tmp}/raw")
    # One typed read, and one lenient read inside the generator for what it rejects.
    for df in (replay(raw, BY_KEY["r11_vpe_delay"]), replay(raw, BY_KEY["r09_vpe_interface"]),
               aggregate_pass(raw, [s for s in ROLLUPS if s.topic == "vpe"])):
        text = plan_of(df)
        assert text.count("from_json(") == 2
        assert text.count("Exchange hashpartitioning") == 1
        assert "PythonUDF" not in text


def test_scan_reads_one_topic_and_pushes_the_tag(spark, raw_of, tmp):
    from netrollup.plans.batch import replay

    raw_of(LINES).write.partitionBy("topic").parquet(f"{tmp}/raw")
    text = plan_of(replay(spark.read.parquet(f"{tmp}/raw"), BY_KEY["r09_vpe_interface"]))
    assert "PartitionFilters: [isnotnull(topic" in text
    assert "StringContains" in text


def test_rows_with_no_event_time_count_at_their_arrival(spark):
    import datetime as dt

    from netrollup.operators.rollup import with_event_window

    at = dt.datetime(2024, 1, 1, 0, 7)
    df = spark.createDataFrame(
        [(None, at), (float("nan"), at), (1e15, at), (1704067200.0, at), (None, None)],
        "collectdate double, arrival timestamp",
    )
    got = [r.dealTime for r in with_event_window(df).select(F.col("dealTime")).collect()]
    assert got == [1704067500000] * 3 + [1704067200000, None]
