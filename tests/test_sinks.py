"""Keyed merge and the other sinks."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netrollup.sinks import merge as merging
from netrollup.sinks.merge import merge, read_table, resolve_collisions
from netrollup.sinks.other import env_options, preview, write_external

HOUR = 3600000
SCHEMA = "_id string, dealTime bigint, timestamp bigint, host string, n bigint"


def table(spark, path, **options):
    return sorted(
        (tuple(r) for r in read_table(spark, path, **options).select(
            "_id", "dealTime", "timestamp", "host", "n").collect()),
        key=str)


def rows(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_insert_update_keep(spark, tmp):
    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1), ("b", HOUR, 0, "h", 2)), path)
    merge(rows(spark, ("a", 0, 5, "h", 9), ("c", 0, 0, None, 3)), path)
    assert table(spark, path) == [
        ("a", 0, 5, "h", 9), ("b", HOUR, 0, "h", 2), ("c", 0, 0, None, 3)]


def test_replay_changes_nothing(spark, tmp):
    path = f"{tmp}/t"
    batch = rows(spark, ("a", 0, 0, "h", 1), ("b", HOUR, 0, "h", 2), ("b", HOUR, 1, "h", 3))
    assert merge(batch, path) == 1
    before = table(spark, path)
    assert merge(batch, path) == 1
    assert table(spark, path) == before and len(before) == 2


def test_columns_not_sent_are_kept_and_new_ones_added(spark, tmp):
    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1), ("b", 0, 0, "h", 2)), path)
    merge(rows(spark, ("a", 0, 7, 1.5), ("c", 0, 7, 2.5),
               schema="_id string, dealTime bigint, n bigint, rate double"), path)
    got = {r._id: (r.host, r.n, r.rate) for r in read_table(spark, path).collect()}
    assert got == {"a": ("h", 7, 1.5), "b": ("h", 2, None), "c": (None, 7, 2.5)}


def test_incoming_null_replaces_the_stored_value(spark, tmp):
    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1)), path)
    merge(rows(spark, ("a", 0, 0, None, None)), path)
    assert table(spark, path) == [("a", 0, 0, None, None)]


def test_only_touched_slices_are_rewritten(spark, tmp):
    from pathlib import Path

    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1), ("b", HOUR, 0, "h", 2)), path)

    def files(start):
        return {f.name for f in Path(path, f"dealSlice={start}").glob("*.parquet")}

    first, second = files(0), files(HOUR)
    assert first and second
    merge(rows(spark, ("c", HOUR + 300000, 0, "h", 3)), path)
    assert files(0) == first and files(HOUR).isdisjoint(second)


def test_missing_time_and_empty_input(spark, tmp):
    path = f"{tmp}/t"
    merge(rows(spark, ("a", None, 0, "h", 1)), path)
    merge(rows(spark, ("a", None, 0, "h", 2), ("b", 0, 0, "h", 3)), path)
    merge(rows(spark), path)
    assert table(spark, path) == [("a", None, 0, "h", 2), ("b", 0, 0, "h", 3)]


@pytest.mark.parametrize("block", [2, 200])
def test_slices_are_merged_in_blocks(spark, tmp, monkeypatch, block):
    monkeypatch.setattr(merging, "_BLOCK", block)
    path = f"{tmp}/t"
    old = rows(spark, *[(f"k{i}", i * HOUR, 0, "h", 0) for i in range(6)], (None, None, 0, "h", 0))
    merge(old, path)
    merge(rows(spark, *[(f"k{i}", i * HOUR, 0, "h", 1) for i in range(2, 8)]), path)
    got = {r[0]: r[4] for r in table(spark, path)}
    assert got == {None: 0, "k0": 0, "k1": 0} | {f"k{i}": 1 for i in range(2, 8)}


@pytest.mark.parametrize("n", [10, 3000])
def test_stored_rows_are_read_by_named_folders(spark, tmp, monkeypatch, n):
    asked = []

    def look(spark, path, slices):
        asked.append(slices)

    path = f"{tmp}/t"
    monkeypatch.setattr(merging, "stored_slices", look)
    monkeypatch.setattr(merging, "_replace", lambda *_: None)
    monkeypatch.setattr(merging, "_write_block", lambda spark, path, slices, rows: look(
        spark, path, slices))
    merge(spark.range(n).selectExpr("cast(id as string) as _id", f"id * {HOUR} as dealTime",
                                    "id as n"), path)
    assert sum(map(len, asked)) == n and max(map(len, asked)) <= 200
    assert sorted(s for block in asked for s in block) == [i * HOUR for i in range(n)]


def test_a_merge_cut_off_while_it_replaces_loses_nothing(spark, tmp, monkeypatch):
    """The driver dies with the stored slice gone and its new content pending."""
    from pathlib import Path

    from netrollup.shared import remove

    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1), ("b", HOUR, 0, "h", 2)), path)
    replace, calls = merging._replace, []

    def dies(spark, where):
        calls.append(where)
        if len(calls) == 2:
            remove(spark, f"{where}/dealSlice=0")
            raise RuntimeError("lost the driver")
        replace(spark, where)

    monkeypatch.setattr(merging, "_replace", dies)
    with pytest.raises(RuntimeError):
        merge(rows(spark, ("c", 0, 0, "h", 3)), path)
    monkeypatch.setattr(merging, "_replace", replace)
    merge(rows(spark, ("d", 2 * HOUR, 0, "h", 4)), path)
    assert [(r[0], r[4]) for r in table(spark, path)] == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert not Path(path, "_pending").exists()


def test_incomplete_content_is_dropped(spark, tmp):
    from pathlib import Path

    path = f"{tmp}/t"
    merge(rows(spark, ("a", 0, 0, "h", 1)), path)
    Path(path, "_pending", "dealSlice=0").mkdir(parents=True)
    merge(rows(spark, ("b", 0, 0, "h", 2)), path)
    assert [r[0] for r in table(spark, path)] == ["a", "b"]


def test_rows_that_do_not_collide_are_not_ranked(spark):
    df = rows(spark, ("a", 0, 1, "x", 1), ("b", 0, 2, "b", 2))
    plan = merging.colliding(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert merging.one_row_each(df, None, ["n"]) is df


def test_collisions_take_the_latest_then_the_keys(spark):
    df = rows(spark, ("a", 0, 1, "x", 1), ("a", 0, 2, "b", 2), ("a", 0, 2, "c", 3),
              ("a", 0, 2, None, 4), ("b", 0, None, "x", 5))
    got = {r._id: (r.n, r.n_rows)
           for r in resolve_collisions(df, ["timestamp", "host", "n"]).collect()}
    assert got == {"a": (3, 4), "b": (5, 1)}


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select(
        F.lit("hot").alias("_id"), F.col("id").alias("timestamp"))
    out = resolve_collisions(df, ["timestamp"])
    assert out.first().timestamp == 999
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()


def test_time_range_reads_its_slices_only(spark, tmp):
    path = f"{tmp}/t"
    merge(rows(spark, *[(f"k{i}", i * HOUR // 2, 0, "h", i) for i in range(100)]), path)
    part = read_table(spark, path, SCHEMA, since=HOUR, until=2 * HOUR)
    assert sorted(r.n for r in part.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(dealSlice" in \
        part._jdf.queryExecution().executedPlan().toString()


def test_slice_width_is_checked(spark, tmp):
    with pytest.raises(ValueError):
        merge(rows(spark), f"{tmp}/t", slice_s=100000)


def test_external_connector_gets_table_and_options(spark, tmp):
    write_external(rows(spark, ("a", 0, 0, "h", 1)), f"{tmp}/ext", "parquet", "path",
                   {"compression": "gzip"})
    assert spark.read.parquet(f"{tmp}/ext").count() == 1


def test_options_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("SINK_uri", "there")
    monkeypatch.setenv("OTHER", "x")
    assert env_options("SINK") == {"uri": "there"}


def test_preview_prints_rows(spark, capsys):
    preview(rows(spark, ("a-long-key-that-is-not-cut-off", 0, 0, "h", 1)))
    assert "a-long-key-that-is-not-cut-off" in capsys.readouterr().out


BATCHES = st.lists(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 2),
                       st.one_of(st.none(), st.integers(0, 9))), max_size=6),
    min_size=1, max_size=3)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=BATCHES)
def test_merges_against_a_dictionary(spark, tmp_path_factory, batches):
    path, want = str(tmp_path_factory.mktemp("t") / "t"), {}
    for batch in batches:
        data = [(f"{k}_{slot}", slot * HOUR // 2, stamp, None, n) for k, slot, stamp, n in batch]
        # Among equal keys: the latest stamp, then the greatest value, nulls lowest.
        best = {}
        for row in sorted(data, key=lambda r: (r[2], r[4] is not None, r[4] or 0)):
            best[row[0]] = row
        assert merge(rows(spark, *data), path) == len(data) - len(best)
        want |= best
    if want:
        assert table(spark, path) == sorted(want.values(), key=str)
