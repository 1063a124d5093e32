"""The archive by route: what a roll-up's scan reads, and that nothing is missing."""

import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from netrollup.plans.batch import replay
from netrollup.plans.specs import BY_KEY, ROLLUPS
from netrollup.sources.routed import OTHER, UNKNOWN, read_routed, replay_routed, write_routed
from netrollup.sources.sample import raw_from_events

FLOW = BY_KEY["r09_vpe_interface"]
DAY = 86400


@pytest.fixture(scope="module")
def sample(spark):
    events = spark.range(6000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1704067200 + F.col("id") * 300)
        .cast("timestamp_ntz").alias("ts"), (F.col("id") % 97).alias("user_id"),
        (F.col("id") % 500 / 2).alias("value"))
    return raw_from_events(events).cache()


@pytest.fixture(scope="module")
def archive(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("routed"))
    odd = F.col("value").contains('"d')  # all lines of some, as arrays or with a quoted number
    nth = F.pmod(F.xxhash64("value"), F.lit(6))
    value = F.when(odd & (nth == 0), F.concat(F.lit("["), "value", F.lit("]"))).when(
        odd & (nth == 1), F.regexp_replace("value", r'"collectdate":(\d+)', '"collectdate":"$1"')
    ).otherwise(F.col("value"))
    write_routed(sample.withColumn("value", value), path, row_group_mb=1)
    return path


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("spec", ROLLUPS, ids=lambda s: s.key)
def test_every_roll_up_gives_what_the_plain_lines_give(spark, sample, archive, spec):
    assert rows(replay_routed(spark, archive, spec, DAY)) == rows(replay(sample, spec, DAY))


def test_ranges_and_devices(spark, sample, archive):
    since, until = 1704067200 + 5 * DAY, 1704067200 + 9 * DAY
    got = replay_routed(spark, archive, FLOW, DAY, since, until, "dev-2")
    want = replay(sample, FLOW, DAY).where(
        (F.col("dealTime") >= since * 1000) & (F.col("dealTime") < until * 1000)
        & (F.col("resourceUuid") == "dev-2"))
    assert rows(got) == rows(want) and want.count() > 0
    with pytest.raises(ValueError):
        replay_routed(spark, archive, FLOW, DAY, since + 1)
    with pytest.raises(ValueError):
        replay_routed(spark, archive, BY_KEY["r05_cpe_pop"], DAY, device="p")


def scans(spark, df):
    """The scans of a plan: their partition filters and what they push into the files."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], Read", plan)


def test_the_scan_is_pruned_by_folder_and_range(spark, archive):
    raw = read_routed(spark, archive, BY_KEY["r05_cpe_pop"], 1704067200, 1704067200 + DAY)
    own, other = scans(spark, raw)
    assert "(tag#" in own[0] and "vpePort" in own[0] and "topic" in own[0]
    assert "EqualTo(is_cpe,true)" in own[1] and "GreaterThanOrEqual(event_s" in own[1] \
        and "LessThan(event_s" in own[1]
    assert OTHER in other[0]
    files = {r[0] for r in read_routed(spark, archive, FLOW).select(
        F.input_file_name()).distinct().collect()}
    assert files and all("topic=vpe/tag=vpePort" in f or f"topic=vpe/tag={OTHER}" in f for f in files)


def test_files_are_sorted(archive):
    order = duckdb.sql(f"""
        select is_cpe, event_s from read_parquet('{archive}/topic=vpe/tag=vpePort/*.parquet',
               hive_partitioning = false)""").fetchall()
    assert order == sorted(order) and len(order) > 100


def test_many_devices_get_bloom_filters(spark, tmp):
    """Where a dictionary of the devices would be too large; a smaller one serves as well."""
    raw = spark.range(60_000).select(
        F.lit("vpe").alias("topic"), F.to_json(F.struct(
            F.lit("vpe").alias("resourceLogo"), F.sha2(F.col("id").cast("string"), 256)
            .alias("resourceUuid"), F.col("id").alias("collectdate"))).alias("value"),
        F.lit(None).cast("timestamp").alias("arrival"))
    write_routed(raw.coalesce(1), tmp, row_group_mb=64)
    rows_ = duckdb.sql(f"""
        select bloom_filter_offset from parquet_metadata('{tmp}/topic=vpe/tag=vpe/*.parquet')
        where path_in_schema = 'device'""").fetchall()
    assert rows_ and all(r[0] is not None for r in rows_)
    device = raw.select(F.get_json_object("value", "$.resourceUuid").alias("d")).where(
        F.get_json_object("value", "$.collectdate") == "777").first().d
    found = read_routed(spark, tmp, BY_KEY["r06_vpe_basic"], device=device).collect()
    assert [json.loads(r.value)["collectdate"] for r in found] == [777]


def test_lines_of_any_kind_have_a_place(spark, tmp):
    lines = [json.dumps({"resourceLogo": "vpe", "resourceUuid": "d"}), "not json", "", None,
             '[{"resourceLogo": "vpe"}]', '{"resourceLogo": "new"}', '{"cpu": 1}',
             '{"resourceLogo": "vpe", "collectdate": "soon"}']
    raw = spark.createDataFrame([("vpe", v, None) for v in lines],
                                "topic string, value string, arrival timestamp")
    write_routed(raw, tmp)
    kept = spark.read.parquet(tmp).collect()
    by_tag = {}
    for r in kept:
        by_tag.setdefault(r.tag, []).append(r.value)
    assert set(by_tag[OTHER]) == {lines[1], lines[4], lines[7]}
    assert by_tag["vpe"] == [lines[0]] and by_tag[UNKNOWN] == [lines[5]]
    assert set(by_tag[None]) == {"", None, lines[6]}
