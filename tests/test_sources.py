"""Source wiring, the command line and the session settings."""

from pathlib import Path
from types import SimpleNamespace

import pytest

import netrollup.__main__ as command
import netrollup.streaming.common as streaming_common
from netrollup.__main__ import arguments, chosen, run_replay
from netrollup.plans import batch as batch_plans
from netrollup.plans.batch import replay
from netrollup.plans.specs import BY_KEY, PROGRAMS, ROLLUPS
from netrollup.session import REPLAY, STREAM, tune
from netrollup.shared import new_path, shared_dir, stage, write_stage
from netrollup.sinks.merge import read_table
from netrollup.sinks.other import write_external
from netrollup.sources.files import (
    read_archive,
    read_lines,
    stream_archive,
    stream_lines,
    write_archive,
)
from netrollup.sources.kafka import RAW_COLUMNS, batch_options, kafka_options, read_kafka

LINE = '{"resourceLogo":"vpe","resourceUuid":"u","collectdate":1591760100,"cpu":0.5}'


def test_kafka_options():
    assert kafka_options("h:9092", ["cpe", "vpe"]) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "cpe,vpe", "startingOffsets": "latest"}
    capped = kafka_options("h:9092", ["cpe"], rate_per_partition=80, partitions=4,
                           extra={"kafka.security.protocol": "SSL"})
    assert capped["maxOffsetsPerTrigger"] == "96000"
    assert capped["kafka.security.protocol"] == "SSL"
    with pytest.raises(ValueError):
        kafka_options("h:9092", ["cpe"], rate_per_partition=80)


def test_kafka_records_become_raw_records(spark):
    records = spark.sql("select 'cpe' topic, encode('é', 'UTF-8') value, "
                        "timestamp'2024-01-01 00:00:00' timestamp, 0 partition, 1L offset")
    raw = records.selectExpr(*RAW_COLUMNS)
    assert raw.dtypes == [("topic", "string"), ("value", "string"), ("arrival", "timestamp"),
                          ("partition", "int"), ("offset", "bigint")]
    assert raw.first().value == "é"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, kafka_options("h:9092", ["cpe"]))


def test_text_files_by_topic(spark, tmp_path):
    for topic, text in (("vpe", LINE + "\n\n" + LINE + "\n"), ("cpe", "{\n")):
        folder = tmp_path / "lines" / f"topic={topic}"
        folder.mkdir(parents=True)
        (folder / "a.txt").write_text(text)
    raw = read_lines(spark, str(tmp_path / "lines"))
    assert raw.columns == ["topic", "value", "arrival"] and raw.count() == 4
    assert raw.where("arrival is null").count() == 0
    row, = replay(raw, BY_KEY["r06_vpe_basic"]).collect()
    assert row.cpu == 50.0
    query = (stream_lines(spark, str(tmp_path / "lines"), 1).writeStream.format("memory")
             .queryName("lines").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("lines").count() == 4


def test_archive_round_trip_and_replay_command(spark, raw_of, tmp):
    write_archive(raw_of([("vpe", LINE), ("sdwan", "{"), ("cpe", "{}")]), f"{tmp}/raw")
    assert read_archive(spark, f"{tmp}/raw").count() == 3
    run_replay(spark, arguments(
        ["replay", "vpe", "--archive", f"{tmp}/raw", "--tables", f"{tmp}/tables"]))
    row, = read_table(spark, f"{tmp}/tables/network_vpe_basic").collect()
    assert (row.cpu, row["_id"]) == (50.0, "u_1591760100000")


@pytest.mark.parametrize("event_time", [False, True])
def test_stream_command(spark, raw_of, tmp, monkeypatch, event_time):
    write_archive(raw_of([("vpe", LINE), ("vpe", "{"), ("vpe", LINE.replace("60100", "99999"))]),
                  f"{tmp}/raw")
    asked = {}

    def archive_for_kafka(spark, options):
        asked.update(options)
        return stream_archive(spark, f"{tmp}/raw")

    def until_idle(spark):
        for query in spark.streams.active:
            query.processAllAvailable()
        raise SystemExit

    monkeypatch.setattr(command, "read_kafka", archive_for_kafka)
    monkeypatch.setattr(command, "await_any", until_idle)
    monkeypatch.setattr(command.signal, "signal", lambda *_: None)
    monkeypatch.setenv("NETROLLUP_KAFKA_failOnDataLoss", "false")
    args = ["stream", "vpe", "--servers", "h:1", "--checkpoint", f"{tmp}/progress",
            "--tables", f"{tmp}/tables", "--quarantine", f"{tmp}/bad", "--window", "1"]
    with pytest.raises(SystemExit):
        command.run_stream(spark, arguments(args + ["--event-time"] * event_time))
    assert not spark.streams.active
    assert asked["subscribe"] == "vpe,sdwan" and asked["failOnDataLoss"] == "false"
    assert spark.read.parquet(f"{tmp}/bad/vpe").count() == 1
    rows = read_table(spark, f"{tmp}/tables/network_vpe_basic").collect()
    assert [r.cpu for r in rows] == ([50.0] * 2 if event_time else [50.0])


@pytest.mark.parametrize("event_time,trigger", [(False, 300), (True, 60)])
def test_the_rate_cap_follows_the_trigger(spark, monkeypatch, event_time, trigger):
    asked = {}

    class Enough(Exception):
        pass

    def stop(spark, options):
        asked.update(options)
        raise Enough

    monkeypatch.setattr(command, "read_kafka", stop)
    args = ["stream", "ce", "--servers", "h:1", "--checkpoint", "c", "--tables", "t",
            "--rate", "80", "--partitions", "2"]
    with pytest.raises(Enough):
        command.run_stream(spark, arguments(args + ["--event-time"] * event_time))
    assert asked["maxOffsetsPerTrigger"] == str(80 * 2 * trigger)


def test_a_batch_keeps_the_offsets_it_is_given():
    given = kafka_options("h:1", ["vpe"], '{"vpe":{"0":5}}', 80, 2, extra={
        "endingOffsets": '{"vpe":{"0":9}}'})
    batch = batch_options(given)
    assert batch["startingOffsets"] == '{"vpe":{"0":5}}'
    assert batch["endingOffsets"] == '{"vpe":{"0":9}}' and "maxOffsetsPerTrigger" not in batch
    assert batch_options(kafka_options("h:1", ["vpe"]))["startingOffsets"] == "earliest"


def test_replay_keeps_and_counts_malformed_lines(spark, raw_of, tmp, caplog, monkeypatch):
    write_archive(raw_of([("vpe", LINE), ("vpe", "{"), ("vpe", "{"), ("sdwan", "]")]),
                  f"{tmp}/raw")
    made = []
    monkeypatch.setattr(batch_plans, "write_stage", lambda *a, **k: made.append(
        write_stage(*a, **k)) or made[-1])
    args = ["replay", "vpe", "--archive", f"{tmp}/raw", "--tables", f"{tmp}/tables"]
    run_replay(spark, arguments([*args, "--quarantine", f"{tmp}/bad"]))
    assert sorted((r.topic, r.value) for r in spark.read.parquet(f"{tmp}/bad").collect()) == [
        ("sdwan", "]"), ("vpe", "{"), ("vpe", "{")]
    run_replay(spark, arguments(args))
    assert caplog.text.count("3 malformed lines") == 2 and "not kept" in caplog.text
    # Nothing of the intermediate files is left.
    assert len(made) == 4 and not any(Path(p).exists() for p in made)


def test_another_sink_from_the_command_line(spark, raw_of, tmp, monkeypatch):
    write_archive(raw_of([("switch", '{"resourceLogo":"switch","switchUuid":"s",'
                                     '"collectdate":1591760100,"cpuUsage":7}')]), f"{tmp}/raw")
    monkeypatch.setenv("NETROLLUP_SINK_compression", "gzip")

    def by_folder(rows, table, fmt, table_option, options):
        """A folder for each table, as a connector keeps a collection for each."""
        assert table_option == "collection"
        write_external(rows, f"{tmp}/out/{table}", fmt, "path", options)

    monkeypatch.setattr(streaming_common, "write_external", by_folder)
    sink = ["--sink-format", "json", "--sink-table-option", "collection"]
    run_replay(spark, arguments(["replay", "ce", "--archive", f"{tmp}/raw", *sink]))
    row, = spark.read.json(f"{tmp}/out/network_ce_basic").collect()
    assert (row["_id"], row.cpu) == ("s_1591760100000", 7.0)
    assert list(Path(f"{tmp}/out/network_ce_basic").glob("*.json.gz"))

    def until_idle(spark):
        for query in spark.streams.active:
            query.processAllAvailable()
        raise SystemExit

    monkeypatch.setattr(command, "read_kafka",
                        lambda spark, options: stream_archive(spark, f"{tmp}/raw"))
    monkeypatch.setattr(command, "await_any", until_idle)
    monkeypatch.setattr(command.signal, "signal", lambda *_: None)
    with pytest.raises(SystemExit):
        command.run_stream(spark, arguments(
            ["stream", "ce", "--servers", "h:1", "--checkpoint", f"{tmp}/progress",
             "--event-time", *sink]))
    assert [r["_id"] for r in spark.read.json(f"{tmp}/out/network_ce_basic").collect()] == ["s_1591760100000"] * 2
    for bad in ([], ["--tables", "t", "--sink-format", "json"]):
        with pytest.raises(SystemExit):
            arguments(["replay", "ce", "--archive", "a", *bad])


def test_arguments():
    args = arguments(["stream", "all", "--servers", "h:1", "--checkpoint", "c", "--tables", "t",
                      "--rate", "80", "--partitions", "2", "--event-time"])
    assert (args.program, args.rate, args.event_time, args.window) == ("all", 80, True, 300)
    assert chosen("all") == {"all": ROLLUPS} and chosen("ce") == {"ce": PROGRAMS["ce"]}


def test_shared_folder_is_the_clusters_where_it_names_one(spark):
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/dir/"})
    assert shared_dir(named) == "hdfs://shared/dir"
    unnamed = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(unnamed)
    own = shared_dir(spark)
    assert own == shared_dir(spark) and new_path(spark, "x") != new_path(spark, "x")


def test_staged_table_has_no_lineage(spark):
    df = spark.range(10).selectExpr("id", "id % 2 as part").groupBy("part").count()
    staged = stage(df, ["part"])
    assert staged.dtypes == df.dtypes and staged.count() == 2
    assert "Aggregate" not in staged._jdf.queryExecution().executedPlan().toString()


def test_settings_yield_to_the_sessions_own(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    session = spark.newSession()
    tune(session, STREAM | {key: "false"})
    assert session.conf.get(key) == "false"
    assert session.conf.get("spark.sql.shuffle.partitions") == "4"  # the fixture's own
    assert REPLAY.keys() == STREAM.keys()
