"""Records with offsets: the archive's reader, closing windows, late lines, repeated delivery."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from netrollup.plans.specs import BY_KEY
from netrollup.sources.kafka import RAW_COLUMNS, read_kafka_range
from netrollup.sources.segments import (
    SegmentStreamReader,
    read_range,
    stream_segments,
    with_offsets,
    write_segments,
)
from netrollup.streaming.stateful import read_late, stateful_stream

SPEC = BY_KEY["r06_vpe_basic"]
RECORD = "topic string, partition int, offset long, value string, arrival timestamp"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def line(second, cpu=0.5, device="d", **more):
    return {"resourceLogo": "vpe", "resourceUuid": device, "fabric": "f", "host": "h",
            "collectdate": int(START.timestamp()) + second, "cpu": cpu, "memUsage": 1.0, **more}


def records(spark, rows):
    """Records from (partition, offset, message or list of messages, arrival second)."""
    return spark.createDataFrame(
        [("vpe", p, o, m if isinstance(m, str) else json.dumps(m), START + timedelta(seconds=a))
         for p, o, m, a in rows], RECORD)


def numbered(spark, n, partition=0, first=0):
    return records(spark, [(partition, first + i, line(first + i), first + i) for i in range(n)])


def reader(path, **options):
    return SegmentStreamReader({"path": path, **options})


def offsets_of(made, parts):
    out = {}
    for part in parts:
        for batch in made.read(part):
            out.setdefault(part.number, []).extend(batch.column("offset").to_pylist())
    return out


def test_reader_takes_a_capped_range_of_each_partition(spark, tmp):
    path, position = f"{tmp}/raw", f"{tmp}/own/position"
    write_segments(numbered(spark, 25).unionByName(numbered(spark, 7, partition=3)), path, 10)
    made = reader(path, perPartition="10", position=position)
    # Spark asks a new query's reader for the latest offset first.
    end = made.latestOffset()
    assert end == {"vpe/0": 10, "vpe/3": 7}
    start = made.initialOffset()
    assert start == {"vpe/0": 0, "vpe/3": 0}
    got = offsets_of(made, made.partitions(start, end))
    assert got == {0: list(range(10)), 3: list(range(7))}
    # The one that is behind does not get what the other one leaves.
    assert made.latestOffset() == {"vpe/0": 20, "vpe/3": 7}
    # A new reader goes on after what was planned last.
    again = reader(path, perPartition="10", position=position)
    assert again.latestOffset() == {"vpe/0": 20, "vpe/3": 7}
    assert offsets_of(again, again.partitions(end, again.latestOffset())) == {0: list(range(10, 20))}
    write_segments(numbered(spark, 12, partition=5), path, 10)
    assert again.latestOffset() == {"vpe/0": 25, "vpe/3": 7, "vpe/5": 10}


def test_reader_from_the_end_and_by_topic(spark, tmp):
    write_segments(numbered(spark, 5), f"{tmp}/raw", 3)
    write_segments(numbered(spark, 4).withColumn("topic", F.lit("cpe")), f"{tmp}/raw", 3)
    late = reader(f"{tmp}/raw", starting="latest", topics="vpe")
    assert late.initialOffset() == late.latestOffset() == {"vpe/0": 5}
    capped = reader(f"{tmp}/raw", starting="latest", perPartition="2", position=f"{tmp}/p")
    assert capped.latestOffset() == capped.initialOffset() == {"vpe/0": 5, "cpe/0": 4}
    write_segments(numbered(spark, 9, first=5), f"{tmp}/raw", 3)
    assert late.latestOffset() == {"vpe/0": 14}
    assert capped.latestOffset() == {"vpe/0": 7, "cpe/0": 4}


def test_reader_of_nothing_and_wrong_options(tmp):
    made = reader(f"{tmp}/none")
    assert made.latestOffset() == made.initialOffset() == {} and made.partitions({}, {}) == []
    with pytest.raises(ValueError):
        reader(tmp, starting="middle")
    with pytest.raises(ValueError):
        reader(tmp, perPartition="5")


def test_range_and_reader_agree(spark, tmp):
    rows = numbered(spark, 30).unionByName(numbered(spark, 30, partition=1))
    write_segments(rows, tmp, 7)
    start, end = {"vpe/0": 5}, {"vpe/0": 22, "vpe/1": 3}
    made = reader(tmp)
    want = offsets_of(made, made.partitions(start, end))
    got = read_range(spark, tmp, start, end).collect()
    assert {p: sorted(r.offset for r in got if r.partition == p) for p in (0, 1)} == want
    assert read_range(spark, tmp, end, end).count() == 0
    assert all(json.loads(r.value) == line(r.offset) for r in got)


def test_offsets_follow_arrival(spark, raw_of):
    raw = raw_of([("vpe", line(i)) for i in range(6)]).withColumn(
        "arrival", F.timestamp_seconds(-F.get_json_object("value", "$.collectdate").cast("long")))
    rows = with_offsets(raw, F.lit(0)).orderBy("offset").collect()
    assert [json.loads(r.value)["collectdate"] - line(0)["collectdate"] for r in rows] == [
        5, 4, 3, 2, 1, 0]
    assert [r.offset for r in rows] == list(range(6))


def test_kafka_ranges_are_given_by_partition(monkeypatch, spark):
    seen = {}
    monkeypatch.setattr("netrollup.sources.kafka.read_kafka_batch",
                        lambda spark, options: seen.update(options))
    read_kafka_range(spark, {"kafka.bootstrap.servers": "x", "subscribe": "vpe",
                             "maxOffsetsPerTrigger": "5"},
                     {"vpe": {"0": 7}}, {"vpe": {"0": 9, "1": 4}})
    assert json.loads(seen["startingOffsets"]) == {"vpe": {"0": 7, "1": -2}}
    assert json.loads(seen["endingOffsets"]) == {"vpe": {"0": 9, "1": 4}}
    assert json.loads(seen["assign"]) == {"vpe": [0, 1]}
    assert "subscribe" not in seen and "maxOffsetsPerTrigger" not in seen
    assert {"topic", "partition", "offset"} <= set(RAW_COLUMNS)


# --- closing windows ---------------------------------------------------------------------------

class Kept:
    """A sink that remembers the rows of every call."""

    def __init__(self):
        self.rows = []

    def __call__(self, rows, spec):
        self.rows += rows.collect()


def run(spark, tmp, sink, cap=4, **options):
    raw = stream_segments(spark, f"{tmp}/raw", rate_per_partition=cap, trigger_s=1,
                          position=f"{tmp}/position")
    stateful_stream(raw, [SPEC], sink, f"{tmp}/progress",
                    lambda a, b: read_range(spark, f"{tmp}/raw", a, b), f"{tmp}/late",
                    window_s=300, delay_s=300, trigger_s=0, **options).drain()


def test_closed_windows_and_late_lines_hold_every_line(spark, tmp):
    # Five windows of four lines; then three lines of the first ones; at last one far ahead.
    rows = [(0, i, line(75 * i, cpu=i / 100), 75 * i) for i in range(20)]
    rows += [(0, 20 + i, line(100 * i), 1600 + i) for i in range(3)]
    rows += [(0, 23, line(1700), 1700), (0, 24, line(3000), 3000)]
    write_segments(records(spark, rows[:12]), f"{tmp}/raw", 5)
    sink = Kept()
    run(spark, tmp, sink)
    first = len(sink.rows)
    assert first
    write_segments(records(spark, rows[12:]), f"{tmp}/raw", 5)
    run(spark, tmp, sink)
    late = read_late(spark, f"{tmp}/late").collect()
    assert sorted(r.offset for r in late) == [20, 21, 22]
    assert {r.value for r in late} == {json.dumps(m) for _, o, m, _ in rows if o in (20, 21, 22)}
    # Each window once, with all of its lines that were in time.
    ms = int(START.timestamp()) * 1000
    got = {r.dealTime - ms: r.cpu for r in sink.rows}
    assert len(sink.rows) == len(got) == 6
    assert got[0] == 1.5 and got[300_000] == 5.5 and got[1_200_000] == 17.5
    # Nothing new: nothing happens.
    run(spark, tmp, sink)
    assert len(sink.rows) == 6 and read_late(spark, f"{tmp}/late").count() == 3
    seen = spark.read.parquet(f"{tmp}/late/batches").agg(F.sum("n_late")).first()[0]
    assert seen == 3


def test_a_wrong_clock_closes_no_windows(spark, tmp):
    rows = [(0, 0, line(10), 10), (0, 1, line(10**6), 20), (0, 2, line(30), 30),
            (0, 3, line(40), 40), (0, 4, line(50, cpu=0.9), 50), (0, 5, line(2000), 2000)]
    write_segments(records(spark, rows), f"{tmp}/raw", 5)
    sink = Kept()
    run(spark, tmp, sink, cap=1)
    assert [r.cpu for r in sink.rows] == [pytest.approx(58.0)]    # all five lines of the window
    assert read_late(spark, f"{tmp}/late").count() == 0


def test_records_delivered_twice_count_once(spark, tmp):
    two = [line(20, cpu=0.2), line(20, cpu=0.2)]
    rows = [(0, 0, line(10, cpu=0.8), 10), (0, 1, two, 20), (0, 0, line(10, cpu=0.8), 10),
            (1, 0, line(10, cpu=0.8), 10), (0, 1, two, 20), (0, 2, line(5000), 5000)]
    write_segments(records(spark, rows), f"{tmp}/raw", 1)
    sink = Kept()
    run(spark, tmp, sink, cap=2, once=True)
    # Two records of 0.8 and one line with two messages of 0.2.
    assert [r.cpu for r in sink.rows] == [50.0]


def test_late_lines_of_a_batch_are_kept_once(spark, tmp):
    """A driver that died between the lines and the note of them repeats the batch."""
    rows = [(0, i, line(600 * i), 600 * i) for i in range(5)] + [(0, 5, line(0), 3000)]
    write_segments(records(spark, rows), f"{tmp}/raw", 2)
    sink = Kept()
    run(spark, tmp, sink, cap=1)
    assert read_late(spark, f"{tmp}/late").count() == 1
    from netrollup.streaming.stateful import LateLines

    def late(lines, closed):
        return lines.withColumn("event_ts", F.col("arrival")).where(F.col("offset") == 5).select(
            "topic", "arrival", "partition", "offset", "value", "event_ts")

    again = LateLines(spark, f"{tmp}/progress", f"{tmp}/late",
                      lambda a, b: read_range(spark, f"{tmp}/raw", a, b), late)
    last = again.done
    again.done = -1
    again.catch_up(last)
    assert read_late(spark, f"{tmp}/late").count() == 1
