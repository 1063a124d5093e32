"""Operator checks on the sample telemetry: one query per operator or plan."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.functions import (
    bucket_ms,
    doc_key,
    epoch_seconds_ntz,
    exact_mean,
    ratio,
    round2,
)
from netrollup.operators.parse import parse, quarantine
from netrollup.operators.route import route
from netrollup.plans.batch import replay, replay_all, replay_tables, route_counts
from netrollup.plans.specs import BY_KEY, PROGRAMS, ROLLUPS
from netrollup.shared import new_path, stage
from netrollup.sinks.documents import read_documents, write_documents
from netrollup.sinks.merge import merge, read_table
from netrollup.sources.files import stream_archive, write_archive
from netrollup.sources.routed import replay_routed, write_routed
from netrollup.sources.sample import raw_from_events, read_events, sample_raw
from netrollup.sources.segments import read_range, stream_segments, with_offsets, write_segments
from netrollup.streaming.arrival import arrival_stream
from netrollup.streaming.common import table_sink
from netrollup.streaming.event_time import event_stream
from netrollup.streaming.stateful import (
    closed_windows,
    read_late,
    stateful_stream,
    stream_documents,
)

DAY = 86400
CUT_EVERY = 97
FLOW = BY_KEY["r09_vpe_interface"]

# Overlapping halves of the sample month, for the merge check.
EARLY_UNTIL = 1705622400000
LATE_FROM = 1704758400000

# Processing time of the arrival-window check, epoch seconds.
ARRIVAL_CLOCK = 1706745725


def op_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(parse(sample_raw(spark, sf_dir), ["resourceLogo"]))


def op_cpe_flag_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = BY_KEY["r05_cpe_pop"]
    rows = route(parse(sample_raw(spark, sf_dir), spec.fields), spec)
    return rows.groupBy("peer").agg(F.count(F.lit(1)).alias("n_rows"))


def op_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse(sample_raw(spark, sf_dir, CUT_EVERY), ["resourceLogo"])
    text = F.col("value")
    return quarantine(parsed).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(text.startswith("{") & ~text.endswith("}")).alias("n_cut"),
    )


def op_after_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll-up whose input holds malformed lines is that of the sound ones."""
    return replay(sample_raw(spark, sf_dir, CUT_EVERY), BY_KEY["r11_vpe_delay"], DAY)


def op_lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters written as text or with a fraction count like plain ones."""
    raw = sample_raw(spark, sf_dir)
    quoted = F.regexp_replace("value", r'"(rxBytes|txPkts)":(\d+)', r'"$1":"$2"')
    fraction = F.regexp_replace("value", r'"(txBytes|rxPkts)":(\d+)', r'"$1":$2.0')
    style = F.pmod(F.xxhash64("value"), F.lit(3))
    mixed = F.when(style == 0, quoted).when(style == 1, fraction).otherwise(F.col("value"))
    return replay(raw.withColumn("value", mixed), FLOW, DAY)


def op_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold an array of messages, here each message twice."""
    twice = F.concat(F.lit("["), "value", F.lit(", "), "value", F.lit("]"))
    raw = sample_raw(spark, sf_dir).withColumn("value", twice)
    return route_counts(parse(raw, ["resourceLogo"]))


def _bucket_counts(spark: SparkSession, sf_dir: str, compat_float32: bool) -> DataFrame:
    seconds = epoch_seconds_ntz(F.col("ts")).cast("double")
    bucket = bucket_ms(seconds, 300, compat_float32)
    return read_events(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_events")
    )


def op_bucket5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_counts(spark, sf_dir, compat_float32=False)


def op_bucket5_float32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_counts(spark, sf_dir, compat_float32=True)


def op_doc_key_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = F.nullif(F.col("user_id") % 7, F.lit(0))
    port = F.when(F.col("user_id") % 2 == 0, "eth0")
    day = bucket_ms(epoch_seconds_ntz(F.col("ts")), DAY)
    return read_events(spark, sf_dir).groupBy(doc_key(device, port, day).alias("_id")).agg(
        F.count(F.lit(1)).alias("n_events")
    )


def op_ratio_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disk use averaged over readings, some of which report a total of zero."""
    total = F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(5000000.0)
    used = ratio(total - F.col("value") * 10000, total)
    return read_events(spark, sf_dir).groupBy((F.col("user_id") % 7).alias("device")).agg(
        round2(F.avg(used) * 100).alias("diskUsedRate"),
        F.count(used).alias("n_used"),
        F.count(F.lit(1)).alias("n_all"),
    )


def op_routed_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device's days from an archive laid out by route; some of its lines are arrays."""
    path, raw = new_path(spark, "routed"), sample_raw(spark, sf_dir)
    odd = F.pmod(F.xxhash64("value"), F.lit(5)) == 0
    write_routed(raw.withColumn("value", F.when(odd, F.concat(F.lit("["), "value", F.lit("]")))
                                .otherwise(F.col("value"))), path, row_group_mb=1)
    return replay_routed(spark, path, FLOW, DAY, LATE_FROM // 1000, EARLY_UNTIL // 1000, "dev-3")


def op_routed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up that takes flagged lines only, from the same layout."""
    path, spec = new_path(spark, "routed"), BY_KEY["r05_cpe_pop"]
    write_routed(sample_raw(spark, sf_dir), path, row_group_mb=1)
    return replay_routed(spark, path, spec, DAY)


def op_exact_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great values that cancel out, added in an order that changes with every run."""
    far = (F.col("event_id") % 3 - 1) * F.lit(5e10) + F.floor(F.col("value") * 1024) / 1024
    shuffled = read_events(spark, sf_dir).repartition(7, F.rand())
    return shuffled.groupBy((F.col("user_id") % 7).alias("device")).agg(
        F.round(exact_mean(far).cast("decimal(28,9)"), 4).cast("double").alias("mean"),
        round2(exact_mean(F.col("value"))).alias("mean2"))


def r09_at_300s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(sample_raw(spark, sf_dir), FLOW, window_s=300)


def r09_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(sample_raw(spark, sf_dir), FLOW, window_s=DAY, on="arrival")


def r06_float32(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = BY_KEY["r06_vpe_basic"]
    return replay(sample_raw(spark, sf_dir), spec, window_s=DAY, compat_float32=True)


def _long(name: str, table: DataFrame) -> DataFrame:
    """Every column of every row of a table as a row of its own."""
    cells = []
    for column, kind in table.dtypes:
        if column not in ("_id", "dealTime"):
            text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
            if kind == "string":
                text = F.col(column)
            else:
                number = F.col(column).cast("double")
            cells.append(F.struct(F.lit(column).alias("column_name"), text.alias("text"),
                                  number.alias("number")))
    return table.select(F.lit(name).alias("table_name"), "_id", "dealTime",
                        F.explode(F.array(*cells)).alias("cell")).select(
        "table_name", "_id", "dealTime", "cell.*")


def _all_long(tables: dict[str, DataFrame]) -> DataFrame:
    """All columns of all tables."""
    return reduce(DataFrame.unionByName, [_long(name, df) for name, df in tables.items()])


def all_tables_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 13 tables from one pass per topic."""
    return _all_long(replay_tables(sample_raw(spark, sf_dir), ROLLUPS, window_s=DAY))


def op_replay_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and malformed lines of one replay."""
    specs = [BY_KEY["r11_vpe_delay"], FLOW]
    done = replay_all(sample_raw(spark, sf_dir, CUT_EVERY), specs, window_s=DAY)
    bad = done.malformed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return _all_long(done.tables).unionByName(bad.select(
        F.lit("malformed").alias("table_name"), F.col("topic").alias("_id"),
        F.lit(None).cast("long").alias("dealTime"), F.lit("n_lines").alias("column_name"),
        F.lit(None).cast("string").alias("text"), F.col("n").cast("double").alias("number")))


def op_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early days without rates, then late days in full, then the early ones again."""
    path = new_path(spark, "upsert")
    full = stage(replay(sample_raw(spark, sf_dir), FLOW, window_s=DAY), [])
    early = full.where(F.col("dealTime") <= EARLY_UNTIL).drop("rxBytes", "txBytes")
    late = full.where(F.col("dealTime") >= LATE_FROM)
    for rows in (early, late, early):
        merge(rows, path, list(FLOW.keys), slice_s=DAY)
    return read_table(spark, path).select(FLOW.columns)


def op_upsert_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up rows that share a key: the sink keeps one of them."""
    path = new_path(spark, "collide")
    spec = BY_KEY["r05_cpe_pop"]
    merge(replay(sample_raw(spark, sf_dir), spec, window_s=DAY), path, list(spec.keys),
          slice_s=DAY)
    return read_table(spark, path).select(spec.columns)


def _stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample telemetry as a stream over the events file."""
    schema = read_events(spark, sf_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return raw_from_events(reader.parquet(sf_dir))


def _one_arrival_window(spark: SparkSession, sf_dir: str, specs) -> dict[str, DataFrame]:
    """All lines arrive in one window, whose processing time is set by hand."""
    path = new_path(spark, "arrival")
    arrival_stream(
        _stream_raw(spark, sf_dir), specs, table_sink(f"{path}/tables"), f"{path}/progress",
        quarantine_path=f"{path}/bad", clock=f"timestamp_seconds({ARRIVAL_CLOCK})",
        available_now=True,
    ).awaitTermination()
    return {s.table: read_table(spark, f"{path}/tables/{s.table}").select(s.columns)
            for s in specs}


def stream_arrival_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = BY_KEY["r10_vpe_peer_flow"]
    return _one_arrival_window(spark, sf_dir, [spec])[spec.table]


def _program(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        specs = ROLLUPS if name == "all" else PROGRAMS[name]
        return _all_long(_one_arrival_window(spark, sf_dir, specs))

    return run


def _archive(events: DataFrame, path: str, part_of: Column, parts: int) -> None:
    """Raw lines in an archive with one file for each part, in this order."""
    for part in range(parts):
        write_archive(raw_from_events(events.where(part_of == part))
                      .where(F.col("topic") == FLOW.topic).coalesce(1), path)
        time.sleep(0.01)


def stream_arrival_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream is stopped and started again within one window."""
    spec = BY_KEY["r10_vpe_peer_flow"]
    path, events = new_path(spark, "restart"), read_events(spark, sf_dir)
    for half in range(2):
        _archive(events.where(F.col("event_id") % 2 == half), f"{path}/raw", F.lit(0), 1)
        arrival_stream(
            stream_archive(spark, f"{path}/raw"), [spec], table_sink(f"{path}/tables"),
            f"{path}/progress", clock=f"timestamp_seconds({ARRIVAL_CLOCK})", available_now=True,
        ).awaitTermination()
    return read_table(spark, f"{path}/tables/{spec.table}").select(spec.columns)


def stream_arrival_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches, each with lines of every window."""
    path = new_path(spark, "windows")
    _archive(read_events(spark, sf_dir), f"{path}/raw", F.col("event_id") % 3, 3)
    arrival_stream(
        stream_archive(spark, f"{path}/raw", files_per_trigger=1), [FLOW],
        table_sink(f"{path}/tables", slice_s=DAY), f"{path}/progress", window_s=DAY,
        clock="arrival", available_now=True,
    ).awaitTermination()
    return read_table(spark, f"{path}/tables/{FLOW.table}").select(FLOW.columns)


def stream_event_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a bounded run, the last one included."""
    path = new_path(spark, "event")
    event_stream(
        _stream_raw(spark, sf_dir), [FLOW], table_sink(f"{path}/tables", slice_s=DAY),
        f"{path}/progress", window_s=DAY, available_now=True,
    ).awaitTermination()
    return read_table(spark, f"{path}/tables/{FLOW.table}").select(FLOW.columns)


def stream_event_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches from the newest lines to the oldest; the newest of all is 20 hours ahead."""
    path, events = new_path(spark, "late"), read_events(spark, sf_dir)
    # Two numbers.
    newest, last = events.agg(F.max(F.when(F.col("event_id") % 11 == 7, F.col("event_id"))),
                              F.max("event_id")).first()
    ahead = events.withColumn("ts", F.when(
        F.col("event_id") == newest, F.col("ts") + F.expr("interval 20 hours")
    ).otherwise(F.col("ts")))
    part = F.lit(2) - F.least(F.lit(2), F.floor(F.col("event_id") * 3 / (last + 1)))
    _archive(ahead, f"{path}/raw", part, 3)
    event_stream(
        stream_archive(spark, f"{path}/raw", files_per_trigger=1), [FLOW],
        table_sink(f"{path}/tables", slice_s=DAY), f"{path}/progress", window_s=DAY,
        available_now=True,
    ).awaitTermination()
    return read_table(spark, f"{path}/tables/{FLOW.table}").select(FLOW.columns)


#: Every tenth message of the state check takes ten days to arrive.
SLOW = "if(e % 10 = 3, 864000, 0)"
CLOSE_DELAY = DAY // 2


def _segments(spark: SparkSession, sf_dir: str, delay_s: str = "0") -> DataFrame:
    """The flow topic's lines in two partitions, with offsets by arrival."""
    raw = raw_from_events(read_events(spark, sf_dir), delay_s=delay_s)
    flow = raw.where((F.col("topic") == FLOW.topic) & F.col("value").contains(f'"{FLOW.tag}"'))
    nth = F.get_json_object("value", "$.rxBytes").cast("bigint")
    return stage(with_offsets(flow, F.col("value").contains('"eth1"'), nth), [])


def _closing_stream(spark: SparkSession, path: str, cap: int, once: bool = False) -> None:
    """Work off the archive at ``path``, ``cap`` records of each partition in a batch."""
    raw = stream_segments(spark, f"{path}/raw", rate_per_partition=cap, trigger_s=1,
                          position=f"{path}/position")
    stateful_stream(
        raw, [FLOW], table_sink(f"{path}/tables", slice_s=DAY), f"{path}/progress",
        lambda start, end: read_range(spark, f"{path}/raw", start, end), f"{path}/late",
        window_s=DAY, delay_s=CLOSE_DELAY, once=once, trigger_s=0,
    ).drain()


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows written as they close, and the late lines of each; the stream is stopped half-way
    and started again."""
    path, records = new_path(spark, "closing"), _segments(spark, sf_dir, SLOW)
    n = records.count()
    cap = n // 12
    for half in (F.col("offset") < 3 * cap, F.col("offset") >= 3 * cap):
        write_segments(records.where(half), f"{path}/raw", segment_rows=max(n // 20, 1))
        _closing_stream(spark, path, cap)
    late = read_late(spark, f"{path}/late").groupBy(
        "partition", bucket_ms(F.unix_seconds("event_ts"), DAY).alias("window")).agg(
        F.count(F.lit(1)).alias("n"))
    return _all_long({FLOW.table: read_table(spark, f"{path}/tables/{FLOW.table}")
                      .select(FLOW.columns)}).unionByName(late.select(
        F.lit("late").alias("table_name"), F.col("partition").cast("string").alias("_id"),
        F.col("window").alias("dealTime"), F.lit("n_lines").alias("column_name"),
        F.lit(None).cast("string").alias("text"), F.col("n").cast("double").alias("number")))


def stream_delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is delivered a second time, under the same offset."""
    path, records = new_path(spark, "twice"), _segments(spark, sf_dir)
    n = records.count()
    for _ in range(2):
        write_segments(records, f"{path}/raw", segment_rows=max(n // 6, 1))
    _closing_stream(spark, path, max(n // 6, 1), once=True)
    return read_table(spark, f"{path}/tables/{FLOW.table}").select(FLOW.columns)


def op_document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``op_upsert_merge``, into the document store."""
    path = new_path(spark, "documents")
    full = stage(replay(sample_raw(spark, sf_dir), FLOW, window_s=DAY), [])
    early = full.where(F.col("dealTime") <= EARLY_UNTIL).drop("rxBytes", "txBytes")
    late = full.where(F.col("dealTime") >= LATE_FROM)
    for rows in (early, late, early):
        write_documents(rows, path, FLOW.table, list(FLOW.keys))
    return read_documents(spark, path, FLOW.table, full.schema)


def stream_document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay's documents of one device without rates, then closed windows of all devices."""
    path, records = new_path(spark, "store"), _segments(spark, sf_dir)
    write_segments(records, f"{path}/raw", segment_rows=max(records.count() // 6, 1))
    full = replay(sample_raw(spark, sf_dir), FLOW, window_s=DAY)
    write_documents(full.where("resourceUuid = 'dev-0'").drop("rxBytes", "txBytes"), path,
                    FLOW.table, list(FLOW.keys))
    raw = stream_segments(spark, f"{path}/raw")
    query = stream_documents(closed_windows(raw, [FLOW], DAY, CLOSE_DELAY), FLOW, path,
                             f"{path}/progress", "flow", trigger_s=0)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return read_documents(spark, path, FLOW.table, full.schema)


def op_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a capped reader takes in its second batch, read again by offsets."""
    path, records = new_path(spark, "range"), _segments(spark, sf_dir)
    write_segments(records, path, segment_rows=16)
    start, end = ({f"{FLOW.topic}/{p}": at for p in (0, 1)} for at in (10, 40))
    return read_range(spark, path, start, end).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(F.get_json_object("value", "$.rxBytes").cast("bigint")).alias("rx_bytes"))


QUERIES = {
    f.__name__: f
    for f in (
        op_route_counts, op_cpe_flag_route, op_quarantine, op_after_quarantine,
        op_lenient_numbers, op_array_lines, op_replay_quarantine, op_bucket5,
        op_bucket5_float32, op_doc_key_null, op_ratio_zero, op_exact_means, op_routed_archive, op_routed_flag, r09_at_300s, r09_by_arrival,
        r06_float32, all_tables_one_pass, op_upsert_merge, op_upsert_collisions,
        stream_arrival_rollup, stream_arrival_restart, stream_arrival_windows,
        stream_event_rollup, stream_event_late, stream_closed_windows, stream_delivered_twice,
        op_offset_range, op_document_upsert, stream_document_store,
    )
} | {
    "stream_program": _program("vpe"),
    "stream_program_cpe": _program("cpe"),
    "stream_program_ce": _program("ce"),
    "stream_program_all": _program("all"),
}
