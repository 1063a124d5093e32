"""Run a monitoring program, or replay archived lines.

    spark-submit --packages <Spark's Kafka connector> -m netrollup \\
        stream cpe --servers host:9092 --checkpoint <dir> --tables <dir>
    spark-submit -m netrollup replay vpe --archive <dir> --tables <dir>

Further reader options (say, security settings) come from the environment, as
``NETROLLUP_KAFKA_<option>``.  ``--sink-format`` hands the rows to a connector that upserts
on ``_id``, in place of the parquet tables; its options, such as the address and that fields
which are not sent are kept, come as ``NETROLLUP_SINK_<option>``.  ``--documents`` writes to the
document store of ``sinks.documents``.
"""

from __future__ import annotations

import argparse
import logging
import signal
import sys

from pyspark.sql import SparkSession

from netrollup.plans.batch import replay_all
from netrollup.plans.specs import PROGRAMS, ROLLUPS
from netrollup.session import REPLAY, STREAM, tune
from netrollup.sinks.other import env_options
from netrollup.sources.files import read_archive
from netrollup.sources.kafka import kafka_options, read_kafka, read_kafka_range
from netrollup.streaming.arrival import arrival_stream
from netrollup.streaming.common import (
    Sink,
    await_any,
    document_sink,
    external_sink,
    table_sink,
    write_tables,
)
from netrollup.streaming.control import preview_stream, stop_gracefully, watch
from netrollup.streaming.event_time import event_stream
from netrollup.streaming.stateful import StatefulStream, stateful_stream

_LOG = logging.getLogger("netrollup")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="netrollup")
    sub = parser.add_subparsers(dest="action", required=True)
    stream = sub.add_parser("stream", help="follow Kafka topics")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--starting", default="latest")
    stream.add_argument("--rate", type=int, help="records per second and partition")
    stream.add_argument("--partitions", type=int, help="topic partitions, for --rate")
    stream.add_argument("--event-time", action="store_true")
    stream.add_argument("--closed-after", type=int, metavar="SECONDS",
                        help="write event-time windows once, so long after their end; lines that"
                             " come later go below the checkpoint")
    stream.add_argument("--preview", action="store_true", help="print the first lines of batches")
    stream.add_argument("--trigger", type=int, default=60,
                        help="seconds between batches, with --event-time")
    replay = sub.add_parser("replay", help="roll up an archive of raw lines")
    replay.add_argument("--archive", required=True)
    replay.add_argument("--on", choices=("event", "arrival"), default="event")
    for command in (stream, replay):
        command.add_argument("program", choices=[*PROGRAMS, "all"])
        command.add_argument("--tables", help="folder of the parquet tables")
        command.add_argument("--documents", help="folder of a document store, instead")
        command.add_argument("--sink-format", help="connector to write with instead")
        command.add_argument("--sink-table-option", default="collection",
                             help="the connector's option that takes a table's name")
        command.add_argument("--quarantine", help="folder for malformed lines")
        command.add_argument("--slice", type=int, default=3600,
                             help="table slice, seconds; the same for a table's life")
        command.add_argument("--window", type=int, default=300, help="window, seconds")
        command.add_argument("--compat-float32", action="store_true")
    args = parser.parse_args(argv)
    if sum(map(bool, (args.tables, args.documents, args.sink_format))) != 1:
        parser.error("give one of --tables, --documents and --sink-format")
    return args


def chosen(program: str) -> dict[str, tuple]:
    """The roll-ups of a program; ``all`` is one query, which reads every topic once."""
    return {program: ROLLUPS if program == "all" else PROGRAMS[program]}


def sink_of(args: argparse.Namespace) -> Sink:
    if args.sink_format:
        return external_sink(args.sink_format, env_options("NETROLLUP_SINK"),
                             args.sink_table_option)
    if args.documents:
        return document_sink(args.documents)
    return table_sink(args.tables, args.slice)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    sink = sink_of(args)
    by_event = args.event_time or args.closed_after is not None
    trigger_s = args.trigger if by_event else args.window
    watch(spark, slow_s=trigger_s)
    closing: dict[str, StatefulStream] = {}
    for name, specs in chosen(args.program).items():
        topics = list(dict.fromkeys(s.topic for s in specs))
        options = kafka_options(
            args.servers, topics, args.starting, args.rate, args.partitions, trigger_s,
            env_options("NETROLLUP_KAFKA"),
        )
        raw = read_kafka(spark, options)
        if args.preview:
            preview_stream(raw, name=f"{name}-preview")
        common = {"window_s": args.window, "compat_float32": args.compat_float32, "name": name}
        progress = f"{args.checkpoint}/{name}"
        bad = args.quarantine and f"{args.quarantine}/{name}"
        if args.closed_after is not None:
            made = stateful_stream(
                raw, specs, sink, progress,
                lambda begin, end, of=options: read_kafka_range(spark, of, begin, end),
                f"{progress}/late", delay_s=args.closed_after, trigger_s=trigger_s, **common)
            closing[made.query.id] = made
        elif args.event_time:
            event_stream(raw, specs, sink, progress, trigger_s=trigger_s, quarantine_path=bad,
                         **common)
        else:
            arrival_stream(raw, specs, sink, progress, quarantine_path=bad, **common)
    # A stop request ends the program after the windows in flight are written.
    signal.signal(signal.SIGTERM, lambda *_: sys.exit(0))
    try:
        await_any(spark)
    finally:
        for query in spark.streams.active:
            made = closing.get(query.id)
            made.stop() if made else stop_gracefully(query)


def run_replay(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_archive(spark, args.archive)
    specs = [s for group in chosen(args.program).values() for s in group]
    done = replay_all(raw, specs, args.window, args.on, args.compat_float32)
    try:
        write_tables(spark, [(done.tables[s.table], s) for s in specs], sink_of(args))
        if args.quarantine:
            done.malformed.write.mode("append").parquet(args.quarantine)
        if n_bad := done.malformed.count():
            _LOG.warning("%d malformed lines%s", n_bad, "" if args.quarantine else ", not kept")
    finally:
        done.release()


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("netrollup").getOrCreate()
    if args.action == "stream":
        run_stream(tune(spark, STREAM), args)
    else:
        run_replay(tune(spark, REPLAY), args)


if __name__ == "__main__":
    main()
