"""Event-time windows, for sources that deliver late or in bulk.

A line belongs to the window of its own time, or of its arrival where it has none, as in
a replay.  Windows are kept up to date: a late line changes the rows of its window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from netrollup.operators.parse import parse, quarantine
from netrollup.operators.rollup import with_event_window
from netrollup.streaming.common import Sink, start
from netrollup.streaming.windows import window_stream


def event_stream(raw: DataFrame, specs, sink: Sink, checkpoint: str, window_s: int = 300,
                 trigger_s: int = 60, **options) -> StreamingQuery:
    """Write the tables of ``specs`` for the windows that each trigger's lines fall in.

    ``options`` are those of ``window_stream``.
    """
    return window_stream(raw, specs, sink, checkpoint,
                         lambda rows: with_event_window(rows, window_s), trigger_s, **options)


def quarantine_stream(raw: DataFrame, path: str, checkpoint: str, trigger_s: int = 60,
                      available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Append the malformed lines of ``raw``, which no window holds, to ``path``."""
    bad = quarantine(parse(raw, ["resourceLogo"]))
    writer = bad.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer, checkpoint, trigger_s, available_now, name)
