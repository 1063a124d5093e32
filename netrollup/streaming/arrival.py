"""Arrival windows: a line belongs to the window in which its batch is processed.

Triggers fall on multiples of the window length.  The window's ``dealTime`` is
the processing time Spark records for the batch in its offset log, so a batch run
again after a failure gets the same window.  Batches that share a window, as after a
restart within it, add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netrollup.functions import bucket_ms
from netrollup.streaming.common import Sink
from netrollup.streaming.windows import window_stream


def arrival_stream(raw: DataFrame, specs, sink: Sink, checkpoint: str, window_s: int = 300,
                   clock: str = "current_timestamp()", **options) -> StreamingQuery:
    """Roll up every trigger's lines into the tables of ``specs``.

    ``clock`` is SQL over the raw record that replaces the processing time, for tests
    and replays; it is evaluated before the parse, where the raw line is still at hand.
    ``options`` are those of ``window_stream``.
    """
    label = bucket_ms(F.unix_seconds(F.expr(clock)), window_s)
    return window_stream(raw, specs, sink, checkpoint, None, window_s, before_parse=label,
                         **options)
