"""Time buckets and document keys, in epoch arithmetic (no session time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_ms(seconds: Column, width_s: int = 300, compat_float32: bool = False) -> Column:
    """Start of the bucket that holds epoch ``seconds``, in milliseconds.

    ``compat_float32`` first rounds the input to a 32-bit float, whose step is
    128 s at present-day epochs; use it only to reproduce historic rows.
    """
    if compat_float32:
        seconds = seconds.cast("float")
    whole = seconds.try_cast("bigint")
    start = F.try_subtract(whole, F.pmod(whole, F.lit(width_s)))
    return F.try_multiply(start, F.lit(1000))


def doc_key(*parts: Column) -> Column:
    """Parts joined by ``_``; a missing part is spelt ``null``."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit("_"), text]
    return F.concat(*joined)


def epoch_seconds_ntz(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less timestamp taken as UTC."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    second = F.floor(F.second(ts))
    return (days.cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + second)


def slice_ms(deal_time: Column, width_s: int) -> Column:
    """Start (ms) of the ``width_s`` slice that holds ``deal_time`` (ms)."""
    return F.try_subtract(deal_time, F.pmod(deal_time, F.lit(width_s * 1000)))
