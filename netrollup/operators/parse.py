"""Raw lines -> typed rows, in one JSON parse.

``raw`` has columns ``topic``, ``value`` and ``arrival``.  The parsed frame has
``topic``, ``arrival``, one typed column per requested field, and ``malformed``:
the raw text of a line that is not JSON of the expected shape, else null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.schema import ALL_FIELDS, MISFIT, lenient_records, typed_schema


def parse(raw: DataFrame, fields: Iterable[str] = ALL_FIELDS,
          keep: Iterable[str] = (), position: str | None = None) -> DataFrame:
    """Parse every line once; only ``fields`` are extracted.

    A line may hold one object or an array of objects; a blank line gives no
    row.  A malformed line gives one row with ``malformed`` set.  ``keep`` names
    further columns of ``raw`` to carry along, ``position`` a column for an object's
    place in its line.
    """
    fields, carried = list(fields), ["topic", "arrival", *keep]
    record = F.col("record")
    lines = raw.withColumn("message", F.from_json(
        "value", typed_schema(fields), {"columnNameOfCorruptRecord": MISFIT}
    ))
    # The typed read takes nearly every line.  What it rejects, be it an array of
    # objects, a quoted number or no JSON at all, is read again as text.
    records = F.expr(
        f"if(message.{MISFIT} is null, array(message), {lenient_records(fields)})"
    )
    if position is None:
        rows = lines.select(*carried, F.explode_outer(records).alias("record"))
    else:
        rows = lines.select(*carried, F.posexplode_outer(records).alias(position, "record"))
        carried.append(position)
    return rows.where(record.isNotNull()).select(
        *carried, record[MISFIT].alias("malformed"), *[record[f].alias(f) for f in fields]
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """The malformed lines, with their raw text."""
    return parsed.where(F.col("malformed").isNotNull()).select(
        "topic", "arrival", F.col("malformed").alias("value")
    )


def may_carry_tag(tags: Iterable[str]) -> Column:
    """Cheap test on the raw text that no line carrying one of ``tags`` fails.

    It spares the JSON parser the lines of other routes.  A tag can be spelt in
    double or single quotes, or with a ``\\u`` escape; all three pass.
    """
    text = F.col("value")
    test = text.contains("\\u")
    for tag in tags:
        test = test | text.contains(f'"{tag}"') | text.contains(f"'{tag}'")
    return test
