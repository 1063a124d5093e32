"""Field catalogue of the telemetry messages.

Every message is one flat JSON object whose fields have fixed types, so one quoted
or fractional number in the input never changes a column's type.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Wire field names, by kind.
IDENTITY = (
    "resourceUuid", "resourceLogo", "fabric", "host", "cpe", "peer", "ifName",
    "monIfKey", "category", "src", "srcName", "dst", "dstName", "switchUuid",
    "deviceType", "portUuid", "isCpe",
)
GAUGE = (
    "cpu", "memUsage", "diskFree", "diskTotal", "connections", "jitter", "loss",
    "rtt", "jitterIpsec", "lossIpsec", "rttIpsec", "inodesFree", "inodesTotal",
    "free", "total", "usedPercent", "delay", "cpuUsage", "memUse",
    "inUtilization", "outUtilization",
)
COUNTER = (
    "rxByte", "txByte", "rxBytes", "txBytes", "rxDrops", "txDrops", "rxErrs",
    "txErrs", "rxPkts", "txPkts", "inTraffic", "outTraffic", "inBroadcastPkg",
    "inDiscardPkg", "inErrorPkg", "inPkg", "inUcastPkg", "outBroadcastPkg",
    "outDiscardPkg", "outErrorPkg", "outPkg", "outUcastPkg",
)
EVENT_TIME = "collectdate"

ALL_FIELDS = IDENTITY + GAUGE + COUNTER + (EVENT_TIME,)

TOPICS = ("cpe", "vpe", "sdwan", "switch")

RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("arrival", T.TimestampType()),
])


# Extra field of the typed reader schema: the raw text of a line it cannot take.
MISFIT = "misfit"


def field_type(name: str) -> str:
    if name in COUNTER:
        return "bigint"
    if name in GAUGE or name == EVENT_TIME:
        return "double"
    if name in IDENTITY:
        return "string"
    raise KeyError(f"unknown field {name!r}")


def typed_schema(fields: Iterable[str]) -> str:
    """Reader schema of a well-formed message: one object, every field in its type."""
    return ", ".join([f"{f} {field_type(f)}" for f in fields] + [f"{MISFIT} string"])


def lenient_records(fields: Iterable[str]) -> str:
    """SQL that reads ``value`` where the typed schema does not fit.

    Every field is read as text and then cast, so a quoted or fractional number
    counts as what it says and other text as null.  A lone object becomes an array
    of one, an array of objects stays what it is.  Anything else becomes one empty
    record with the raw text in its misfit field.
    """
    def cast(name: str) -> str:
        kind, text = field_type(name), f"r.{name}"
        if kind == "bigint":
            # Whole numbers first: going through double loses digits above 2**53.
            return (f"coalesce(try_cast({text} as bigint), "
                    f"try_cast(try_cast({text} as double) as bigint))")
        return text if kind == "string" else f"try_cast({text} as {kind})"

    def record(field_sql, misfit: str) -> str:
        pairs = ", ".join(f"'{f}', {field_sql(f)}" for f in fields)
        return f"named_struct({pairs}, '{MISFIT}', {misfit})"

    fields = list(fields)
    schema = ", ".join(f"{f}: string" for f in fields)
    read = record(cast, "cast(null as string)")
    empty = record(lambda f: f"cast(null as {field_type(f)})", "value")
    return (f"coalesce(transform(from_json(value, 'array<struct<{schema}>>'), "
            f"r -> if(r is null, null, {read})), array({empty}))")
