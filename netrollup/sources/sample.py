"""Telemetry messages derived from the ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` plays the fleet:
event ids grow with time, so multiples of them act as monotone counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.functions import epoch_seconds_ntz

# Message fields by route, as SQL over e, u, v (id, user, value), d (device) and
# c (epoch seconds).  A route's position is event_id % 11.
_BASE = {"fabric": "concat('fab-', d % 3)", "collectdate": "c"}
_BOX = {"resourceUuid": "concat('dev-', d)", "host": "concat('host-', d)", **_BASE}
_SWITCH = {"switchUuid": "concat('sw-', d)", **_BASE}
_CPE = {"cpe": "concat('cpe-', d % 4)"}
_IF_NAME = {"ifName": "concat('eth', u % 2)"}
_FAULTS = "floor(e / 50)"
_PORT = {
    "rxBytes": "e * 1500", "txBytes": "e * 700", "rxPkts": "e * 3", "txPkts": "e * 3",
    **dict.fromkeys(("rxDrops", "txDrops", "rxErrs", "txErrs"), _FAULTS),
}
_LINK = {"jitter": "v", "rtt": "v", "loss": "v / 500"}
_DISK = {"total": "5000000 + e", "free": "v * 10000"}
_IN_OUT = {
    "inTraffic": "e * 1500", "outTraffic": "e * 700",
    **{f"{way}{kind}": "e * 3" for way in ("in", "out") for kind in
       ("BroadcastPkg", "Pkg", "UcastPkg")},
    **{f"{way}{kind}": _FAULTS for way in ("in", "out") for kind in ("DiscardPkg", "ErrorPkg")},
}
ROUTES = (
    ("cpe", "cpe", {**_BOX, "cpu": "v / 500", "memUsage": "v / 5", "connections": "v",
                    "diskTotal": _DISK["total"], "diskFree": _DISK["free"]}),
    ("cpe", "cpePopDelay", {**_BOX, **_CPE, **_LINK, "jitterIpsec": "v", "rttIpsec": "v",
                            "lossIpsec": "v / 500"}),
    ("cpe", "cepTunStats", {**_BOX, **_CPE, **_LINK, "rxByte": "e * 1500",
                            "txByte": "e * 700"}),
    ("cpe", "cpePort", {**_BOX, **_IF_NAME, "monIfKey": "concat('mk-', u % 2)", **_PORT}),
    ("vpe", "vpe", {**_BOX, "cpu": "v / 500", "memUsage": "v / 5"}),
    ("vpe", "vpeDisk", {**_BOX, **_DISK, "used": "5000000 + e - v * 10000",
                        "usedPercent": "v / 5", "inodesTotal": "100000",
                        "inodesFree": "v * 100"}),
    ("vpe", "vpeConnection", {**_BOX, "connections": "v"}),
    ("vpe", "vpePort", {**_BOX, **_IF_NAME, "peer": "concat('peer-', u % 5)",
                        "isCpe": "if(u % 2 = 0, 'y', 'n')", **_PORT}),
    ("switch", "switch", {**_SWITCH, "cpuUsage": "v / 5", "memUsage": "v / 500",
                          "memUse": "v"}),
    ("switch", "switchPort", {**_SWITCH, "host": _BOX["host"], "deviceType": "'switch'",
                              "portUuid": "concat('port-', u % 2)", "inUtilization": "v",
                              "outUtilization": "v", **_IN_OUT}),
    ("sdwan", "vpeDelay", {
        "resourceUuid": _BOX["resourceUuid"], **_BASE, "category": "concat('cat-', u % 2)",
        "src": "concat('s', d)", "srcName": "concat('S', d)",
        "dst": "concat('d', u % 2)", "dstName": "concat('D', u % 2)",
        "delay": "v", "jitter": "v", "loss": "v / 500",
    }),
)


def _message(tag: str, fields: dict[str, str]) -> str:
    pairs = ", ".join(f"'{n}', {x}" for n, x in ({"resourceLogo": f"'{tag}'"} | fields).items())
    return f"to_json(named_struct({pairs}))"


def raw_from_events(events: DataFrame, cut_every: int | None = None,
                    delay_s: str = "0") -> DataFrame:
    """Raw records (``topic``, ``value``, ``arrival``), one per event.

    ``cut_every=n`` spoils every n-th message by dropping its last character; ``delay_s``, SQL
    over the event id ``e``, is the time a message takes to arrive.
    """
    topic = " ".join(f"when {i} then '{t}'" for i, (t, _, _) in enumerate(ROUTES))
    value = " ".join(f"when {i} then {_message(g, f)}" for i, (_, g, f) in enumerate(ROUTES))
    value = f"case e % 11 {value} end"
    rows = events.select(
        F.col("event_id").alias("e"), F.col("user_id").alias("u"), F.col("value").alias("v"),
        F.expr("user_id % 7").alias("d"), epoch_seconds_ntz(F.col("ts")).alias("c"),
    )
    # A generator keeps later text filters from being pushed into, and so
    # repeating, the expression that builds the message.
    raw = rows.selectExpr(
        "e",
        f"case e % 11 {topic} end as topic",
        f"explode(array({value})) as value",
        f"timestamp_seconds(c + {delay_s}) as arrival",
    )
    if cut_every:
        raw = raw.withColumn("value", F.expr(
            f"if(e % {cut_every} = 0, left(value, length(value) - 1), value)"
        ))
    return raw.drop("e")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sample_raw(spark: SparkSession, sf_dir: str, cut_every: int | None = None) -> DataFrame:
    return raw_from_events(read_events(spark, sf_dir), cut_every)
