"""The 13 roll-ups, declared as data.

A roll-up names its input (topic, type tag), its group keys, what it computes
from which field, and how its rows are keyed.  ``operators.rollup`` turns a
declaration into a DataFrame plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from netrollup.functions import bit_rate, percent, ratio, round2, to_mega, whole
from netrollup.schema import EVENT_TIME

MEAN, FLOOR, GROWTH, RATE = "mean", "floor", "growth", "rate"

# Inputs computed per row from other fields.
DERIVED = {"diskUsage": ("diskTotal", "diskFree")}


def row_value(name: str) -> Column:
    """The per-row input ``name``: a message field, or one derived from some."""
    if name == "diskUsage":
        used = F.col("diskTotal") - F.col("diskFree")
        return ratio(used, F.col("diskTotal"))
    return F.col(name)


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` applied to input ``field``, in ``unit``."""

    name: str
    field: str
    kind: str
    unit: str = ""

    @property
    def is_gauge(self) -> bool:
        return self.kind in (MEAN, FLOOR)

    def value(self, aggregate: Column, seconds: Column) -> Column:
        """Output value from the group's mean (gauge) or growth (counter)."""
        if self.kind == FLOOR:
            return whole(aggregate)
        if self.kind == GROWTH:
            return aggregate
        if self.kind == RATE:
            return bit_rate(aggregate, seconds)
        if self.unit == "percent":
            aggregate = percent(aggregate)
        elif self.unit == "mega":
            aggregate = to_mega(aggregate)
        return round2(aggregate)


def mean(name, field=None, unit=""):
    return Measure(name, field or name, MEAN, unit)


def floor(name, field=None):
    return Measure(name, field or name, FLOOR)


def growth(name, field=None):
    return Measure(name, field or name, GROWTH)


def rate(name, field=None):
    return Measure(name, field or name, RATE)


@dataclass(frozen=True)
class Rollup:
    key: str
    table: str
    topic: str
    tag: str | None
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    rates: tuple[Measure, ...]
    id_parts: tuple[str, ...]
    cpe_only: bool = False
    rates_before_id: bool = False

    @property
    def all_measures(self) -> tuple[Measure, ...]:
        return self.measures + self.rates

    def inputs(self, gauges: bool) -> list[str]:
        """Distinct inputs of the gauge (or counter) measures, in order."""
        return list(dict.fromkeys(
            m.field for m in self.all_measures if m.is_gauge == gauges
        ))

    @property
    def fields(self) -> list[str]:
        """Message fields this roll-up reads; nothing else is parsed."""
        names = list(self.keys)
        if self.tag is not None:
            names.append("resourceLogo")
        if self.cpe_only:
            names.append("isCpe")
        for name in self.inputs(True) + self.inputs(False):
            names += DERIVED.get(name, (name,))
        return list(dict.fromkeys(names + [EVENT_TIME]))

    @property
    def columns(self) -> list[str]:
        """Output columns, in table order."""
        rates = [m.name for m in self.rates]
        tail = ["timestamp", "dealTime"]
        tail += rates + ["_id", "timeType"] if self.rates_before_id \
            else ["_id", "timeType"] + rates
        return list(self.keys) + [m.name for m in self.measures] + tail


_DEVICE = ("resourceUuid", "resourceLogo", "fabric", "host")
_CPE_LINK = ("resourceUuid", "resourceLogo", "cpe", "fabric", "host")
_BYTE_RATES = (rate("rxBytes"), rate("txBytes"))
_FLOW = (growth("rxTotal", "rxBytes"), growth("txTotal", "txBytes"),
         growth("rxPackage", "rxPkts"), growth("txPackage", "txPkts"))

# Table names, tags, keys and column names are the output contract.
ROLLUPS = (
    Rollup(
        "r01_cpe_basic", "network_cpe_basic", "cpe", "cpe",
        keys=_DEVICE,
        measures=(
            mean("cpuUsedRate", "cpu", "percent"),
            mean("memUsedRate", "memUsage"),
            mean("diskUsedRate", "diskUsage", "percent"),
            mean("diskAvalible", "diskFree", "mega"),
            mean("cpeConnections", "connections"),
        ),
        rates=(), id_parts=("resourceUuid",),
    ),
    Rollup(
        "r02_cpe_chain", "network_cpe_chain", "cpe", "cpePopDelay",
        keys=_CPE_LINK,
        measures=(
            mean("rtt"),
            mean("rttIpsec"),
            mean("loss", unit="percent"),
            mean("lossIpsec", unit="percent"),
            mean("jitter"),
            mean("jitterIpsec"),
        ),
        rates=(), id_parts=("resourceUuid",),
    ),
    Rollup(
        "r03_cpe_tunnel", "network_cpe_tunnel", "cpe", "cepTunStats",
        keys=_CPE_LINK,
        measures=(mean("jitter"), mean("rtt"), mean("loss", unit="percent")),
        rates=(rate("rxBytes", "rxByte"), rate("txBytes", "txByte")),
        id_parts=("resourceUuid",),
    ),
    Rollup(
        "r04_cpe_interface", "network_cpe_interface", "cpe", "cpePort",
        keys=_DEVICE + ("ifName", "monIfKey"),
        measures=(
            growth("rxDrops"), growth("txDrops"),
            growth("rxErrs"), growth("txErrs"),
            growth("rxPkts"), growth("txPkts"),
        ),
        rates=_BYTE_RATES, id_parts=("resourceUuid", "ifName"),
    ),
    Rollup(
        "r05_cpe_pop", "network_cpe_pop", "vpe", "vpePort",
        keys=("peer", "resourceLogo", "fabric"),
        measures=(growth("rxTotal", "rxBytes"), growth("txTotal", "txBytes")),
        rates=_BYTE_RATES, id_parts=("peer",), cpe_only=True,
    ),
    Rollup(
        "r06_vpe_basic", "network_vpe_basic", "vpe", "vpe",
        keys=_DEVICE,
        measures=(mean("cpu", unit="percent"), mean("memUsedRate", "memUsage")),
        rates=(), id_parts=("resourceUuid",),
    ),
    Rollup(
        "r07_vpe_disk", "network_vpe_disk", "vpe", "vpeDisk",
        keys=_DEVICE,
        measures=(
            mean("usedPercent"),
            mean("diskAvalible", "free", "mega"),
            mean("diskTotal", "total", "mega"),
            floor("inodesTotal"),
            floor("inodesFree"),
        ),
        rates=(), id_parts=("resourceUuid",),
    ),
    Rollup(
        "r08_vpe_connection", "network_vpe_connection", "vpe", "vpeConnection",
        keys=_DEVICE,
        measures=(floor("connections"),),
        rates=(), id_parts=("resourceUuid",),
    ),
    Rollup(
        "r09_vpe_interface", "network_vpe_interface", "vpe", "vpePort",
        keys=_DEVICE + ("ifName",),
        measures=_FLOW, rates=_BYTE_RATES, id_parts=("resourceUuid", "ifName"),
    ),
    Rollup(
        "r10_vpe_peer_flow", "network_vpe_peer_flow", "vpe", "vpePort",
        keys=_DEVICE + ("peer",),
        measures=_FLOW, rates=_BYTE_RATES, id_parts=("resourceUuid", "peer"),
    ),
    Rollup(
        "r11_vpe_delay", "network_vpe_delay", "sdwan", None,
        keys=("resourceUuid", "resourceLogo", "fabric", "category",
              "src", "srcName", "dst", "dstName"),
        measures=(mean("loss", unit="percent"), mean("delay"), mean("jitter")),
        rates=(), id_parts=("resourceUuid", "category"),
    ),
    Rollup(
        "r12_ce_basic", "network_ce_basic", "switch", "switch",
        keys=("switchUuid", "resourceLogo", "fabric"),
        measures=(
            mean("cpu", "cpuUsage"),
            mean("memUsedRate", "memUsage", "percent"),
            mean("memUse"),
        ),
        rates=(), id_parts=("switchUuid",),
    ),
    Rollup(
        "r13_ce_port", "network_ce_port", "switch", "switchPort",
        keys=("switchUuid", "resourceLogo", "fabric", "host", "deviceType", "portUuid"),
        measures=(
            mean("inUtilization"), mean("outUtilization"),
            growth("inBroadcastPkg"), growth("inDiscardPkg"), growth("inErrorPkg"),
            growth("inPkg"), growth("inUcastPkg"),
            growth("outBroadcastPkg"), growth("outDiscardPkg"), growth("outErrorPkg"),
            growth("outPkg"), growth("outUcastPkg"),
        ),
        rates=(rate("inTraffic"), rate("outTraffic")),
        id_parts=("switchUuid", "portUuid"), rates_before_id=True,
    ),
)

BY_KEY = {r.key: r for r in ROLLUPS}

# The roll-ups each monitoring program maintains.
PROGRAMS = {
    "cpe": ROLLUPS[0:5],
    "vpe": ROLLUPS[5:11],
    "ce": ROLLUPS[11:13],
}
