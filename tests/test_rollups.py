"""Each roll-up on a few messages, with rows worked out by hand."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from netrollup.operators.parse import parse
from netrollup.operators.rollup import rollup_many, table_of, with_event_window
from netrollup.plans.batch import aggregate_pass, replay, replay_tables
from netrollup.plans.specs import BY_KEY, PROGRAMS, ROLLUPS

T0 = 1591760100  # on a five-minute mark
TAIL = {"timestamp": T0 * 1000, "dealTime": T0 * 1000, "timeType": "5"}
BOX = {"resourceUuid": "u1", "fabric": "f1", "host": "h1"}
LINK = BOX | {"cpe": "c1"}


def samples(tag, base, *readings):
    """Messages of one device, 10 s apart."""
    return [base | {"resourceLogo": tag, "collectdate": T0 + 10 * i} | r
            for i, r in enumerate(readings)]


def port(rx, tx, pkts, drops):
    return {"rxBytes": rx, "txBytes": tx, "rxPkts": pkts, "txPkts": pkts * 2,
            "rxDrops": drops, "txDrops": drops + 1, "rxErrs": 0, "txErrs": drops * drops}


def switch_port(n):
    names = ["BroadcastPkg", "DiscardPkg", "ErrorPkg", "Pkg", "UcastPkg"]
    one = {f"in{x}": n * (i + 1) for i, x in enumerate(names)}
    two = {f"out{x}": n * (i + 10) for i, x in enumerate(names)}
    return one | two | {"inTraffic": n * 1000, "outTraffic": n * 500,
                        "inUtilization": n * 1.5, "outUtilization": n / 3}


FLOW = BOX | {"ifName": "eth0", "peer": "p1", "isCpe": "y"}
PORTS = samples("vpePort", FLOW, port(100, 10, 5, 0), port(900, 20, 6, 1), port(20, 70, 9, 2))
FLOW_OUT = {"rxTotal": 880, "txTotal": 60, "rxPackage": 4, "txPackage": 8,
            "rxBytes": 352.0, "txBytes": 24.0}

CASES = {
    "r01_cpe_basic": (
        samples("cpe", BOX,
                {"cpu": 0.5, "memUsage": 10.0, "diskFree": 1048576, "diskTotal": 4194304,
                 "connections": 3},
                {"cpu": 0.25, "memUsage": 10.005, "diskFree": 1048576, "diskTotal": 0,
                 "connections": 4}),
        {"cpuUsedRate": 37.5, "memUsedRate": 10.0, "diskUsedRate": 75.0, "diskAvalible": 1.0,
         "cpeConnections": 3.5, "_id": f"u1_{T0}000"},
    ),
    "r02_cpe_chain": (
        samples("cpePopDelay", LINK,
                {"rtt": 1, "rttIpsec": 2, "loss": 0.01, "lossIpsec": 0.02, "jitter": 5,
                 "jitterIpsec": 6},
                {"rtt": 2, "rttIpsec": None, "loss": 0.02, "lossIpsec": 0.02, "jitter": 5,
                 "jitterIpsec": 7}),
        {"rtt": 1.5, "rttIpsec": 2.0, "loss": 1.5, "lossIpsec": 2.0, "jitter": 5.0,
         "jitterIpsec": 6.5, "_id": f"u1_{T0}000"},
    ),
    "r03_cpe_tunnel": (
        samples("cepTunStats", LINK,
                {"jitter": 1, "rtt": 2, "loss": 0.1, "rxByte": 0, "txByte": 5},
                {"jitter": 2, "rtt": 2, "loss": 0.1, "rxByte": 100, "txByte": 5}),
        {"jitter": 1.5, "rtt": 2.0, "loss": 10.0, "rxBytes": 80.0, "txBytes": 0.0,
         "_id": f"u1_{T0}000"},
    ),
    "r04_cpe_interface": (
        samples("cpePort", BOX | {"ifName": "eth0", "monIfKey": "m"},
                port(0, 0, 1, 2), port(1000, 500, 4, 3)),
        {"rxDrops": 1, "txDrops": 1, "rxErrs": 0, "txErrs": 5, "rxPkts": 3, "txPkts": 6,
         "rxBytes": 800.0, "txBytes": 400.0, "_id": f"u1_eth0_{T0}000"},
    ),
    "r05_cpe_pop": (
        PORTS, {"rxTotal": 880, "txTotal": 60, "rxBytes": 352.0, "txBytes": 24.0,
                "_id": f"p1_{T0}000"},
    ),
    "r06_vpe_basic": (
        samples("vpe", BOX, {"cpu": 0.1, "memUsage": 40}, {"cpu": 0.2, "memUsage": 50}),
        {"cpu": 15.0, "memUsedRate": 45.0, "_id": f"u1_{T0}000"},
    ),
    "r07_vpe_disk": (
        samples("vpeDisk", BOX,
                {"usedPercent": 50, "free": 1048576, "total": 2097152, "inodesTotal": 10,
                 "inodesFree": 7, "used": 1},
                {"usedPercent": 51, "free": 1048576, "total": 2097152, "inodesTotal": 10,
                 "inodesFree": 8, "used": 1}),
        {"usedPercent": 50.5, "diskAvalible": 1.0, "diskTotal": 2.0, "inodesTotal": 10,
         "inodesFree": 7, "_id": f"u1_{T0}000"},
    ),
    "r08_vpe_connection": (
        samples("vpeConnection", BOX, {"connections": 4}, {"connections": 5}),
        {"connections": 4, "_id": f"u1_{T0}000"},
    ),
    "r09_vpe_interface": (PORTS, FLOW_OUT | {"_id": f"u1_eth0_{T0}000"}),
    "r10_vpe_peer_flow": (PORTS, FLOW_OUT | {"_id": f"u1_p1_{T0}000"}),
    "r11_vpe_delay": (
        samples("vpeDelay",
                {"resourceUuid": "u1", "fabric": "f1", "category": "k", "src": "a",
                 "srcName": "A", "dst": "b", "dstName": "B"},
                {"loss": 0.5, "delay": 3, "jitter": 1}, {"loss": 0, "delay": 4, "jitter": 1}),
        {"loss": 25.0, "delay": 3.5, "jitter": 1.0, "_id": f"u1_k_{T0}000"},
    ),
    "r12_ce_basic": (
        samples("switch", {"switchUuid": "s1", "fabric": "f1"},
                {"cpuUsage": 30, "memUsage": 0.5, "memUse": 100},
                {"cpuUsage": 31, "memUsage": 0.7, "memUse": 101}),
        {"cpu": 30.5, "memUsedRate": 60.0, "memUse": 100.5, "_id": f"s1_{T0}000"},
    ),
    "r13_ce_port": (
        samples("switchPort",
                {"switchUuid": "s1", "fabric": "f1", "host": "h1", "deviceType": "switch",
                 "portUuid": "q1"},
                switch_port(1), switch_port(2), switch_port(4)),
        {"inUtilization": 3.5, "outUtilization": 0.78, "inBroadcastPkg": 3, "inDiscardPkg": 6,
         "inErrorPkg": 9, "inPkg": 12, "inUcastPkg": 15, "outBroadcastPkg": 30,
         "outDiscardPkg": 33, "outErrorPkg": 36, "outPkg": 39, "outUcastPkg": 42,
         "inTraffic": 1200.0, "outTraffic": 600.0, "_id": f"s1_q1_{T0}000"},
    ),
}

DEVICE = "resourceUuid resourceLogo fabric host"
CPE_LINK = "resourceUuid resourceLogo cpe fabric host"
END = "timestamp dealTime _id timeType"
FLOW_COLUMNS = f"rxTotal txTotal rxPackage txPackage {END} rxBytes txBytes"
COLUMNS = {
    "r01_cpe_basic":
        f"{DEVICE} cpuUsedRate memUsedRate diskUsedRate diskAvalible cpeConnections {END}",
    "r02_cpe_chain": f"{CPE_LINK} rtt rttIpsec loss lossIpsec jitter jitterIpsec {END}",
    "r03_cpe_tunnel": f"{CPE_LINK} jitter rtt loss {END} rxBytes txBytes",
    "r04_cpe_interface":
        f"{DEVICE} ifName monIfKey rxDrops txDrops rxErrs txErrs rxPkts txPkts {END}"
        " rxBytes txBytes",
    "r05_cpe_pop": f"peer resourceLogo fabric rxTotal txTotal {END} rxBytes txBytes",
    "r06_vpe_basic": f"{DEVICE} cpu memUsedRate {END}",
    "r07_vpe_disk":
        f"{DEVICE} usedPercent diskAvalible diskTotal inodesTotal inodesFree {END}",
    "r08_vpe_connection": f"{DEVICE} connections {END}",
    "r09_vpe_interface": f"{DEVICE} ifName {FLOW_COLUMNS}",
    "r10_vpe_peer_flow": f"{DEVICE} peer {FLOW_COLUMNS}",
    "r11_vpe_delay":
        "resourceUuid resourceLogo fabric category src srcName dst dstName"
        f" loss delay jitter {END}",
    "r12_ce_basic": f"switchUuid resourceLogo fabric cpu memUsedRate memUse {END}",
    "r13_ce_port":
        "switchUuid resourceLogo fabric host deviceType portUuid inUtilization outUtilization"
        " inBroadcastPkg inDiscardPkg inErrorPkg inPkg inUcastPkg outBroadcastPkg"
        " outDiscardPkg outErrorPkg outPkg outUcastPkg timestamp dealTime inTraffic outTraffic"
        " _id timeType",
}
LONGS = {"rxDrops", "txDrops", "rxErrs", "txErrs", "rxPkts", "txPkts", "rxTotal", "txTotal",
         "rxPackage", "txPackage", "inodesTotal", "inodesFree", "timestamp", "dealTime"}


def test_thirteen_tables():
    assert len({s.table for s in ROLLUPS}) == len({s.key for s in ROLLUPS}) == 13
    assert [len(PROGRAMS[p]) for p in ("cpe", "vpe", "ce")] == [5, 6, 2]


@pytest.mark.parametrize("spec", ROLLUPS, ids=lambda s: s.key)
def test_worked_rows(raw_of, spec):
    messages, want = CASES[spec.key]
    df = replay(raw_of([(spec.topic, m) for m in messages]), spec)
    assert df.columns == COLUMNS[spec.key].split()
    rows = df.collect()
    assert len(rows) == 1
    keys = {k: messages[0][k] for k in spec.keys}
    assert rows[0].asDict() == keys | TAIL | want
    for name, kind in df.dtypes:
        if name in spec.keys or name in ("_id", "timeType"):
            assert kind == "string"
        elif name in LONGS or name.endswith("Pkg") or spec.key[:3] == "r08":
            assert kind == "bigint"
        else:
            assert kind == "double"


@pytest.mark.parametrize("spec", ROLLUPS, ids=lambda s: s.key)
def test_nothing_in_nothing_out(raw_of, spec):
    df = replay(raw_of([]), spec)
    assert df.columns == list(spec.columns) and df.count() == 0


def rows_of(raw_of, key, messages, **options):
    spec = BY_KEY[key]
    return replay(raw_of([(spec.topic, m) for m in messages]), spec, **options).collect()


def test_single_sample_has_no_rate(raw_of):
    row, = rows_of(raw_of, "r09_vpe_interface", PORTS[:1])
    assert (row.rxTotal, row.rxBytes, row.txBytes) == (0, None, None)


def test_gauge_missing_everywhere_is_null(raw_of):
    row, = rows_of(raw_of, "r06_vpe_basic", samples("vpe", BOX, {"memUsage": 4}))
    assert (row.cpu, row.memUsedRate) == (None, 4.0)


def test_null_keys_form_a_group(raw_of):
    row, = rows_of(raw_of, "r06_vpe_basic", samples("vpe", {"fabric": "f"}, {"cpu": 0.1}))
    assert row.resourceUuid is None and row._id == f"null_{T0}000"


def test_peer_flow_spans_the_interfaces_of_a_peer(raw_of):
    one, two = dict(PORTS[0]), dict(PORTS[1], ifName="eth1")
    row, = rows_of(raw_of, "r10_vpe_peer_flow", [one, two])
    assert row.rxTotal == 800
    assert len(rows_of(raw_of, "r09_vpe_interface", [one, two])) == 2


def test_windows_split_and_growth_between_them_is_not_counted(raw_of):
    late = dict(PORTS[1], collectdate=T0 + 300)
    rows = rows_of(raw_of, "r09_vpe_interface", [PORTS[0], late])
    assert sorted((r.dealTime, r.rxTotal) for r in rows) == [
        (T0 * 1000, 0), (T0 * 1000 + 300000, 0)]
    row, = rows_of(raw_of, "r09_vpe_interface", [PORTS[0], late], window_s=900)
    assert row.rxTotal == 800


def test_timestamp_is_the_bucket_of_the_mean_time(raw_of):
    late = dict(PORTS[1], collectdate=T0 + 700)
    row, = rows_of(raw_of, "r09_vpe_interface", [PORTS[0], late], window_s=86400)
    assert row.timestamp == (T0 + 300) * 1000


def test_absurd_readings_do_not_end_the_job(raw_of):
    bad = [{"cpu": 1e308, "memUsage": "NaN"}, {"cpu": 1e308, "memUsage": 1}]
    row, = rows_of(raw_of, "r06_vpe_basic", samples("vpe", BOX, *bad))
    assert row.cpu == float("inf") and row.memUsedRate != row.memUsedRate
    messages = samples("vpe", BOX, {"cpu": 0.1}, {"cpu": 0.2})
    messages[0]["collectdate"] = 1e300
    assert len(rows_of(raw_of, "r06_vpe_basic", messages)) == 2


def everything(raw_of):
    pairs = [(BY_KEY[k].topic, m) for k, (messages, _) in CASES.items() for m in messages]
    pairs += [("vpe", dict(m, isCpe="n", peer="p2", ifName="eth1")) for m in PORTS]
    return raw_of(pairs + [("sdwan", "{"), ("cpe", "[]"), ("vpe", {"resourceLogo": "other"})])


def as_set(df):
    return {json.dumps(r.asDict(), sort_keys=True) for r in df.collect()}


def test_one_pass_gives_the_same_tables(raw_of):
    raw = everything(raw_of)
    tables = replay_tables(raw, ROLLUPS)
    assert len(tables) == 13
    for spec in ROLLUPS:
        assert tables[spec.table].columns == list(spec.columns)
        assert as_set(tables[spec.table]) == as_set(replay(raw, spec))


@pytest.mark.parametrize("program", PROGRAMS)
def test_one_pass_over_a_program(raw_of, program):
    raw, specs = everything(raw_of), PROGRAMS[program]
    grouped = aggregate_pass(raw, specs).cache()
    for spec in specs:
        assert as_set(table_of(grouped, spec)) == as_set(replay(raw, spec))


def test_a_topic_cannot_mix_tagged_and_untagged(raw_of):
    from dataclasses import replace

    mixed = [BY_KEY["r06_vpe_basic"], replace(BY_KEY["r11_vpe_delay"], topic="vpe")]
    with pytest.raises(ValueError, match="both tagged and untagged"):
        rollup_many(with_event_window(parse(raw_of([]))), mixed)


READING = st.fixed_dictionaries({
    "resourceUuid": st.sampled_from(["a", "b", None]),
    "ifName": st.sampled_from(["x", "y"]),
    "collectdate": st.integers(T0, T0 + 900),
    "rxBytes": st.integers(0, 10**12),
    "txBytes": st.one_of(st.none(), st.integers(0, 10**6)),
})


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings=st.lists(READING, min_size=1, max_size=25))
def test_flow_against_brute_force(raw_of, readings):
    messages = [r | {"resourceLogo": "vpePort"} for r in readings]
    want = {}
    for r in readings:
        window = r["collectdate"] // 300 * 300000
        want.setdefault((r["resourceUuid"], r["ifName"], window), []).append(r)
    rows = rows_of(raw_of, "r09_vpe_interface", messages)
    assert len(rows) == len(want)
    for row in rows:
        group = want[row.resourceUuid, row.ifName, row.dealTime]
        rx = [r["rxBytes"] for r in group]
        tx = [r["txBytes"] for r in group if r["txBytes"] is not None]
        times = [r["collectdate"] for r in group]
        assert row.rxTotal == max(rx) - min(rx)
        assert row.txTotal == (max(tx) - min(tx) if tx else None)
        assert row.timestamp == int(sum(times) / len(times)) // 300 * 300000
        seconds = max(times) - min(times)
        if seconds == 0:
            assert row.rxBytes is None
        else:
            assert row.rxBytes == pytest.approx(row.rxTotal / seconds * 8, abs=0.0051)
