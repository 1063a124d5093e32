"""DuckDB equivalents of the registered queries, over ``events``."""

from __future__ import annotations

from netrollup.plans.specs import BY_KEY, PROGRAMS, ROLLUPS

# Every event with its route number and the fields its message would carry.
_TELEMETRY = """
with t as (
  select event_id as e, value as v, user_id % 7 as d, user_id % 2 as side,
         event_id % 11 as route, user_id % 5 as p,
         cast(floor(epoch(ts)) as bigint) as c
  from events
), m as (
  select *, c - c % 86400 as w,
         'dev-' || d as uuid, 'host-' || d as host, 'fab-' || (d % 3) as fab,
         'cpe-' || (d % 4) as box, 'eth' || side as eth, 'sw-' || d as sw
  from t
)
"""


def _r2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,8)), 2) as double)"


def _whole(x: str) -> str:
    return f"cast(floor(cast({x} as decimal(38,8))) as bigint)"


def _growth(x: str) -> str:
    return f"max({x}) - min({x})"


def _rate(x: str) -> str:
    return _r2(f"cast({_growth(x)} as double) / nullif(cast({_growth('c')} as double), 0) * 8")


_STAMP = "cast(floor(avg(c) / 300) as bigint) * 300000"
_FAULTS = "cast(floor(e / 50) as bigint)"


def _rollup(keys: dict[str, str], outputs: dict[str, str], route: str, id_parts: list[str],
            window: str = "w", stamp: str = _STAMP, deal: str | None = None,
            also: list[str] | None = None) -> str:
    """SELECT for one roll-up: named key expressions, named aggregate outputs.

    Rows are grouped on the keys that are plain columns, and on the columns ``also``
    that the other keys are made of.
    """
    deal = deal or f"{window} * 1000"
    cols = [f"{x} as {n}" for n, x in (keys | outputs).items()]
    key_text = " || '_' || ".join(keys[p] for p in id_parts)
    cols += [
        f"{stamp} as timestamp", f"{deal} as dealTime",
        f"{key_text} || '_' || ({deal}) as _id", "'5' as timeType",
    ]
    group = ", ".join(dict.fromkeys(
        x for x in [window, *keys.values(), *(also or [])] if "'" not in x and not x.isdigit()))
    return (f"{_TELEMETRY} select {', '.join(cols)} from m where {route} "
            f"group by {group}")


def _device(tag: str) -> dict[str, str]:
    return {"resourceUuid": "uuid", "resourceLogo": f"'{tag}'", "fabric": "fab", "host": "host"}


def _link(tag: str) -> dict[str, str]:
    return _device(tag) | {"cpe": "box"}


_FLOW = {
    "rxTotal": _growth("e * 1500"), "txTotal": _growth("e * 700"),
    "rxPackage": _growth("e * 3"), "txPackage": _growth("e * 3"),
}
_RATES = {"rxBytes": _rate("e * 1500"), "txBytes": _rate("e * 700")}
_MEAN = _r2("avg(v)")
_SHARE = _r2("avg(v / 500) * 100")
_PCT = _r2("avg(v / 5)")
_PORT_KEYS = _device("vpePort") | {"ifName": "eth"}
_PEER_KEYS = _device("vpePort") | {"peer": "'peer-' || p"}


def _flow(keys: dict[str, str], id_parts: list[str], extra: str = "", **options) -> str:
    return _rollup(keys, _FLOW | _RATES, f"route = 7{extra}", id_parts, **options)


_R6_KEYS = _device("vpe")
_R6_OUT = {"cpu": _SHARE, "memUsedRate": _PCT}


def _delay(extra: str = "", **options) -> str:
    return _rollup(
        {"resourceUuid": "uuid", "resourceLogo": "'vpeDelay'", "fabric": "fab",
         "category": "'cat-' || side", "src": "'s' || d", "srcName": "'S' || d",
         "dst": "'d' || side", "dstName": "'D' || side"},
        {"loss": _SHARE, "delay": _MEAN, "jitter": _MEAN},
        f"route = 10{extra}", ["resourceUuid", "category"], **options, also=["d", "side"])


def _tables(**options) -> dict[str, str]:
    """SQL of the 13 roll-ups."""
    def of(*args, **more) -> str:
        return _rollup(*args, **options, **more)

    return {
        "r01_cpe_basic": of(
            _device("cpe"),
            {
                "cpuUsedRate": _SHARE, "memUsedRate": _PCT,
                "diskUsedRate": _r2("avg((5000000 + e - v * 10000) / (5000000 + e)) * 100"),
                "diskAvalible": _r2("avg(v * 10000) / 1024 / 1024"),
                "cpeConnections": _MEAN,
            },
            "route = 0", ["resourceUuid"]),
        "r02_cpe_chain": of(
            _link("cpePopDelay"),
            {"rtt": _MEAN, "rttIpsec": _MEAN, "loss": _SHARE, "lossIpsec": _SHARE,
             "jitter": _MEAN, "jitterIpsec": _MEAN},
            "route = 1", ["resourceUuid"]),
        "r03_cpe_tunnel": of(
            _link("cepTunStats"),
            {"jitter": _MEAN, "rtt": _MEAN, "loss": _SHARE} | _RATES,
            "route = 2", ["resourceUuid"]),
        "r04_cpe_interface": of(
            _device("cpePort") | {"ifName": "eth", "monIfKey": "'mk-' || side"},
            {n: _growth(_FAULTS) for n in ("rxDrops", "txDrops", "rxErrs", "txErrs")}
            | {n: _growth("e * 3") for n in ("rxPkts", "txPkts")} | _RATES,
            "route = 3", ["resourceUuid", "ifName"], also=["side"]),
        "r05_cpe_pop": of(
            {"peer": "'peer-' || p", "resourceLogo": "'vpePort'", "fabric": "fab"},
            {"rxTotal": _growth("e * 1500"), "txTotal": _growth("e * 700")} | _RATES,
            "route = 7 and side = 0", ["peer"], also=["p"]),
        "r06_vpe_basic": of(_R6_KEYS, _R6_OUT, "route = 4", ["resourceUuid"]),
        "r07_vpe_disk": of(
            _device("vpeDisk"),
            {
                "usedPercent": _PCT,
                "diskAvalible": _r2("avg(v * 10000) / 1024 / 1024"),
                "diskTotal": _r2("avg(5000000 + e) / 1024 / 1024"),
                "inodesTotal": "cast(floor(avg(100000)) as bigint)",
                "inodesFree": _whole("avg(v * 100)"),
            },
            "route = 5", ["resourceUuid"]),
        "r08_vpe_connection": of(
            _device("vpeConnection"), {"connections": _whole("avg(v)")},
            "route = 6", ["resourceUuid"]),
        "r09_vpe_interface": _flow(_PORT_KEYS, ["resourceUuid", "ifName"], **options),
        "r10_vpe_peer_flow": _flow(
            _PEER_KEYS, ["resourceUuid", "peer"], **options, also=["p"]),
        "r11_vpe_delay": _delay(**options),
        "r12_ce_basic": of(
            {"switchUuid": "sw", "resourceLogo": "'switch'", "fabric": "fab"},
            {"cpu": _PCT, "memUsedRate": _SHARE, "memUse": _MEAN},
            "route = 8", ["switchUuid"]),
        "r13_ce_port": of(
            {"switchUuid": "sw", "resourceLogo": "'switchPort'", "fabric": "fab",
             "host": "host", "deviceType": "'switch'", "portUuid": "'port-' || side"},
            {n: _MEAN for n in ("inUtilization", "outUtilization")}
            | {n: _growth("e * 3") for n in (
                "inBroadcastPkg", "inPkg", "inUcastPkg",
                "outBroadcastPkg", "outPkg", "outUcastPkg")}
            | {n: _growth(_FAULTS) for n in (
                "inDiscardPkg", "inErrorPkg", "outDiscardPkg", "outErrorPkg")}
            | {"inTraffic": _rate("e * 1500"), "outTraffic": _rate("e * 700")},
            "route = 9", ["switchUuid", "portUuid"], also=["side"]),
    }


def _long(key: str, sql: str) -> str:
    """Every column of every row of a table as a row of its own."""
    spec = BY_KEY[key]
    cells = []
    for column in spec.columns:
        if column not in ("_id", "dealTime"):
            is_text = column in spec.keys or column == "timeType"
            text = f'"{column}"' if is_text else "null::varchar"
            number = "null::double" if is_text else f'"{column}"::double'
            cells.append(f"{{'column_name': '{column}', 'text': {text}, 'number': {number}}}")
    return (f"select '{spec.table}' as table_name, _id, dealTime, cell.column_name, cell.text,"
            f" cell.number from (select _id, dealTime, unnest([{', '.join(cells)}]) as cell"
            f" from ({sql}))")


def _all_long(tables: dict[str, str]) -> str:
    """All columns of all tables."""
    return " union all ".join(_long(key, sql) for key, sql in tables.items())


_SLOW = "case when e % 10 = 3 then 864000 else 0 end"
_TABLES = _tables()
_R5, _R9 = _TABLES["r05_cpe_pop"], _TABLES["r09_vpe_interface"]

# The flow topic's lines as records of two partitions: their offsets, the batches a capped reader
# makes of them, and whether a line comes after its window was closed.  A batch turns away what the
# watermark of the batch before had passed; between the two halves of the stream the watermark
# moves on in a batch without lines.
_RECORDS = """
records as (
  select *, row_number() over (partition by side order by c + {delay}, e) - 1 as off,
         count(*) over () // {parts} as cap
  from m where route = 7
), batches as (select *, off // cap as batch from records),
times as (select batch, max(c) as c from batches group by batch),
closed as (
  select b.batch, max(t.c) - 43200 as until from times b join times t
    on t.batch <= b.batch - case when b.batch = {restart} then 1 else 2 end group by b.batch),
told as (
  select batches.*, coalesce(w + 86400 <= until, false) as late
  from batches left join closed using (batch)),
ended as (select max(c) - 43200 as last from records)
"""


def _closing(sql: str, delay: str, parts: int, restart: int) -> str:
    """``sql`` over lines ``m`` for those alone that a window holds which has closed."""
    records = _RECORDS.format(delay=delay, parts=parts, restart=restart)
    own = " from told, ended where not late and w + 86400 <= last and "
    return sql.replace(" from m where ", own).replace(_TELEMETRY, f"{_TELEMETRY}, {records}", 1)


def _late_lines(delay: str, parts: int, restart: int) -> str:
    records = _RECORDS.format(delay=delay, parts=parts, restart=restart)
    return f"""
        select 'late', side::varchar, w * 1000, 'n_lines', null, count(*)::double
        from ({_TELEMETRY}, {records} select * from told where late) group by side, w"""


# The same for one arrival window, labelled by hand.
_ONE_WINDOW = _tables(window="1706745600", deal="1706745600000")


def _one_row_each(sql: str) -> str:
    """Of the rows of this roll-up that share a key, the one that the table keeps."""
    return f"""
        select * exclude (rn) from (
          select *, row_number() over (
                   partition by _id order by timestamp desc, peer desc, resourceLogo desc,
                   fabric desc) as rn
          from ({sql})) where rn = 1"""


def _one_result(program: str) -> str:
    specs = ROLLUPS if program == "all" else PROGRAMS[program]
    tables = {s.key: _ONE_WINDOW[s.key] for s in specs}
    if "r05_cpe_pop" in tables:
        tables["r05_cpe_pop"] = _one_row_each(tables["r05_cpe_pop"])
    return _all_long(tables)


ORACLE: dict[str, str] = _TABLES | {
    "op_route_counts": """
        with t as (
          select case when event_id % 11 < 4 then 'cpe' when event_id % 11 < 8 then 'vpe'
                      when event_id % 11 < 10 then 'switch' else 'sdwan' end as topic,
                 ['cpe', 'cpePopDelay', 'cepTunStats', 'cpePort', 'vpe', 'vpeDisk',
                  'vpeConnection', 'vpePort', 'switch', 'switchPort', 'vpeDelay'
                 ][event_id % 11 + 1] as resourceLogo
          from events)
        select topic, resourceLogo, count(*) as n_rows, cast(0 as bigint) as n_malformed
        from t group by topic, resourceLogo""",
    "op_cpe_flag_route": """
        select 'peer-' || (user_id % 5) as peer, count(*) as n_rows
        from events where event_id % 11 = 7 and user_id % 2 = 0 group by user_id % 5""",
    "op_quarantine": """
        select case when event_id % 11 < 4 then 'cpe' when event_id % 11 < 8 then 'vpe'
                    when event_id % 11 < 10 then 'switch' else 'sdwan' end as topic,
               count(*) as n_lines, count(*) as n_cut
        from events where event_id % 97 = 0 group by 1""",
    "op_after_quarantine": _delay(" and e % 97 <> 0"),
    "op_lenient_numbers": _R9,
    "op_bucket5": """
        select cast(floor(floor(epoch(ts)) / 300) as bigint) * 300000 as bucket,
               count(*) as n_events
        from events group by 1""",
    "op_bucket5_float32": """
        with t as (select cast(cast(floor(epoch(ts)) as float) as bigint) as c from events)
        select (c - c % 300) * 1000 as bucket, count(*) as n_events from t group by 1""",
    "op_doc_key_null": """
        with t as (
          select case when user_id % 7 = 0 then 'null' else cast(user_id % 7 as varchar) end
                 || '_' || case when user_id % 2 = 0 then 'eth0' else 'null' end
                 || '_' || (cast(floor(floor(epoch(ts)) / 86400) as bigint) * 86400000) as _id
          from events)
        select _id, count(*) as n_events from t group by _id""",
    "op_ratio_zero": f"""
        with t as (
          select user_id % 7 as device,
                 case when event_id % 3 <> 0 then (5000000.0::double - value * 10000)
                      / 5000000.0::double end as used
          from events)
        select device, {_r2('avg(used) * 100')} as diskUsedRate, count(used) as n_used,
               count(*) as n_all
        from t group by device""",
    "op_routed_archive": f"""
        select * from ({_R9}) where resourceUuid = 'dev-3'
          and dealTime >= 1704758400000 and dealTime < 1705622400000""",
    "op_routed_flag": _R5,
    "op_exact_means": f"""
        select user_id % 7 as device,
               cast(round(cast(sum((event_id % 3 - 1) * 51200000000000
                                   + cast(floor(value * 1024) as bigint))::double / 1024 / count(*)
                               as decimal(28,9)), 4) as double) as mean, {_r2('avg(value)')} as mean2
        from events group by user_id % 7""",
    "r09_at_300s": _flow(_PORT_KEYS, ["resourceUuid", "ifName"], window="(c - c % 300)"),
    "r09_by_arrival": _R9,
    "r06_float32": _rollup(
        _R6_KEYS, _R6_OUT, "route = 4", ["resourceUuid"],
        stamp="(cast(cast(avg(c) as float) as bigint)"
              " - cast(cast(avg(c) as float) as bigint) % 300) * 1000"),
    "op_upsert_merge": f"""
        select * replace (
               case when dealTime >= 1704758400000 then rxBytes end as rxBytes,
               case when dealTime >= 1704758400000 then txBytes end as txBytes)
        from ({_R9})""",
    "op_upsert_collisions": _one_row_each(_R5),
    "stream_arrival_rollup": _ONE_WINDOW["r10_vpe_peer_flow"],
    "all_tables_one_pass": _all_long(_TABLES),
    "op_replay_quarantine": _all_long({
        "r11_vpe_delay": _delay(" and e % 97 <> 0"),
        "r09_vpe_interface": _flow(_PORT_KEYS, ["resourceUuid", "ifName"],
                                   extra=" and e % 97 <> 0")}) + """
        union all
        select 'malformed', case when event_id % 11 < 8 then 'vpe' else 'sdwan' end, null,
               'n_lines', null, count(*)::double
        from events where event_id % 97 = 0 and event_id % 11 in (4, 5, 6, 7, 10) group by 2""",
    "stream_arrival_restart": _ONE_WINDOW["r10_vpe_peer_flow"],
    "stream_arrival_windows": _R9,
    "stream_event_rollup": _R9,
    "stream_event_late": _R9.replace(
        "cast(floor(epoch(ts)) as bigint) as c",
        "cast(floor(epoch(ts)) as bigint) + case when event_id = (select max(event_id)"
        " from events where event_id % 11 = 7) then 72000 else 0 end as c"),
    "stream_closed_windows": _long("r09_vpe_interface", _closing(_R9, _SLOW, 12, 3))
    + " union all " + _late_lines(_SLOW, 12, 3),
    "stream_delivered_twice": _closing(_R9, "0", 6, -1),
    "stream_document_store": f"""
        select * from ({_closing(_R9, "0", 6, -1)})
        union all by name
        select * replace (null::double as rxBytes, null::double as txBytes) from ({_R9})
        where resourceUuid = 'dev-0'
          and _id not in (select _id from ({_closing(_R9, "0", 6, -1)}))""",
    "op_offset_range": f"""
        {_TELEMETRY}, {_RECORDS.format(delay="0", parts=6, restart=-1)}
        select 'vpe' as topic, side::integer as partition, count(*) as n_lines,
               min(off) as first_offset, max(off) as last_offset,
               sum(e * 1500)::bigint as rx_bytes
        from records where off >= 10 and off < 40 group by side""",
} | {
    name: _one_result(program) for name, program in (
        ("stream_program", "vpe"), ("stream_program_cpe", "cpe"), ("stream_program_ce", "ce"),
        ("stream_program_all", "all"))
}

ORACLE["op_document_upsert"] = ORACLE["op_upsert_merge"]
ORACLE["op_array_lines"] = (
    "select topic, resourceLogo, n_rows * 2 as n_rows, n_malformed"
    f" from ({ORACLE['op_route_counts']})"
)
