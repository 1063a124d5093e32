"""Every registered query against its SQL on the smallest sample."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_point

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "-"
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_of_telemetry_has_sql():
    more = set(entry_point.llm.QUERIES) if entry_point.llm else set()
    assert set(ORACLE) <= set(QUERIES) and set(QUERIES) - set(ORACLE) <= more


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    want = duck.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.columns, df.collect()) == normal(names, want.fetchall())


def test_flagship(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and df.columns[:5] == [
        "resourceUuid", "resourceLogo", "fabric", "host", "ifName"]
