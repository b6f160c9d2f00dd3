"""Every query against its plain SQL on DuckDB."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{SF_DIR}/{name}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [[plain(row[i]) for i in order] for row in rows]
    return sorted(columns), sorted(cells, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = table(df.columns, df.collect())
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [c[0] for c in result.description]
        assert got == table(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_known_confusion_counts(spark):
    """Counts at sf0.01 that were worked out by hand-written SQL in both engines before any code."""
    from corpuslens.fixtures import Inputs
    from corpuslens.plans.slices import test_rows

    i = Inputs(spark, "/root/testdata/sf0.01")
    expected = {0: (1053, 185, 340, 362, 166), 1: (1092, 186, 354, 369, 183)}
    for stype, counts in expected.items():
        rows = test_rows(i.model_analysis_rpts, i.ds_metadata, stype)
        got = rows.selectExpr("count(*)", "sum(tp)", "sum(fp)", "sum(tn)", "sum(fn)").first()
        assert tuple(got) == counts


def test_surrogate_keys_number_what_was_not_loaded(spark, monkeypatch):
    from corpuslens import fixtures

    monkeypatch.setitem(fixtures.SQL, "loaded_claims", "select * from {wp_statements} where sid % 5 = 0")
    got = [r["source_sid"] for r in entry.queries()["s14_surrogate_keys"](spark, SF_DIR).collect()]
    sids = [r["sid"] for r in fixtures.Inputs(spark, SF_DIR).wp_statements.select("sid").collect()]
    assert sorted(got) == sorted(s for s in sids if s % 5)
