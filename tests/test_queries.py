"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = "region nation customer supplier part orders lineitem".split()
OPTIONAL = entry_module.llm.queries() if entry_module.llm else {}  # tested in their own folder
QUERIES = {k: v for k, v in entry_module.queries().items() if k not in OPTIONAL}
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k not in OPTIONAL}
SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(row):
    return tuple((value is None, "" if value is None else value) for value in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, db, name):
    got = QUERIES[name](spark, sf_dir)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    expected = db.sql(ORACLE[name])
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: SQL_TYPES[t] for c, t in got.dtypes} == kinds
    columns = sorted(got.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    want = db.sql(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall()
    rows = [tuple(row) for row in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(rows, key=_sortable) == sorted(want, key=_sortable)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_run_summary_nests_bridge_and_backtest(spark, sf_dir):
    (row,) = entry_module._run_summary(spark, sf_dir).collect()
    assert row.fiscal_year == entry_module.FISCAL_YEAR
    assert [step.kind for step in row.bridge] == ["total", "delta", "delta", "delta", "total"]
    (plain,) = QUERIES["forecast_backtest"](spark, sf_dir).collect()
    assert row.backtest.asDict().items() <= plain.asDict().items()


def test_bills_are_rows_where_the_grain_check_allows(spark, sf_dir):
    """The honest count shuffles the ids; the stored result of the check saves that."""
    honest = QUERIES["monthly_grain"](spark, sf_dir)._jdf.queryExecution().toString()
    stored = QUERIES["monthly_grain_stored"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "transaction_id" in honest
    assert "transaction_id" not in stored.split("== Physical Plan ==")[1]


def test_contract_report_reads_the_fact_three_times(spark, sf_dir):
    stored = entry_module._stored(spark, sf_dir)
    report = entry_module.contracts.contract_report(
        stored.tables(), entry_module.ORDER_RULES, stored.extract_rows
    )
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [transaction_id" in line]
    assert len(scans) == 2  # ids and customers; its cells were read once and written


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_the_fiscal_year_reaches_the_scan(spark, sf_dir):
    plan = QUERIES["actuals_by_category"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate,1999-04-01" in plan
    assert "l_tax" not in plan.split("== Optimized Logical Plan ==")[1].split("ReadSchema", 1)[1]
