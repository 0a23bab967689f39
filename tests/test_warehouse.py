"""CSV in, stored star schema, contracts, exports."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import FISCAL_YEAR, _plan, _sales
from martloom import schemas
from martloom.__main__ import main, run_all
from martloom.operators import contracts
from martloom.plans import views, warehouse
from martloom.sources import extracts, order_lines
from martloom.sources.order_lines import ORDER_RULES


@pytest.fixture(scope="module")
def data_dir(spark, sf_dir, tmp_path_factory):
    """The order lines as the three CSV extracts."""
    folder = tmp_path_factory.mktemp("extracts")
    frames = {
        "transactions": order_lines.read_transactions(spark, sf_dir).drop("transaction_key"),
        "stores": order_lines.read_stores(spark, sf_dir),
        "budget": _plan(spark, sf_dir),
    }
    for name, frame in frames.items():
        frame.coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")
    return str(folder)


@pytest.fixture(scope="module")
def store_dir(spark, data_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("store"))
    warehouse.save(warehouse.build_from_csv(spark, data_dir, ORDER_RULES), out)
    return out


@pytest.fixture(scope="module")
def stored(spark, store_dir):
    return warehouse.load(spark, store_dir)


def test_csv_has_the_declared_types(spark, data_dir):
    tx = extracts.read_transactions(spark, f"{data_dir}/transactions.csv")
    assert tx.schema == schemas.TRANSACTIONS
    assert extracts.read_budget(spark, f"{data_dir}/budget.csv").schema == schemas.BUDGET


def test_a_bad_row_fails_the_read(spark, tmp_path):
    (tmp_path / "budget.csv").write_text(
        "fiscal_year,month,category,budget_qty,budget_price,budget_revenue\nFY2025-26,x,A,1,1,1\n"
    )
    with pytest.raises(Exception, match="(?i)malformed|failed"):
        extracts.read_budget(spark, str(tmp_path / "budget.csv")).collect()


def test_stored_columns(stored):
    assert [c for c in stored.fact_sales.columns if c != "year_month"] == schemas.FACT_COLUMNS
    assert stored.dim_category.columns == ["category_id", "category", "price_band"]
    assert stored.dim_channel.columns == ["channel_id", "channel", "is_physical"]
    assert views.sales_detail(stored).columns == schemas.SALES_DETAIL_COLUMNS
    assert dict(stored.fact_sales.dtypes)["year_month"] == "string"


def test_star_join_equals_flat_sales(spark, sf_dir, stored):
    shared = ["date_key", "store_name", "category", "channel", "quantity", "net_amount", "gross_margin"]
    star = views.sales_detail(stored).select("transaction_id", *shared)
    flat = _sales(spark, sf_dir).select("transaction_id", *shared)
    assert star.exceptAll(flat).isEmpty() and flat.exceptAll(star).isEmpty()


def test_stored_customers_match_the_transactions(spark, data_dir, stored):
    tx = extracts.read_transactions(spark, f"{data_dir}/transactions.csv")
    value = stored.dim_customer.agg(F.sum("lifetime_value"), F.sum("lifetime_orders")).first()
    assert tuple(value) == tuple(tx.agg(F.sum("net_amount"), F.count("*")).first())


def test_a_calendar_filter_prunes_folders(stored):
    one_year = views.sales_detail(stored).where(F.col("fiscal_year") == FISCAL_YEAR)
    plan = one_year.agg(F.sum("net_amount"))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_sound_warehouse_has_no_violations(stored):
    report = contracts.contract_report(stored.tables(), extract_rows=stored.extract_rows).collect()
    assert len(report) == 46 and len({row.check for row in report}) == 46
    assert all(row.violations == 0 for row in report)


def test_contracts_count_what_is_wrong(spark, stored):
    fact = stored.fact_sales.drop("year_month")
    bad = fact.limit(3).withColumns(
        {
            "store_id": F.lit("nowhere"),
            "quantity": F.lit(0),
            "discount_pct": F.lit("1.0").cast("decimal(5,4)"),
            "cogs": F.lit(None).cast("decimal(18,2)"),
        }
    )
    broken_fact = fact.unionByName(bad)
    lines = {r.check: r.violations for r in contracts.line_checks(contracts.star_cells(broken_fact)).collect()}
    assert lines["fact_sales.quantity <= 0"] == 3
    assert lines["fact_sales.discount_pct outside [0, 1)"] == 3
    assert lines["fact_sales.cogs is null"] == 3
    assert lines["fact_sales.net_amount <= 0"] == 0
    (grain,) = contracts.grain_check(broken_fact).collect()
    assert grain.violations == 3
    tables = stored.tables() | {
        "fact_sales": broken_fact,
        "dim_channel": stored.dim_channel.unionByName(stored.dim_channel.limit(1)),
    }
    orphans = {r.check: r.violations for r in contracts.orphan_checks(tables).collect()}
    assert orphans["fact_sales.store_id not in dim_store"] == 3
    assert orphans["fact_sales.date_key not in dim_date"] == 0
    found = {r.check: r.violations for r in contracts.table_checks(tables).collect()}
    assert found["dim_channel key repeats"] == 1 and found["dim_channel.channel repeats"] == 1
    assert found["budget key repeats"] == found["dim_store has a null"] == 0
    budget = spark.createDataFrame([(0, Decimal(5))], "budget_qty int, budget_revenue decimal(9,2)")
    assert contracts.budget_checks(budget).first().violations == 1


def test_a_line_without_a_category_is_reported(spark, data_dir):
    tx = extracts.read_transactions(spark, f"{data_dir}/transactions.csv")
    holes = tx.limit(2).withColumn("category", F.lit(None).cast("string"))
    report = contracts.extract_checks(tx.unionByName(holes)).where("violations > 0").collect()
    assert [tuple(row) for row in report] == [("transactions.category is null", 2)]


def test_orphans_drop_out_of_the_star_join(stored):
    stray = stored.fact_sales.limit(2).withColumn("store_id", F.lit("nowhere"))
    wider = replace(stored, fact_sales=stored.fact_sales.unionByName(stray))
    assert views.sales_detail(wider).count() == stored.fact_sales.count()


def test_the_date_dimension_has_no_gaps(stored):
    row = stored.dim_date.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert (row[1] - row[0]).days + 1 == row[2]
    assert row[0] == dt.date(1995, 1, 1)


def _holes(spark, data_dir, folder):
    """Extracts of which one line has no category, one no channel and one an unknown store."""
    tx = extracts.read_transactions(spark, f"{data_dir}/transactions.csv")
    blank = {"category": {"category": None}, "channel": {"channel": None}, "shop": {"store_id": "?"}}
    bad = [
        tx.limit(1).withColumns(
            {"transaction_id": F.lit(f"bad-{name}")}
            | {c: F.lit(v).cast("string") for c, v in change.items()}
        )
        for name, change in blank.items()
    ]
    for part in bad:
        tx = tx.unionByName(part)
    tx.coalesce(1).write.option("header", True).csv(f"{folder}/transactions.csv")
    for name in ("stores", "budget"):
        spark.read.option("header", True).csv(f"{data_dir}/{name}.csv").coalesce(1).write.option(
            "header", True
        ).csv(f"{folder}/{name}.csv")


def test_lost_lines_are_counted(spark, data_dir, tmp_path):
    _holes(spark, data_dir, str(tmp_path / "in"))
    built = warehouse.build_from_csv(spark, str(tmp_path / "in"), ORDER_RULES)
    saved = warehouse.save(built, str(tmp_path / "store"))
    report = contracts.contract_report(saved.tables(), ORDER_RULES, saved.extract_rows)
    found = {r.check: r.violations for r in report.where("violations > 0").collect()}
    assert found.pop("transactions not in fact_sales") == 2
    assert found.pop("fact_sales.store_id not in dim_store") == 1
    assert set(found) <= {"monthly_kpi revenue differs from fact_sales"}
    assert saved.dim_channel.where("channel is null").isEmpty()
    before, after = built.dim_customer.collect(), saved.dim_customer.collect()
    assert sorted(map(str, before)) == sorted(map(str, after))


def test_the_product_run_stops_on_violations(spark, data_dir, tmp_path):
    _holes(spark, data_dir, str(tmp_path / "in"))
    asked = ["--data", str(tmp_path / "in"), "--out", str(tmp_path / "out")]
    asked += ["--fiscal-year", FISCAL_YEAR]
    with pytest.raises(SystemExit, match="transactions not in fact_sales: 2"):
        main(asked)
    report = spark.read.option("header", True).csv(f"{tmp_path}/out/contracts")
    assert report.where("violations > 0").count() >= 4
    assert warehouse.load(spark, f"{tmp_path}/out/warehouse") is None
    main([*asked, "--allow-violations"])
    assert warehouse.load(spark, f"{tmp_path}/out/warehouse").extract_rows > 0
    assert Path(tmp_path, "out/summary").exists()


def test_a_refresh_that_stops_changes_nothing(spark, stored, store_dir, monkeypatch):
    before = warehouse.load(spark, store_dir)
    written = []
    real = warehouse._write

    def stops(table, name, out_dir, fmt):
        if len(written) == 3:
            raise RuntimeError("stopped")
        written.append(name)
        return real(table, name, out_dir, fmt)

    monkeypatch.setattr(warehouse, "_write", stops)
    with pytest.raises(RuntimeError):
        warehouse.save(replace(stored, dim_category=stored.dim_category.limit(1)), store_dir)
    after = warehouse.load(spark, store_dir)
    assert after.version == before.version
    assert after.dim_category.count() == before.dim_category.count() > 1


def test_the_last_version_counts(spark, stored, tmp_path):
    few = replace(stored, fact_sales=stored.fact_sales.limit(5).drop("year_month"))
    few = replace(few, dim_date=stored.dim_date.drop("year_month"))
    first = warehouse.save(few, str(tmp_path))
    doubled = replace(few, fact_sales=few.fact_sales.unionByName(few.fact_sales))
    warehouse.save(doubled, str(tmp_path))
    last = warehouse.load(spark, str(tmp_path))
    assert first.unique_ids and not last.unique_ids
    assert last.number == 2 and last.fact_sales.count() == 10
    assert warehouse.load(spark, str(tmp_path / "nothing")) is None


def test_views_answer_sql(spark, stored):
    names = views.register(stored, ORDER_RULES)
    assert len(names) == 11
    fact = spark.sql("SELECT ROUND(SUM(net_amount), 2) AS r FROM fact_sales").first().r
    kpi = spark.sql("SELECT ROUND(SUM(revenue), 2) AS r FROM v_monthly_kpi").first().r
    deciles = spark.sql("SELECT SUM(revenue) AS r FROM v_customer_concentration").first().r
    assert fact == kpi == deciles
    shares = spark.sql("SELECT SUM(pct_of_revenue) AS s FROM v_channel_mix GROUP BY fiscal_year")
    assert all(abs(row.s - 100) < 0.1 for row in shares.collect())


def test_unknown_format_is_refused(stored, tmp_path):
    with pytest.raises(ValueError, match="format"):
        warehouse.save(stored, str(tmp_path), "orc")


def test_all_outputs(spark, stored, tmp_path):
    out = str(tmp_path)
    run_all(stored, out, FISCAL_YEAR)
    expected = [
        "variance_by_category", "variance_bridge", "rfm_customers", "rfm_segments", "forecast",
        "powerbi/v_monthly_kpi", "powerbi/v_channel_mix", "powerbi/v_customer_concentration",
        "powerbi/fact_monthly_grain",
    ]
    for name in expected:
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() > 0
    (part,) = Path(out, "summary").glob("part-*.json")
    document = json.loads(part.read_text())
    assert document["fiscal_year"] == FISCAL_YEAR
    assert [step["kind"] for step in document["bridge"]][0] == "total"
    assert set(document["backtest"]) >= {"model_mape_pct", "seasonal_naive_mape_pct", "verdict"}


def test_measures_of_the_write_equal_a_scan(spark, stored, tmp_path):
    fact = stored.fact_sales.drop("year_month")
    broken = fact.limit(4).withColumns(
        {"quantity": F.lit(0), "cogs": F.lit(None).cast("decimal(18,2)")}
    )
    few = replace(
        stored,
        fact_sales=fact.unionByName(broken),
        dim_date=stored.dim_date.drop("year_month"),
        extract_rows=fact.count() + 7,
    )
    warehouse.save(few, str(tmp_path))
    saved = warehouse.load(spark, str(tmp_path))
    assert saved.observed["fact_sales.quantity <= 0"] == 4
    assert saved.observed["fact_sales.cogs is null"] == 4
    totals = warehouse.stored_totals(saved)
    assert totals.collect() == warehouse.load_totals(saved.fact_sales).collect()
    assert "FileScan" not in totals._jdf.queryExecution().executedPlan().toString()

    def report(observed):
        made = contracts.contract_report(saved.tables(), ORDER_RULES, saved.extract_rows, observed)
        return {row.check: row.violations for row in made.collect()}

    found = report(saved.observed)
    assert found == report(None)
    assert found["transactions not in fact_sales"] == 3


def test_measures_of_an_empty_fact(stored, tmp_path):
    empty = replace(
        stored,
        fact_sales=stored.fact_sales.drop("year_month").limit(0),
        dim_date=stored.dim_date.drop("year_month"),
    )
    saved = warehouse.save(empty, str(tmp_path))
    assert warehouse.stored_totals(saved).first().fact_rows == 0


def test_a_version_without_measures_is_counted(stored):
    old = replace(stored, observed=None)
    assert warehouse.stored_totals(old).first().fact_rows == stored.fact_sales.count() > 0
