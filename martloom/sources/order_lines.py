"""Order-line tables (lineitem, orders, part, supplier, nation) seen as retail extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize
from martloom.rules import Rules

# Order priorities play the channels; these two count as physical. Median prices lie
# close together, so the band thresholds are narrower than the retail defaults.
ORDER_RULES = Rules(
    premium_from=2090, mid_from=2075, physical_channels=("1-URGENT", "2-HIGH")
)


# Declared, so that no query spends a job on reading footers.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "part": "p_partkey bigint, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

# A part's unit cost in percent of its net price: this much, and one more per unit of size.
BASE_COST_PCT = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _scaled(units: Column, digits: int, kind: str) -> Column:
    """Whole units of 10**-digits as DECIMAL. A cast from DOUBLE would print and parse text."""
    unit = F.lit(f"{10.0**-digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return (units.cast("decimal(18,0)") * unit).cast(kind)


def _percent_of(cents: Column, pct: Column) -> Column:
    """``cents * pct / 100``, rounded half up, in whole-number arithmetic."""
    return F.floor((cents * pct + 50) / 100)


# The parts of a printed transaction id, in its order; the day of shipping comes last.
KEY_PARTS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _keyed_lines(
    spark: SparkSession,
    sf_dir: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """The transactions without their printed ids. What a line alone decides is computed before
    the joins, so that narrow values are moved. ``shuffled`` plans the join of lines and orders
    alike at every size."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    parts = _table(spark, sf_dir, "part")
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since))
    if until is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(until))

    gross = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    discount = F.rint(F.col("l_discount") * 100).cast("bigint")
    unit_cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5)
    lines = lines.select(
        *KEY_PARTS,
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _scaled(unit_cents, 2, "decimal(18,2)").alias("unit_price"),
        _scaled(F.rint(F.abs("l_discount") * 10000), 4, "decimal(5,4)").alias("discount_pct"),
        _percent_of(gross, 100 - discount).alias("net_cents"),
    )
    priced = lines.join(
        orders.hint("merge") if shuffled else orders, F.col("l_orderkey") == F.col("o_orderkey")
    ).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    net, cost_pct = F.col("net_cents"), F.col("p_size") + BASE_COST_PCT
    return priced.select(
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("l_suppkey").alias("store_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_type").alias("category"),
        F.col("o_orderpriority").alias("channel"),
        "quantity",
        "unit_price",
        "discount_pct",
        _scaled(net, 2, "decimal(18,2)").alias("net_amount"),
        _scaled(_percent_of(net, cost_pct), 2, "decimal(18,2)").alias("cogs"),
        F.struct(*KEY_PARTS, "shipped").alias("transaction_key"),
    )


def _with_ids(keyed: DataFrame) -> DataFrame:
    shipped = F.col("transaction_key.shipped")
    day = F.year(shipped) * 10000 + F.month(shipped) * 100 + F.day(shipped)
    parts = [F.col(f"transaction_key.{part}") for part in KEY_PARTS]
    printed = F.concat_ws("-", *parts, day).alias("transaction_id")
    return keyed.select(printed, *keyed.columns)


def read_transactions(
    spark: SparkSession,
    sf_dir: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """One row per line item in the transactions layout, and ``transaction_key``, the parts of
    the printed ``transaction_id`` with their types: rows have equal keys where they have equal
    ids, and what only counts ids prints none.

    ``since`` (inclusive) and ``until`` (exclusive) reach the scan of ``orders``.
    """
    return _with_ids(_keyed_lines(spark, sf_dir, since, until))


def written_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of all lines, joined once and written, for work that passes over them several
    times. Ids are not written but printed by whoever reads them."""
    return _with_ids(materialize(_keyed_lines(spark, sf_dir, shuffled=True), "lines"))


def read_stores(spark: SparkSession, sf_dir: str, with_city: bool = True) -> DataFrame:
    """Suppliers as stores. Without the city this is a plain scan, whose size the optimizer
    knows; the size of a join it can only guess, as the product of both sides."""
    suppliers = _table(spark, sf_dir, "supplier")
    names = [F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name")]
    if not with_city:
        return suppliers.select(*names)
    nations = _table(spark, sf_dir, "nation")
    located = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return located.select(*names, F.col("n_name").alias("city"))
