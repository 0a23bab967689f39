"""Declared schemas: raw extracts and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
SHARE = T.DecimalType(5, 4)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


TRANSACTIONS = _schema(
    ("transaction_id", T.StringType()),
    ("transaction_date", T.DateType()),
    ("store_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("category", T.StringType()),
    ("channel", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", MONEY),
    ("discount_pct", SHARE),
    ("net_amount", MONEY),
    ("cogs", MONEY),
)

STORES = _schema(
    ("store_id", T.StringType()),
    ("store_name", T.StringType()),
    ("city", T.StringType()),
)

BUDGET = _schema(
    ("fiscal_year", T.StringType()),
    ("month", T.IntegerType()),
    ("category", T.StringType()),
    ("budget_qty", T.LongType()),
    ("budget_price", MONEY),
    ("budget_revenue", MONEY),
)

# Column order of the stored tables and of the detail view.

DIM_DATE_COLUMNS = [
    "date_key", "year", "month", "month_name", "quarter", "day_of_week",
    "is_weekend", "fiscal_year", "fiscal_month", "season",
]

DIM_STORE_COLUMNS = ["store_id", "store_name", "city"]

FACT_COLUMNS = [
    "transaction_id", "date_key", "store_id", "category_id", "channel_id", "customer_id",
    "quantity", "unit_price", "discount_pct", "net_amount", "cogs", "gross_margin",
]

SALES_DETAIL_COLUMNS = [
    "transaction_id", "date_key", "year", "month", "month_name",
    "fiscal_year", "fiscal_month", "season", "is_weekend",
    "store_name", "category", "price_band", "channel", "is_physical",
    "customer_id", "quantity", "unit_price", "discount_pct",
    "net_amount", "cogs", "gross_margin",
]
