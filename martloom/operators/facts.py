"""The fact table: transactions with category and channel replaced by their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.schemas import FACT_COLUMNS


def gross_margin() -> Column:
    return F.round(F.col("net_amount") - F.col("cogs"), 2).cast("decimal(18,2)").alias("gross_margin")


def fact_sales(transactions: DataFrame, categories: DataFrame, channels: DataFrame) -> DataFrame:
    """Look up surrogate keys. No broadcast hint: the dimensions come from written tables,
    so the optimizer knows their size and broadcasts them only while they are small."""
    return (
        transactions.join(categories.select("category", "category_id"), "category")
        .join(channels.select("channel", "channel_id"), "channel")
        .withColumnRenamed("transaction_date", "date_key")
        .withColumn("gross_margin", gross_margin())
        .select(*FACT_COLUMNS)
    )
