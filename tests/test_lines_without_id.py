"""Bills are rows only where every line is known to have an id of its own."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from martloom.operators import bills
from martloom.plans import warehouse


def test_a_line_without_id_keeps_the_honest_count(spark, sf_dir, tmp_path):
    built = entry_module._built(spark, sf_dir)
    first = built.fact_sales.agg(F.min("transaction_id")).first()[0]
    hole = F.when(F.col("transaction_id") != first, F.col("transaction_id"))
    holed = dataclasses.replace(built, fact_sales=built.fact_sales.withColumn("transaction_id", hole))
    for star, unique in ((built, True), (holed, False)):
        folder = str(tmp_path / str(unique))
        assert warehouse.save(star, folder).unique_ids is unique
        assert warehouse.load(spark, folder).unique_ids is unique


def test_unique_ids_are_not_read(spark):
    lines = spark.range(5).select(F.col("id").cast("string").alias("transaction_id"), F.lit("a").alias("shop"))
    counted = bills.with_bills(lines, ["shop"], [], unique_ids=True)
    assert [tuple(r) for r in counted.collect()] == [("a", 5)]
    assert "transaction_id" not in counted._jdf.queryExecution().optimizedPlan().toString()
