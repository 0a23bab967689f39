"""Raw CSV extracts. Declared schemas save the inference scan; bad rows fail the read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martloom import schemas


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # check the header against the schema
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TRANSACTIONS)


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.STORES)


def read_budget(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.BUDGET)
