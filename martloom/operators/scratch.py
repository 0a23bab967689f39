"""Scratch tables: cut lineage by writing a small Parquet table to the shared folder.

A written table survives lost executors, is scanned column by column, and gives the
optimizer a true size, so a later join is broadcast only when the table really is small.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[tuple[SparkSession, str]]] = []


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where a session sets none, a folder of the warehouse, which
    all executors share as well. Never a temporary folder of one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder; an open :func:`scope` empties it when it ends."""
    path = f"{scratch_root(spark)}/martloom-{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append((spark, path))
    return path


@contextmanager
def scope() -> Iterator[None]:
    """Empty the scratch tables made inside, so that a long session keeps none of them.

    For work that ends inside the scope: a lazy result that still reads a scratch table
    must not leave it. A path is emptied through Spark's own writer, whatever its store.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def distilled(build: Callable[[], DataFrame], label: str = "table") -> DataFrame:
    """Write what ``build`` gives, empty the scratch tables it made on the way, and return a scan
    of the written table."""
    spark = SparkSession.active()
    path = scratch_path(spark, label)  # belongs to the scope around, if there is one
    with scope():
        df = build()
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
