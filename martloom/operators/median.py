"""Exact medians from a value histogram, in bounded memory.

The built-in exact median keeps every distinct value of a group in one task. Here the
histogram is range sorted over the cluster by key and value; counting its partitions tells
which one or two hold a key's middle rows, and only those are read value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize


def histogram(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (keys, value); equal values collapse before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("rows"))


def exact_median(
    counts: DataFrame, value: str, keys: Sequence[str] = (), out: str = "median"
) -> DataFrame:
    """Median per key as DOUBLE; the mean of the two middle values when the count is even.

    ``counts`` comes from :func:`histogram`. No task sees more than one range partition of it,
    or the list of a key's partitions.
    """
    keys = list(keys)
    values = counts.select(*keys, F.col(value).cast("double").alias("_v"), "rows")
    ranged = values.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
    placed = materialize(ranged, "values")
    running = Window.partitionBy(*keys).orderBy("_part")  # a key's partitions
    parts = (
        placed.groupBy(*keys, "_part")
        .agg(F.sum("rows").alias("_rows"))
        .withColumn("_until", F.sum("_rows").over(running))
        .withColumn("_n", F.sum("_rows").over(Window.partitionBy(*keys)))
        .where(_holds_middle(F.col("_until"), F.col("_rows"), F.col("_n")))
        .select(*keys, "_part", (F.col("_until") - F.col("_rows")).alias("_skipped"), "_n")
    )
    running = Window.partitionBy(*keys, "_part").orderBy("_v")
    middle = (
        placed.join(parts, [*keys, "_part"])
        .withColumn("_until", F.col("_skipped") + F.sum("rows").over(running))
        .where(_holds_middle(F.col("_until"), F.col("rows"), F.col("_n")))
    )
    return middle.groupBy(*keys).agg(F.avg("_v").alias(out))


def _holds_middle(until: Column, rows: Column, total: Column) -> Column:
    """True when ranks ``until - rows + 1 .. until`` include one of the two middle ranks."""
    lower = F.floor((total + 1) / 2)
    upper = F.floor(total / 2) + 1
    return (until >= lower) & (until - rows < upper)
