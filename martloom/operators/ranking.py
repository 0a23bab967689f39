"""Exact global ranks, quintiles and n-tiles at any size.

A window without partition keys sends every row through one task. Here the rows are range
sorted across the cluster instead: each row notes the partition and position it landed on,
and the partition sizes (one row per partition) turn positions into ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row position below


def with_global_ranks(
    table: DataFrame, orders: Mapping[str, Sequence[Column]], total: str = "total"
) -> DataFrame:
    """Add a 1-based rank column per entry of ``orders``, and the row count as ``total``.

    Each order must end in a unique key, so that ranks are defined for ties as well.
    ``table`` is read by the sort and by its sampling: pass a written table.
    """
    for name, order in orders.items():
        table = _rank_by_range_sort(table.drop(total), order, name, total)
    return table


def _rank_by_range_sort(
    df: DataFrame, order: Sequence[Column], rank: str, total: str
) -> DataFrame:
    placed = materialize(
        df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "ranked"
    )
    slot = F.col("_slot")
    part = F.shiftright(slot, _POSITION_BITS).alias("_part")
    position = slot.bitwiseAND((1 << _POSITION_BITS) - 1)

    # One row per sort partition: at most spark.sql.shuffle.partitions rows.
    sizes = placed.groupBy(part).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias(total),
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + position + 1)
        .drop("_slot", "_part", "_before")
    )


def ntile_of(rank: Column, total: Column, tiles: int) -> Column:
    """The tile SQL NTILE would give: the first ``total % tiles`` tiles hold one row more."""
    quotient = F.floor(total / tiles)
    larger = total % tiles
    in_larger = larger * (quotient + 1)
    return (
        F.when(rank <= in_larger, F.floor((rank - 1) / (quotient + 1)) + 1)
        .otherwise(larger + F.floor((rank - 1 - in_larger) / F.greatest(quotient, F.lit(1))) + 1)
        .cast("int")
    )


def quantile_score(rank: Column, total: Column, bins: int = 5) -> Column:
    """Score 1..bins by equal-width quantiles of the ranks (not NTILE, whose bins differ)."""
    gaps = F.greatest(total - 1, F.lit(1))
    return F.greatest(F.lit(1), F.ceil((rank - 1) * bins / gaps)).cast("int")
