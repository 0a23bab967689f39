"""Distinct bills without moving their ids.

A line whose id hash no other line has is a bill of its own. So one narrow pass counts lines per
64-bit hash of the id; only lines under a hash that occurs again are looked at with their ids, be
it a repeated id or a clash of hashes. All other lines are counted like any rows, combined before
the shuffle. Where no hash repeats, no id is shuffled at all. The result is exact in every case.

Lines without an id are no bills. Lines may carry the typed parts of a printed id as
``transaction_key``; these are then hashed and compared, and no id is printed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize


def bill_id(lines: DataFrame) -> str:
    return "transaction_key" if "transaction_key" in lines.columns else "transaction_id"


def _hash(name: str) -> Column:
    return F.xxhash64(name)


def repeated_hashes(lines: DataFrame) -> DataFrame:
    """Hashes of ids that more than one line has, written: a few rows, or none."""
    name = bill_id(lines)
    hashes = lines.where(F.col(name).isNotNull()).select(_hash(name).alias("id_hash"))
    counted = hashes.groupBy("id_hash").agg(F.count("*").alias("lines"))
    return materialize(counted.where("lines > 1").select("id_hash"), "repeats")


def suspects(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """The lines whose id hash occurs again."""
    return lines.join(repeated, _hash(bill_id(lines)) == F.col("id_hash"), "left_semi")


def surplus(name: str) -> Column:
    """Lines beyond one per id."""
    return F.count(name) - F.count_distinct(name)


def repeats(lines: DataFrame) -> DataFrame:
    """One row ``repeats``: lines beyond one per id."""
    name = bill_id(lines)
    return suspects(lines.select(name), repeated_hashes(lines)).agg(surplus(name).alias("repeats"))


def with_bills(
    lines: DataFrame,
    keys: Sequence[Column | str],
    sums: Sequence[Column],
    unique_ids: bool = False,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """``lines`` grouped by ``keys``, with ``sums`` and the number of distinct ``bills``.

    ``unique_ids`` says that every line is known to have an id of its own (see
    ``warehouse.save``): the narrow pass is then not needed, nor are the ids. ``repeated`` are the
    :func:`repeated_hashes` of these lines, where they are known already.
    """
    name = bill_id(lines)
    one_each = F.count("*") if unique_ids else F.count(name)
    counted = lines.groupBy(*keys).agg(one_each.alias("bills"), *sums)
    if unique_ids:
        return counted
    if repeated is None:
        repeated = repeated_hashes(lines)
    if repeated.isEmpty():
        return counted
    more = suspects(lines, repeated).groupBy(*keys).agg(surplus(name).alias("_surplus"))
    groups = more.columns[:-1]
    more = more.withColumnsRenamed({c: f"_more_{c}" for c in groups})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_more_{c}")) for c in groups])
    exact = F.col("bills") - F.coalesce("_surplus", F.lit(0))
    return counted.join(more, same, "left").withColumn("bills", exact).select(*counted.columns)
