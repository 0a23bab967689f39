"""Put group totals, or one global total, next to every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def attach(df: DataFrame, totals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Join per-key totals; without keys, read the one-row total as scalar subqueries."""
    if keys:
        return df.join(totals, list(keys))
    return df.withColumns({c: totals.select(c).scalar() for c in totals.columns})
