"""Tiles and quantile scores from a few boundary rows, without ranking the others.

Who belongs to which fifth depends on four rows only: the last of each fifth. These are found by
selection. A bounded sample of the rows that may still hold a boundary proposes two rows around
it, an exact count of the rows on both sides says which part holds it, and so on until that part
is small enough to be sorted as one list. Every row then finds its tile by comparison. Rows are
neither sorted nor shuffled nor written again; all boundaries of all orders share each scan.

Orders are ascending with NULL first, and end in a unique key, so that every tile is defined for
ties as well. Counts are exact and the proposals only decide how fast the search narrows, so
results do not depend on the sample. An empty table has no boundaries and no rows to score.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

LEAF = 1 << 14  # rows that are sorted as one list
LEAST_LEAF = 32  # in a list of fewer rows the margin around a boundary covers all of them
SAMPLE = 1 << 14  # expected rows of the sample that proposes where to split

Key = tuple[Any, ...]


class Bound(NamedTuple):
    key: Key
    included: bool


class Bracket(NamedTuple):
    """The rows between two bounds (None: no bound), and how many come before them."""

    lower: Bound | None
    upper: Bound | None
    before: int
    rows: int


class _Order(NamedTuple):
    columns: list[Column]
    types: list[DataType]

    def upto(self, bound: Bound) -> Column:
        """Whether a row comes before the bound; NULL is the least value of a column."""
        result = F.lit(bound.included)
        parts = list(zip(self.columns, self.types, bound.key, strict=True))
        for column, kind, value in reversed(parts):
            if value is None:
                result = column.isNull() & result
            else:
                limit = F.lit(value).cast(kind)
                less = column.isNull() | (column < limit)
                result = less | (column.eqNullSafe(limit) & result)
        return result

    def inside(self, bracket: Bracket) -> Column:
        result = F.lit(True)
        if bracket.lower is not None:
            key, included = bracket.lower
            result = result & ~self.upto(Bound(key, not included))
        if bracket.upper is not None:
            result = result & self.upto(bracket.upper)
        return result


def _order(table: DataFrame, columns: Sequence[Column]) -> _Order:
    return _Order(list(columns), [f.dataType for f in table.select(*columns).schema.fields])


def _keys(
    table: DataFrame, orders: Mapping[str, Sequence[Column]]
) -> tuple[DataFrame, dict[str, _Order]]:
    """The columns of all orders, and nothing else, under names of their own."""
    named = {
        name: {f"k{i}_{j}": column for j, column in enumerate(order)}
        for i, (name, order) in enumerate(orders.items())
    }
    keys = table.select(*[c.alias(k) for order in named.values() for k, c in order.items()])
    return keys, {name: _order(keys, [F.col(k) for k in own]) for name, own in named.items()}


def rows_at(
    table: DataFrame,
    orders: Mapping[str, Sequence[Column]],
    ranks: Callable[[int], Sequence[int]],
    leaf: int = LEAF,
    sample: int = SAMPLE,
) -> dict[str, list[Key]]:
    """The keys at the given 1-based ranks of every order; ``ranks`` gets the number of rows.

    ``table`` is scanned once for the row count, once for the last lists and twice for each
    narrowing, which keeps about ``3 / sqrt(sample)`` of a bracket: pass a written table.
    """
    if leaf < LEAST_LEAF:
        raise ValueError(f"a leaf of {leaf} rows could never be reached: {LEAST_LEAF} or more")
    rows = table.count()
    wanted = list(ranks(rows)) if rows else []
    keys, columns = _keys(table, orders)
    whole = Bracket(None, None, 0, rows)
    searched = {(name, rank): whole for name in orders for rank in wanted}
    found: dict[tuple[str, int], Key] = {}
    attempt = 0
    while searched:
        attempt += 1
        proposed = _propose(keys, columns, searched, leaf, sample, attempt)
        narrowed = {}
        for target, (first, last) in proposed.items():
            if first == last and searched[target].rows <= leaf:
                found[target] = first
            elif first is not None:  # an empty sample proposes nothing: draw again
                narrowed[target] = (first, last)
        counted = _count(keys, columns, searched, narrowed)
        for target, bracket in counted.items():
            searched[target] = bracket
            if bracket.lower and bracket.upper and bracket.lower == bracket.upper:
                found[target] = bracket.lower.key
        searched = {target: b for target, b in searched.items() if target not in found}
    return {name: [found[name, rank] for rank in wanted] for name in orders}


Targets = Mapping[tuple[str, int], Bracket]


def _propose(
    keys: DataFrame,
    columns: Mapping[str, _Order],
    searched: Targets,
    leaf: int,
    sample: int,
    seed: int,
) -> dict[tuple[str, int], tuple[Key | None, Key | None]]:
    """The row itself, twice, from the sorted list of a small bracket; from the sample of a large
    one a row likely before it and one likely after it."""
    brackets = list(dict.fromkeys((name, b) for (name, _), b in searched.items()))
    lists, list_of = [], {}
    for i, (name, bracket) in enumerate(brackets):
        keep = columns[name].inside(bracket)
        if bracket.rows > leaf:
            keep = keep & (F.col("draw") < sample / bracket.rows)
        row = F.struct(*columns[name].columns)
        lists.append(F.sort_array(F.collect_list(F.when(keep, row))).alias(f"l{i}"))
        list_of[name, bracket] = f"l{i}"
    sorted_lists = keys.withColumn("draw", F.rand(seed)).agg(*lists)

    picks = []
    for i, ((name, rank), bracket) in enumerate(searched.items()):
        items = F.col(list_of[name, bracket])
        if bracket.rows <= leaf:
            first = last = F.lit(rank - bracket.before)
        else:
            drawn = F.size(items)
            middle = drawn * ((rank - bracket.before) / bracket.rows)
            margin = F.sqrt(drawn) * 1.5  # three standard errors at the middle
            first = F.greatest(F.floor(middle - margin), F.lit(1)).cast("int")
            last = F.least(F.ceil(middle + margin), drawn).cast("int")
        picks += [F.get(items, first - 1).alias(f"a{i}"), F.get(items, last - 1).alias(f"b{i}")]
    row = sorted_lists.select(*picks).first()
    pairs = [(row[f"a{i}"], row[f"b{i}"]) for i in range(len(searched))]
    return {
        target: (None if a is None else tuple(a), None if b is None else tuple(b))
        for target, (a, b) in zip(searched, pairs, strict=True)
    }


def _count(
    keys: DataFrame,
    columns: Mapping[str, _Order],
    searched: Targets,
    proposed: Mapping[tuple[str, int], tuple[Key, Key]],
) -> dict[tuple[str, int], Bracket]:
    """The part of each bracket that holds its row: before, between or after the proposed ones."""
    if not proposed:
        return {}
    counts = []
    for i, (target, (first, last)) in enumerate(proposed.items()):
        order, bracket = columns[target[0]], searched[target]
        lower = order.inside(bracket) & order.upto(Bound(first, False))
        middle = order.inside(Bracket(Bound(first, True), Bound(last, True), 0, 0))
        counts += [F.count_if(lower).alias(f"a{i}"), F.count_if(middle).alias(f"b{i}")]
    row = keys.agg(*counts).first()
    parts = {}
    for i, (target, (first, last)) in enumerate(proposed.items()):
        bracket, n_lower, n_middle = searched[target], row[f"a{i}"], row[f"b{i}"]
        upto_lower = bracket.before + n_lower
        upto_middle = upto_lower + n_middle
        if target[1] <= upto_lower:
            parts[target] = Bracket(
                bracket.lower, Bound(first, False), bracket.before, n_lower
            )
        elif target[1] <= upto_middle:
            parts[target] = Bracket(Bound(first, True), Bound(last, True), upto_lower, n_middle)
        else:
            rest = bracket.rows - n_lower - n_middle
            parts[target] = Bracket(Bound(last, False), bracket.upper, upto_middle, rest)
    return parts


def tile_ends(rows: int, tiles: int) -> list[int]:
    """The last rank of each tile but the last, as SQL NTILE deals them: the first
    ``rows % tiles`` tiles hold one row more."""
    size, larger = divmod(rows, tiles)
    return [min(rows, tile * size + min(tile, larger)) for tile in range(1, tiles)]


def score_ends(rows: int, bins: int) -> list[int]:
    """The last rank of each score but the highest, for equal-width quantiles of the ranks."""
    return [score * (rows - 1) // bins + 1 for score in range(1, bins)]


def _with_steps(
    table: DataFrame, orders: Mapping[str, Sequence[Column]], ends: Callable[[int], Sequence[int]]
) -> DataFrame:
    boundaries = rows_at(table, orders, ends)
    steps = {}
    for name, columns in orders.items():
        order = _order(table, columns)
        step = F.lit(len(boundaries[name]) + 1)
        for number, key in reversed(list(enumerate(boundaries[name], start=1))):
            step = F.when(order.upto(Bound(key, True)), number).otherwise(step)
        steps[name] = step.cast("int")
    return table.withColumns(steps)


def with_tiles(
    table: DataFrame, orders: Mapping[str, Sequence[Column]], tiles: int
) -> DataFrame:
    """Add the SQL NTILE of every order as a column of its name."""
    return _with_steps(table, orders, lambda rows: tile_ends(rows, tiles))


def with_quantile_scores(
    table: DataFrame, orders: Mapping[str, Sequence[Column]], bins: int = 5
) -> DataFrame:
    """Add a score from 1 to ``bins`` per order, by equal-width quantiles of the ranks."""
    return _with_steps(table, orders, lambda rows: score_ends(rows, bins))


def median(table: DataFrame, value: Column, leaf: int = LEAF, sample: int = SAMPLE) -> float | None:
    """The exact median of a number over the rows that have one, None if there are none. Nothing
    is sorted but the list around the middle; equal values may be any share of the rows."""
    number = value.cast("double")

    def middle(rows: int) -> list[int]:
        return [(rows + 1) // 2, rows // 2 + 1]

    given = table.select(number.alias("value")).where(F.col("value").isNotNull())
    found = rows_at(given, {"value": [F.col("value")]}, middle, leaf, sample)["value"]
    return sum(row[0] for row in found) / len(found) if found else None
