"""Mixing sources to target weights by fitting word budgets.

Sources share a budget by weight; a source stops at ``most`` times its own words and what it
leaves is shared again. A source's target is then filled exactly where its documents allow it:
whole passes over the source first, and for the rest a choice of documents by length. Of each
length an equal share is taken, and the remaining budget is a bounded knapsack over the lengths
still on hand, solved by dynamic programming. It works on counts of documents per source and
length, never on documents. Which documents of a length are taken follows a seeded hash of the
whole row: those up to a cut, which is found by counting hashes, so that a row decides for itself
and neither texts nor rows are moved, sorted or ranked.

Sizes are numbers of ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null text has no words; a null
source is a source of its own, the last; a source without words has the target 0 and takes
none; empty documents are taken with their source's whole passes, which adds no words; rows
that repeat a doc_id count and are taken one by one; of rows alike in all columns any are taken.
Columns of any name pass through :func:`mixed`; MAP columns are not part of the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.scratch import materialize

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5  # of all words
MOST = 2.0  # of a source's words
SEED = 17
KNAPSACK = 1 << 16  # largest remaining budget for the dynamic program, in words
GROUP = 1000  # hashes of one source and length that are counted one by one, on average
CHUNK = 1000  # copies of rows alike in all columns that one task writes


def n_words(text: str = "text") -> Column:
    found = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(found, F.lit(0)).cast("bigint")


def targets(
    sources: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
) -> DataFrame:
    """``sources`` (source, source_size), one row per source, with ``target``.

    Sharing what the full sources leave, again and again, ends where every other source has
    its weight times one common level. In order of limit over weight the full sources come
    first, and the level follows from the sums before and after. Weights go to the sources by
    code point, null last, and repeat.
    """
    table = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("_n", F.row_number().over(by_name) - 1)
    ranked = numbered.withColumn("_w", F.element_at(table, (F.col("_n") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("_limit") / F.col("_w"), "_n")
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.least(F.sum("source_size").over(every) * budget, F.sum("_limit").over(every))
    level = (total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    # the first source below its limit sets the level for itself and all after it
    open_level = F.when(level * F.col("_w") < F.col("_limit"), level)
    leveled = ranked.withColumn("_open", open_level)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    leveled = leveled.withColumn("_level", F.first("_open", ignorenulls=True).over(upto))
    target = F.coalesce(F.col("_level") * F.col("_w"), F.col("_limit"))
    return leveled.select("source", "source_size", F.least(target, F.col("_limit")).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length come near ``budget`` words, from below or, by
    fitting those to leave out, from above; the nearer one."""
    below = _fit_below(lengths, counts, budget)
    words = int((lengths * counts).sum())
    above = counts - _fit_below(lengths, counts, words - budget)
    gap_below = abs(budget - int((lengths * below).sum()))
    return below if gap_below <= abs(int((lengths * above).sum()) - budget) else above


def _fit_below(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents of each length, of at most ``budget`` words in all.

    An equal share of each length, then the longest that still fit until the rest is at most
    KNAPSACK, then the dynamic program: ``last[s]`` is the length that first reached the sum
    s, with no more copies of it than are left.
    """
    taken = np.zeros(len(lengths), np.int64)
    words = int((lengths * counts).sum())
    if budget <= 0 or not words:
        return taken
    if budget >= words:
        return counts.copy()
    # whole numbers: the product may pass 64 bits
    taken[:] = [int(c) * budget // words if n else 0 for n, c in zip(lengths, counts, strict=True)]
    rest = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= KNAPSACK:
            break
        if lengths[i]:
            more = min((rest - KNAPSACK) // int(lengths[i]), int(counts[i] - taken[i]))
            taken[i] += more
            rest -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, rest)


def _knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack for sums up to ``budget``; ends once the budget itself is reached."""
    chosen = np.zeros(len(lengths), np.int64)
    last = np.full(budget + 1, -1)
    last[0] = len(lengths)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        if n == 0 or n > budget or not left[i]:
            continue
        reached = last >= 0
        # copies of this length used at each sum: 0 where it was reached before
        used = np.zeros(budget + 1, np.int64)
        for _ in range(min(int(left[i]), budget // n)):
            fresh = np.flatnonzero(reached[: budget + 1 - n]) + n
            fresh = fresh[(~reached[fresh]) & (used[fresh - n] < left[i])]
            if not len(fresh):
                break
            used[fresh] = used[fresh - n] + 1
            last[fresh] = i
            reached[fresh] = True
        if last[budget] >= 0:
            break
    s = int(np.flatnonzero(last >= 0)[-1])
    while s:
        chosen[last[s]] += 1
        s -= int(lengths[last[s]])
    return chosen


def plan(histogram: DataFrame, shares: DataFrame) -> DataFrame:
    """``histogram`` (source, size, n) with target, whole passes and ``extra`` documents of
    each length. A group is one source's distinct lengths, with their counts."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        words, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = int(target // words) if words else 0
        lengths = group["size"].to_numpy(np.int64)
        extra = fit(lengths, group["n"].to_numpy(np.int64), round(target - passes * words))
        return group.assign(passes=passes, extra=extra)

    joined = histogram.join(shares, histogram["source"].eqNullSafe(shares["source"]))
    joined = joined.select(
        histogram["source"], "size", "n", "source_size", "target",
        F.lit(0).cast("bigint").alias("passes"), F.lit(0).cast("bigint").alias("extra"),
    )
    return joined.groupBy("source").applyInPandas(run, joined.schema)


def _row_hash(docs: DataFrame, seed: int) -> Column:
    """A hash of the whole row, so that equal ids or texts alone make no ties."""
    plain = [f"`{c.name}`" for c in docs.schema if not isinstance(c.dataType, T.MapType)]
    return F.xxhash64(F.lit(seed), *plain)


def cuts(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with ``cut``, ``alike`` and ``more``: of each source and length, rows with a
    hash below ``cut`` are taken once more, and so are ``more`` of the ``alike`` rows at it.

    ``rows``: source, size and h. Ranges of h are counted first; only the hashes of the range
    that holds the cut are counted one by one, and equal ones add up before they are moved.
    """
    p = planned.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "extra")
    same = rows["source"].eqNullSafe(F.col("_source")) & (rows["size"] == F.col("_size"))
    some = p.where((F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    parts = F.ceil(F.col("n") / GROUP)
    share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    part = F.least(F.floor(share * parts), parts - 1).alias("part")
    ranged = rows.join(some, same).select("source", "size", "h", "extra", part)
    key = ["source", "size"]

    def crossing(counts: DataFrame, by: str) -> DataFrame:
        """The first ``by`` at which the running count reaches ``extra``, and the count before it."""
        upto = Window.partitionBy(*key).orderBy(by)
        running = counts.withColumn("until", F.col("skipped") + F.sum("m").over(upto))
        crossed = (F.col("until") >= F.col("extra")) & (F.col("until") - F.col("m") < F.col("extra"))
        return running.where(crossed)

    counted = ranged.groupBy(*key, "part").agg(F.count("*").alias("m"), F.first("extra").alias("extra"))
    border = crossing(counted.withColumn("skipped", F.lit(0)), "part")
    border = materialize(
        border.select(
            F.col("source").alias("_source"), F.col("size").alias("_size"),
            F.col("part").alias("_part"), (F.col("until") - F.col("m")).alias("skipped"),
        ),
        "borders",
    )
    met = ranged["source"].eqNullSafe(F.col("_source")) & (ranged["size"] == F.col("_size"))
    met &= ranged["part"] == F.col("_part")
    hashes = ranged.join(border, met).groupBy(*key, "h").agg(
        F.count("*").alias("m"), F.first("extra").alias("extra"), F.first("skipped").alias("skipped")
    )
    found = crossing(hashes, "h").select(
        *key, F.col("h").alias("cut"), F.col("m").alias("alike"),
        (F.col("extra") - F.col("until") + F.col("m")).alias("more"),
    )
    found = found.withColumnsRenamed({"source": "_source", "size": "_size"})
    same = planned["source"].eqNullSafe(F.col("_source")) & (planned["size"] == F.col("_size"))
    none = F.lit(0).cast("bigint")
    all_of_it = (F.col("extra") >= F.col("n")).cast("bigint")
    return planned.join(found, same, "left").select(
        *key, "source_size", "target", (F.col("passes") + all_of_it).alias("passes"),
        "cut", F.coalesce("alike", none).alias("alike"), F.coalesce("more", none).alias("more"),
    )


def _decided(
    docs: DataFrame, weights: Sequence[float], budget: float, most: float, seed: int
) -> DataFrame:
    """The plan and cuts of :func:`mix`, a row per source and length."""
    source = F.col("source").cast("string").alias("source")
    own = docs.select(source, n_words().alias("size"), _row_hash(docs, seed).alias("h"))
    own = materialize(own, "sizes")
    histogram = materialize(own.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    sources = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size")
    )
    shares = materialize(targets(sources, weights, budget, most), "targets")
    planned = materialize(plan(histogram, shares), "plan")
    return materialize(cuts(own, planned), "cuts")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and copies, a row per document."""
    row = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"))
    found = _with_copies(docs, _decided(docs, weights, budget, most, seed), row, seed)
    return found.select(
        "row.doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def _with_copies(docs: DataFrame, decided: DataFrame, row: Column, seed: int) -> DataFrame:
    """``row`` of each row of ``docs`` beside source, size, source_size, target and copies."""
    d = decided.withColumnsRenamed({"source": "_source", "size": "_size"})
    own = docs.select(
        row.alias("row"), F.col("source").cast("string").alias("source"),
        n_words().alias("size"), _row_hash(docs, seed).alias("h"),
    )
    same = own["source"].eqNullSafe(F.col("_source")) & (own["size"] == F.col("_size"))
    # the plan has a row per source and length: broadcast where it is as small as it should be
    joined = own.join(d, same)
    below = F.coalesce(F.col("h") < F.col("cut"), F.lit(False)).cast("bigint")
    at_cut = F.coalesce(F.col("h") == F.col("cut"), F.lit(False))
    split = at_cut & (F.col("more") < F.col("alike"))
    columns = ["row", "source", "size", "source_size", "target"]
    whole = joined.where(~split).select(
        *columns, (F.col("passes") + below + at_cut.cast("bigint")).alias("copies")
    )
    if decided.where("more < alike").isEmpty():  # as a rule: no second scan then
        return whole
    return whole.unionByName(_alike(joined.where(split), columns))


def _alike(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows alike at a cut, of which some are taken once more: brought together as one row with a
    number before they are moved, and written out again in chunks of CHUNK."""
    one = rows.groupBy("source", "size", "h").agg(
        F.first("row").alias("row"),
        *[F.first(c).alias(c) for c in ("source_size", "target", "passes", "alike", "more")],
    )
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("alike") - 1) / CHUNK))).alias("chunk")
    spread = one.select("*", chunks).repartition("h", "chunk")
    first = F.col("chunk") * CHUNK + 1
    place = F.explode(F.sequence(first, F.least(first + CHUNK - 1, F.col("alike")))).alias("place")
    copies = F.col("passes") + (F.col("place") <= F.col("more")).cast("bigint")
    return spread.select("*", place).select(*columns, copies.alias("copies"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with each row as often as :func:`mix` takes it, all columns as they are."""
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    found = _with_copies(docs, _decided(docs, weights, budget, most, seed), row, seed)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.where("copies > 0").select("row", times).select("row.*")
