"""Trie of conversation prefixes, with subtree totals by parallel tree contraction.

Conversations that start with the same turns share those nodes of a trie, so work on a shared
prefix need be done once. A node is a distinct sequence of first turns; it is named by its depth
and its smallest conversation.

**Nodes.** Turns are placed by a range sort, so that a conversation with a large part of all
turns is spread over tasks; texts are read once, for a digest and a length. Two sums of 64-bit
hashes of (place, turn) over the first d turns are a prefix's key. The key is verified, not
trusted: within every node all rows must agree in their parent's key and in their last turn's
SHA-256, which by induction over the depth makes equal keys equal sequences.

**Totals.** In each round :func:`subtree_totals` rakes: every leaf is taken off and its total
added to its parent, and compresses: of each run of nodes with one child, those that come first
among their neighbours by an order that alternates along the run are cut out, and the edge below
carries what they hold. Half of every run goes in a round, so a chain of n nodes takes about log n
rounds, as does a bushy tree. At the end only roots are left, and the rounds are undone from the
last to the first: a cut-out node's total is what it held, its edge and its child's total.

Defined cases: turns follow by number, null first, then by role and SHA-256, so rows that repeat a
number are turns as well; a null role or text is empty; rows without a conv_id belong to no
conversation. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import in_arrow
from martloom.operators.scratch import materialize

#: Conversations of one hundred share the start of its first one, at most five turns of it.
FAMILY, SHARED = 100, 6

BLOCK = 1024  # places in a running sum of one task
PIECE = 1 << 14  # characters of joined ids that travel as one row

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row position below
_ID = ("conv_id", "depth")


# --- turns in their places ------------------------------------------------------------


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_sha, chars): each turn with its place from 0 in its conversation."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(said.cast("binary"), 256)).alias("turn_sha"),
        F.length(text).cast("bigint").alias("chars"),
    )
    return _numbered(turns)


def _numbered(turns: DataFrame) -> DataFrame:
    """Range sort by conversation and turn; a turn's place is its position in the partition, less
    where its conversation starts there, plus the turns of it in earlier partitions."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("turn_sha")]
    ranged = materialize(turns, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    slots = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "slots")
    slots = slots.select(
        "conv_id",
        F.shiftright("_slot", _POSITION_BITS).alias("part"),
        F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1).alias("position"),
        "turn_sha",
        "chars",
    )
    runs = slots.groupBy("conv_id", "part").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))  # rows: partitions
    place = (F.col("position") - F.col("first") + F.col("before")).alias("place")
    return slots.join(runs, ["conv_id", "part"]).select("conv_id", place, "turn_sha", "chars")


def rebuilt(placed: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % ``family``,
    h = crc32(c) % ``shared``: (conv_id, place, turn_sha, chars); a conversation that is left
    without a turn has one row with a null place."""
    conv = F.col("conv_id")
    h = (F.crc32(conv.cast("string").cast("binary")) % shared).alias("h")
    convs = placed.select("conv_id").distinct().select(conv, (conv - conv % family).alias("base"), h)
    convs = materialize(convs, "conversations")
    head = placed.where(F.col("place") < shared - 1).withColumnRenamed("conv_id", "base")
    heads = convs.join(head, "base").where(F.col("place") < F.col("h"))  # at most `family` to a turn
    own = placed.select("conv_id", "place", "turn_sha", "chars", h).where(F.col("place") >= F.col("h"))
    # places stay distinct and in order, but may skip numbers where the base is shorter
    columns = ["conv_id", "place", "turn_sha", "chars"]
    found = materialize(heads.select(*columns).unionByName(own.select(*columns)), "taken")
    turnless = convs.select("conv_id").join(found.select("conv_id"), "conv_id", "left_anti")
    empty = turnless.select(
        "conv_id",
        F.lit(None).cast("bigint").alias("place"),
        F.lit(None).cast("binary").alias("turn_sha"),
        F.lit(None).cast("bigint").alias("chars"),
    )
    return found.unionByName(empty)


# --- nodes ----------------------------------------------------------------------------


def _running(rows: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``terms`` replaced by their sums over a conversation's places up to each row; by blocks of
    BLOCK places first, so that a window holds a block or a row per block of a conversation."""
    rows = rows.withColumn("block", F.floor(F.col("place") / BLOCK).cast("bigint"))
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(t).alias(t) for t in terms])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"before_{t}") for t in terms]
    blocks = blocks.select("conv_id", "block", *sums)
    upto = Window.partitionBy("conv_id", "block").orderBy("place")
    totals = {t: F.sum(t).over(upto) + F.col(f"before_{t}") for t in terms}
    found = rows.join(blocks, ["conv_id", "block"]).withColumns(totals)
    return found.drop("block", *[f"before_{t}" for t in terms])


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent_key, turn_sha, chars, ends): a row for each conversation and
    each of its prefixes but the empty one. ``turns`` may skip places."""
    rows = turns.where(F.col("place").isNotNull()).withColumn("depth", F.lit(1).cast("decimal(38,0)"))
    rows = materialize(_running(rows, ["depth"]).withColumn("depth", F.col("depth").cast("bigint")), "depths")
    terms = ["key_a", "key_b"]

    def own(seed: int) -> Column:
        hashed = F.xxhash64(F.lit(seed), "depth", "turn_sha")
        return hashed.cast("decimal(38,0)")  # sums of 64-bit numbers, exact for any length

    rows = rows.withColumns({t: own(i) for i, t in enumerate(terms)})
    rows = rows.withColumns({f"own_{t}": F.col(t) for t in terms})
    summed = _running(rows, terms)
    last = rows.groupBy("conv_id").agg(F.max("depth").alias("last"))
    return summed.join(last, "conv_id").select(
        "conv_id",
        "depth",
        F.struct(*terms).alias("key"),
        F.struct(*[(F.col(t) - F.col(f"own_{t}")).alias(t) for t in terms]).alias("parent_key"),
        "turn_sha",
        "chars",
        (F.col("depth") == F.col("last")).alias("ends"),
    )


def nodes(members: DataFrame, conversations: int, smallest: int | None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, chars), from the rows of
    :func:`prefixes`; the root stands for all ``conversations``, of which ``smallest`` is one."""
    spark = members.sparkSession
    grouped = members.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"),
        F.min("parent_key").alias("parent_key"),
        F.min("turn_sha").alias("_sha"),
        F.max("parent_key").alias("_parent"),
        F.max("turn_sha").alias("_other_sha"),
    )
    same = (F.col("_parent") == F.col("parent_key")) & (F.col("_sha") == F.col("_other_sha"))
    checked = F.when(same, F.col("n_convs")).otherwise(
        F.raise_error(F.lit("different prefixes share a key")).cast("bigint")
    )
    found = materialize(grouped.withColumn("n_convs", checked).drop("_sha", "_other_sha", "_parent"), "nodes")
    parents = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    top = F.lit(smallest).cast("bigint")
    deep = found.where("depth > 1").join(parents, ["depth", "parent_key"])
    first = found.where("depth = 1").withColumn("parent_conv_id", top)  # the root has no row to meet
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "chars"]
    below = deep.select(*columns).unionByName(first.select(*columns))
    if smallest is None:
        return below.withColumn("n_children", F.lit(0).cast("bigint"))
    root = spark.createDataFrame(
        [(smallest, 0, None, conversations, 0)],
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, chars bigint",
    )
    below = materialize(root.unionByName(below), "trie")
    children = below.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    )
    counts = children.agg(F.count("*").alias("n_children"))
    return below.join(counts, list(_ID), "left").fillna(0, ["n_children"])


# --- totals by contraction ------------------------------------------------------------


def _order(side: str) -> Column:
    """Alternates along a run of neighbouring depths, and again along what a round leaves."""
    depth = F.col(f"{side}depth")
    return F.struct(depth.bitwiseAND(-depth), F.xxhash64(f"{side}conv_id", depth), depth)


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """(conv_id, depth, *values): each value summed over the node and all below it.

    ``tree``: conv_id and depth name a node, parent_conv_id and depth - 1 its parent (null for a
    root), n_children counts its children.
    """
    start = tree.select(
        *_ID,
        F.col("parent_conv_id").alias("up_conv_id"),
        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_depth"),
        "n_children",
        *[F.col(v).cast("bigint") for v in values],
        *[F.lit(0).cast("bigint").alias(f"edge_{v}") for v in values],
    )
    left = materialize(start, "tree")
    removed = []
    while not left.where(F.col("up_depth").isNotNull()).isEmpty():
        leaves, left = _rake(left, values)
        cut, left = _compress(left, values)
        removed.append((leaves, cut))
    totals = left.select(*_ID, *values)
    # What a round removed hangs on nodes that later rounds removed: those known are about as many
    # as the round left, so undoing all rounds costs little more than undoing the first.
    for leaves, cut in reversed(removed):
        below = totals.select(*[F.col(c).alias(f"kid_{c}") for c in _ID], *[F.col(v).alias(f"_{v}") for v in values])
        sums = [(F.col(v) + F.col(f"_{v}")).alias(v) for v in values]
        found = cut.join(below, ["kid_conv_id", "kid_depth"]).select(*_ID, *sums)
        totals = materialize(totals.unionByName(found).unionByName(leaves), "totals")
    return totals


def _rake(left: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves go; their totals and edges are added to their parents, combined before the shuffle."""
    leaf = (F.col("n_children") == 0) & F.col("up_depth").isNotNull()
    up = [F.col(f"up_{c}").alias(c) for c in _ID]
    sums = [F.sum(F.col(v) + F.col(f"edge_{v}")).alias(f"_{v}") for v in values]
    given = left.where(leaf).groupBy(*up).agg(F.count("*").alias("_gone"), *sums)
    none = F.lit(0)
    held = {v: F.col(v) + F.coalesce(f"_{v}", none) for v in values}
    children = F.col("n_children") - F.coalesce("_gone", none)
    stay = left.where(~leaf).join(given, list(_ID), "left").withColumns({**held, "n_children": children})
    return left.where(leaf).select(*_ID, *values), materialize(stay.select(*left.columns), "raked")


def _compress(left: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cut out the nodes with one child that come first among their neighbours of that kind.

    Returns what was cut, each with its only child and what it holds with the edge below, and the
    tree that is left.
    """
    single = (F.col("n_children") == 1) & F.col("up_depth").isNotNull()
    chain = left.where(single)
    upper = chain.select(*[F.col(c).alias(f"up_{c}") for c in _ID])
    edge = chain.select(*_ID, "up_conv_id", "up_depth").join(upper, ["up_conv_id", "up_depth"])
    later = F.when(_order("up_") < _order(""), F.struct(*_ID)).otherwise(F.struct(*[F.col(f"up_{c}").alias(c) for c in _ID]))
    losers = edge.select(later.alias("x")).select("x.*").distinct().withColumn("_stays", F.lit(True))
    chain = chain.join(losers, list(_ID), "left")
    marked = materialize(left.where(~single).withColumn("_stays", F.lit(True)).unionByName(chain), "marked")
    taken = ["up_conv_id", "up_depth", *values, *[f"edge_{v}" for v in values]]
    out = marked.where(F.col("_stays").isNull()).select(
        *[F.col(c).alias(f"v_{c}") for c in _ID], *[F.col(c).alias(f"v_{c}") for c in taken]
    )
    met = (F.col("up_conv_id") == F.col("v_conv_id")) & (F.col("up_depth") == F.col("v_depth"))
    joined = materialize(marked.where("_stays").drop("_stays").join(out, met, "left"), "compressed")
    cut = joined.where(F.col("v_depth").isNotNull()).select(
        *[F.col(f"v_{c}").alias(c) for c in _ID],
        *[F.col(c).alias(f"kid_{c}") for c in _ID],
        *[(F.col(f"v_{v}") + F.col(f"edge_{v}")).alias(v) for v in values],
    )
    spliced = F.col("v_depth").isNotNull()
    moved = {c: F.when(spliced, F.col(f"v_{c}")).otherwise(F.col(c)) for c in ("up_conv_id", "up_depth")}
    none = F.lit(0)
    for v in values:
        carried = F.coalesce(F.col(f"v_{v}") + F.col(f"v_edge_{v}"), none)
        moved[f"edge_{v}"] = F.col(f"edge_{v}") + carried
    return cut, joined.withColumns(moved).select(*left.columns)


# --- who ends where -------------------------------------------------------------------


def ends_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) from a row (conv_id, depth, member) per conversation and the
    node it ends in: the SHA-256 of the members, ascending and joined by commas.

    A range sort spreads the members of a node over tasks, which join theirs to pieces of text;
    a digest then reads its node's pieces one after another.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "depth", "first", "piece"]
        node, first, ids, size = None, None, [], 0
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "depth", "member")]
            for conv_id, depth, member in zip(*columns, strict=True):
                if (conv_id, depth) != node or size >= PIECE:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    node, first, ids, size = (conv_id, depth), member, [], 0
                ids.append(str(member))
                size += len(ids[-1]) + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, first, ",".join(ids))], names=names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "depth", "ends_sha256"]
        node, sha = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "depth", "piece")]
            for conv_id, depth, piece in zip(*columns, strict=True):
                if (conv_id, depth) != node:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (conv_id, depth), hashlib.sha256(piece.encode())
                else:
                    sha.update(f",{piece}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, sha.hexdigest())], names=names)

    ranged = ends.repartitionByRange(*_ID, "member").sortWithinPartitions(*_ID, "member")
    pieces = in_arrow(ranged, join, "conv_id bigint, depth bigint, first bigint, piece string")
    together = pieces.repartition(*_ID).sortWithinPartitions(*_ID, "first")
    return in_arrow(together, digest, "conv_id bigint, depth bigint, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie of ``turns`` (see :func:`rebuilt`; or :func:`placed_turns` for
    conversations as they are)."""
    turns = materialize(turns, "rebuilt")
    counted = turns.agg(F.count_distinct("conv_id").alias("n"), F.min("conv_id").alias("c")).first()
    members = materialize(prefixes(turns), "prefixes")
    tree = nodes(members, counted.n, counted.c)
    own = tree.withColumns(
        {
            "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    keys = members.groupBy("depth", "key").agg(F.min("conv_id").alias("conv_id"))
    last = members.where("ends").select("depth", "key", F.col("conv_id").alias("member"))
    at_root = turns.where(F.col("place").isNull()).select(
        F.lit(counted.c).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.col("conv_id").alias("member"),
    )
    ends = last.join(keys, ["depth", "key"]).select(*_ID, "member").unionByName(at_root)
    digests = ends_digests(materialize(ends, "ends"))
    return (
        tree.drop("chars")
        .join(totals, list(_ID))
        .join(digests, list(_ID), "left")
        .fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", "ends_sha256",
        )
    )


def rebuilt_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(materialize(placed_turns(conversations), "placed"), family, shared))
