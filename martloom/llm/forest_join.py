"""N-gram Jaccard self-join with a MinHash LSH forest.

Texts are sets of five-word shingles; two texts are linked at a Jaccard similarity of at least
``threshold``. Texts with the same set are one representative with a count of copies, so copies
are never paired. Each of ``trees`` trees gives a representative a label: ``DEPTH`` MinHash values
of its own, one byte of each, the first on top. A tree's sorted labels are its prefix trie.

Pairs are met from the longest prefix down. The first round works on labels that are equal as a
whole, each further one on prefixes shorter by one value, and there only on nodes with several
children, as only these hold pairs not met before. All pairs met are verified exactly on their
shingle sets. The least similarity verified so far decides whether to shorten once more: it stops
as soon as pairs that alike are met in some tree with probability ``recall``. Less similar pairs
would nearly all have been met by then too (at eight values and 26 trees 99 of 100 at 0.8), and one
of them is enough to go on. Without any link the threshold itself is aimed at, so no prefix is
shorter than that takes (six values); labels alone under their prefix of that length are left out
of the tries.

What a hot node (texts under one prefix) costs: its members are dealt to blocks of bounded size,
and a tile (two blocks) is a unit of work that any task can take. A pair is verified in the first
round and tree only that holds it. Tiles return counts per member and a spanning forest, never
pairs, and no pair is dropped. Nodes with the same members in several trees are worked on once.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after A-Z is lower-cased; a text of one to four words
is one shingle; shingles are compared by a 64-bit hash. Defined cases: a null or wordless text
has no shingles and no links and is its own class; repeated rows are copies; a null doc_id is a
class's id only if no member has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import encoded, free_name, held, in_arrow, lists, sliced
from martloom.operators.scratch import distilled, materialize

SHINGLE = 5
THRESHOLD = 0.8
TREES = 26
DEPTH = 8  # values in a label; eight bytes are a bigint
VALUE_BITS = 8
RECALL = 0.9995
BLOCK_DOCS = 512
BLOCK_SHINGLES = 400_000

_CACHED_WORDS = 200_000

SIGNED = (
    "doc_id bigint, text_hash bigint, rep binary, n int, labels array<bigint>"
)
TILE = "tree int, key bigint, low int, high int"


def meeting(similarity: float, length: int, trees: int = TREES) -> float:
    """Probability that a pair of texts shares a prefix of ``length`` values in some tree."""
    return 1 - (1 - similarity**length) ** trees


def prefix_length(
    threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL
) -> int:
    """The longest prefix that still meets pairs at the threshold often enough."""
    for length in range(depth, 0, -1):
        if meeting(threshold, length, trees) >= recall:
            return length
    raise ValueError(f"{trees} trees cannot reach a recall of {recall}")


def _hash_words(words: list[bytes]) -> np.ndarray:
    known = held("word hashes", dict)
    if len(known) > _CACHED_WORDS:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    return np.array([known[w] for w in words], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _hash_words(words)
    last = max(1, len(words) - SHINGLE + 1)
    total = np.zeros(last, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        total = _mixed(total + hashes[k : k + last] + np.uint64(k + 1))
    return np.unique(total)


def _labels(sets: list[np.ndarray], trees: int) -> np.ndarray:
    """A label per text and tree: a byte of each of ``DEPTH`` MinHash values."""
    rng = np.random.default_rng(20_24)
    multiply = rng.integers(1, 2**32, trees * DEPTH, dtype=np.uint32) | np.uint32(1)
    flat = _mixed(np.concatenate(sets))
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    offsets = np.cumsum([0] + [len(s) for s in sets[:-1]])
    labels = np.zeros((len(sets), trees), np.uint64)
    for k in range(trees * DEPTH):
        smallest = np.minimum.reduceat(low * multiply[k] + high, offsets).astype(np.uint64)
        value = _mixed(_mixed(smallest + np.uint64(1))) >> np.uint64(64 - VALUE_BITS)
        own = labels[:, k // DEPTH]
        labels[:, k // DEPTH] = (own << np.uint64(VALUE_BITS)) | value
    return labels.view(np.int64)


def _below(length: int) -> int:
    """Bits of a label below its prefix of ``length`` values."""
    return VALUE_BITS * (DEPTH - length)


def _prefix(label: str, length: int) -> Column:
    return F.shiftrightunsigned(label, _below(length))


def signed(docs: DataFrame, trees: int = TREES) -> DataFrame:
    """Per row: id, hash of the text, digest and size of its shingle set, a label per tree. Digest
    and labels are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sets = [shingle_set(x) for x in encoded(batch.column("text"))]
            full = [i for i, s in enumerate(sets) if len(s)]
            labels = _labels([sets[i] for i in full], trees) if full else np.zeros((0, trees))
            rows: list = [None] * len(sets)
            for i, own in zip(full, labels, strict=True):
                rows[i] = own
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(rows, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "rep", "n", "labels"],
            )

    return in_arrow(_named(docs), run, SIGNED)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text"
    )


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` from sorted batches. Holds one run and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.any([v[1:] != v[:-1] for v in values], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            key = tuple(v[a] for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _new_pairs(tile: pa.Table, share: Fraction, length: int) -> np.ndarray:
    """Pairs of a tile that no longer prefix and no earlier tree holds and whose sizes allow the
    threshold."""
    tree, low, high = (tile.column(c)[0].as_py() for c in ("tree", "low", "high"))
    flat = tile.column("labels").combine_chunks().flatten().to_numpy()
    labels = flat.view(np.uint64).reshape(tile.num_rows, -1)
    block = tile.column("block").to_numpy()
    n = tile.column("n").to_numpy().astype(np.int64)
    if low == high:
        pairs = np.triu(np.ones((len(n), len(n)), bool), 1)
    else:
        pairs = np.outer(block == low, block == high)
    smaller, larger = np.minimum.outer(n, n), np.maximum.outer(n, n)
    pairs &= smaller * share.denominator >= larger * share.numerator
    for own in (labels >> np.uint64(_below(length))).T[:tree]:
        pairs &= np.not_equal.outer(own, own)
    if length < DEPTH:
        for own in (labels >> np.uint64(_below(length + 1))).T:
            pairs &= np.not_equal.outer(own, own)
    return pairs


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: incidence matrices of shingles held twice or more,
    some thousand columns at a time."""
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    rows, column = rows[shared], column[shared]
    found = np.zeros((len(sets), len(sets)), np.float32)
    if not len(rows):
        return found
    _, column = np.unique(column, return_inverse=True)
    step = 8192
    for start in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(column, [start, start + step])
        held = np.zeros((len(sets), min(step, int(column[-1]) + 1 - start)), np.float32)
        held[rows[a:b], column[a:b] - start] = 1
        found += held @ held.T
    return found


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component: every member takes the least root among
    its neighbours, then that one's own, until nothing changes."""
    near = linked | linked.T
    np.fill_diagonal(near, True)
    root = np.arange(len(linked))
    while True:
        least = np.where(near, root, len(root)).min(axis=1)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _members(joined: DataFrame, share: Fraction, length: int) -> DataFrame:
    """The members of each tile that are in a new pair; only their shingles are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _grouped(batches, ["tree", "key", "low", "high"]):
            pairs = _new_pairs(tile, share, length)
            needed = tile.filter(pa.array(pairs.any(axis=0) | pairs.any(axis=1)))
            yield from needed.select(["tree", "key", "low", "high", "block", "rep"]).to_batches()

    return in_arrow(joined, run, f"{TILE}, block int, rep binary")


def _verified(joined: DataFrame, share: Fraction, length: int) -> DataFrame:
    """Per tile and linked member: copies it is linked to, the root of its component, and the
    tile's least similarity of linked texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _grouped(batches, ["tree", "key", "low", "high"]):
            pairs = _new_pairs(tile, share, length)
            listed = tile.column("shingles").combine_chunks()
            flat, ends = listed.flatten().to_numpy(), np.cumsum(tile.column("n").to_numpy())
            sets = np.split(flat, ends[:-1])
            common = np.rint(_intersections(sets)).astype(np.int64)
            n = tile.column("n").to_numpy().astype(np.int64)
            union = np.add.outer(n, n) - common
            linked = pairs & (common * share.denominator >= union * share.numerator)
            copies = tile.column("copies").to_numpy().astype(np.int64)
            links = linked @ copies + copies @ linked
            root = _roots(linked)
            reps = tile.column("rep").combine_chunks()
            some = np.flatnonzero(linked.any(axis=0) | linked.any(axis=1))
            if not len(some):
                continue
            lowest = (common[linked] / union[linked]).min()
            yield pa.RecordBatch.from_arrays(
                [
                    reps.take(some),
                    pa.array(links[some], pa.int64()),
                    reps.take(root[some]),
                    pa.array(np.full(len(some), lowest)),
                ],
                names=["rep", "links", "root", "lowest"],
            )

    return in_arrow(joined, run, "rep binary, links bigint, root binary, lowest double")


def _dealt(rows: DataFrame) -> DataFrame:
    """Whole tiles to tasks."""
    tile = ["tree", "key", "low", "high"]
    return rows.repartition(*tile).sortWithinPartitions(*tile, "block", "rep")


def _shingles(docs: DataFrame, reps: DataFrame, shuffled: bool) -> DataFrame:
    """The shingle sets of the representatives' own texts, written. ``shuffled`` says that they are
    a share of all texts, so that the join is planned alike at every size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sets = [shingle_set(x) for x in encoded(batch.column("text"))]
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), lists(ends, flat)],
                names=["rep", "copies", "shingles"],
            )

    texts = _named(docs).alias("d")
    wanted = reps.select("rep", "copies", "doc_id", "text_hash").alias("r")
    same = F.expr("d.doc_id <=> r.doc_id AND d.text_hash = r.text_hash")
    found = texts.join(wanted.hint("merge") if shuffled else wanted, same)
    found = found.select("r.rep", "r.copies", "d.text")
    sets = in_arrow(found, run, "rep binary, copies bigint, shingles array<bigint>")
    return materialize(sets.dropDuplicates(["rep"]), "shingles")  # repeated rows give one


def components(edges: DataFrame) -> DataFrame:
    """(rep, class) of every node of ``edges`` (rep, root): its component's smallest node.

    Alternates large and small stars. An edge list stays as long as it is, a pass is two
    aggregations and joins, and passes grow with the logarithm of the longest path.
    """
    edges = materialize(edges.select("rep", "root").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("root", "rep")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("rep"), F.col("m").alias("root"))
        large = materialize(large.where("rep != root").distinct(), "large")
        least = large.groupBy("rep").agg(F.min("root").alias("m"))
        small = large.join(least, "rep").select(
            F.explode(F.array(F.struct("rep", "m"), F.struct(F.col("root").alias("rep"), "m"))).alias("e")
        )
        small = small.select("e.rep", F.col("e.m").alias("root")).where("rep != root").distinct()
        edges = materialize(small, "small")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("rep", "root"))).first()
        if state == before:
            return edges.select("rep", F.col("root").alias("class"))
        before = state


def _tries(reps: DataFrame, shortest: int) -> DataFrame:
    """The labels that share their shortest prefix with another, sorted by tree and label, written."""
    spread = reps.select("rep", "n", F.posexplode("labels").alias("tree", "label"))
    spread = spread.withColumn("key", _prefix("label", shortest))
    shared = spread.groupBy("tree", "key").agg(F.count("*").alias("members")).where("members > 1")
    shared = materialize(shared.select("tree", "key"), "shared")
    kept = spread.join(shared, ["tree", "key"]).select("tree", "label", "rep", "n")
    order = ["tree", "label", "rep"]
    return materialize(kept.repartitionByRange(*order).sortWithinPartitions(*order), "tries")


def _tiles(tries: DataFrame, length: int) -> DataFrame:
    """The members of all nodes at prefixes of ``length`` values that hold new pairs, a row each,
    with the number of blocks their node is dealt to."""
    nodes = tries.withColumn("key", _prefix("label", length)).groupBy("tree", "key")
    if length == DEPTH:
        branches = F.count("*") > 1
    else:
        child = _prefix("label", length + 1)
        branches = F.min(child) != F.max(child)
    nodes = nodes.agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("rep")).alias("a"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("b"),
        F.sum("n").alias("load"),
        branches.alias("branches"),
    ).where("branches")
    nodes = nodes.groupBy("members", "a", "b", "load").agg(F.min(F.struct("tree", "key")).alias("node"))
    split = F.ceil(F.greatest(F.col("members") / BLOCK_DOCS, F.col("load") / BLOCK_SHINGLES))
    nodes = materialize(nodes.select("node.tree", "node.key", split.alias("parts")), "nodes")

    members = tries.select("tree", _prefix("label", length).alias("key"), "rep")
    return members.join(nodes, ["tree", "key"]).select("tree", "key", "rep", "parts")


def _in_tiles(members: DataFrame) -> DataFrame:
    """A row per member and tile. Whatever a member carries is joined before: joins see a member
    of a node once, however many tiles the node has."""
    own = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int")))
    return (
        members.withColumn("block", own)
        .withColumn("other", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("parts", "other")
    )


def _with_payload(needed: DataFrame, *payloads: DataFrame) -> DataFrame:
    """The rows of ``needed``, a member in a tile each, with what is known of the member. The joins
    see a member of a node once, with a list of its tiles."""
    tiles = F.collect_list(F.struct("low", "high")).alias("tiles")
    members = needed.groupBy("tree", "key", "block", "rep").agg(tiles)
    for payload in payloads:
        members = members.join(payload, "rep")
    return members.withColumn("tile", F.explode("tiles")).select("*", "tile.*").drop("tiles", "tile")


def _linked(
    docs: DataFrame, reps: DataFrame, threshold: float, trees: int, recall: float
) -> DataFrame:
    """All links, met from the longest prefix down to the one that the links found ask for.

    A round reads the texts only of representatives that no earlier one has needed.
    """
    share = Fraction(str(threshold))
    shortest = prefix_length(threshold, trees, DEPTH, recall)
    tries = _tries(reps, shortest)
    reps = reps.join(tries.select("rep").distinct(), "rep", "left_semi")
    reps = materialize(reps, "company")  # the others meet no text and are not moved again
    signatures = reps.select("rep", "n", "labels")
    rounds: list[DataFrame] = []
    sets: list[DataFrame] = []
    lowest = None  # the least similarity of a link
    for length in range(DEPTH, shortest - 1, -1):
        dealt = _dealt(_in_tiles(_tiles(tries, length).join(signatures, "rep")))
        needed = materialize(_members(dealt, share, length), "members")
        near = reps.select("rep", "copies", "doc_id", "text_hash")
        near = near.join(needed.select("rep").distinct(), "rep", "left_semi")
        for known in sets:
            near = near.join(known.select("rep"), "rep", "left_anti")
        sets.append(_shingles(docs, materialize(near, "near"), shuffled=length == DEPTH))
        moved = _with_payload(needed, signatures, reduce(DataFrame.union, sets))
        rounds.append(materialize(_verified(_dealt(moved), share, length), "linked"))
        found = rounds[-1].agg(F.min("lowest")).first()[0]
        lowest = min((x for x in (lowest, found) if x is not None), default=None)
        if lowest is not None and meeting(lowest, length, trees) >= recall:
            break
    return reduce(DataFrame.union, rounds)


def classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """doc_id, text_hash, class_id, n_links and kept, one row per row of ``docs``.

    class_id is the smallest doc_id of all texts reached over links; n_links counts the other
    rows at the threshold or above, copies included; kept marks one row of each class.
    """
    rows = materialize(signed(docs, trees), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n", "labels"))
    reps = rows.where("rep IS NOT NULL").groupBy("rep").agg(first.alias("r"), F.count("*").alias("copies"))
    reps = materialize(reps.select("rep", "copies", "r.*"), "reps")
    linked = _linked(docs, reps, threshold, trees, recall)

    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(linked.where("rep != root"))
    named = reps.join(found, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    ids = named.groupBy("class").agg(
        F.min(F.struct("none", "doc_id", "text_hash", "rep")).alias("first")
    )
    named = named.join(ids, "class").join(links, "rep", "left")
    named = named.select(
        "rep",
        F.col("first.doc_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.col("first.text_hash").alias("first_hash"),
    )
    named = materialize(named, "classes")
    same = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("first_hash"))
    alone = F.col("rep").isNull()
    return rows.join(named, "rep", "left").select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (alone | same).alias("kept"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, all columns as they are, whatever their names.

    Texts without a link stay where they are; of linked ones the first is looked up. Texts
    without words have no links and all stay.
    """
    found = distilled(lambda: classes(docs, threshold).where("n_links > 0"), "linked")
    id_name, hash_name = free_name(docs, "key_id"), free_name(docs, "key_hash")
    keys = F.struct(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name))
    same = (F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_name))) & (
        F.xxhash64("text") == F.col(hash_name)
    )
    linked = found.select(keys.alias("k")).distinct().select("k.*")
    first = found.where("kept").select(keys.alias("k")).distinct().select("k.*")
    alone = docs.join(linked, same, "left_anti")
    chosen = docs.join(first, same, "left_semi")
    text_name = free_name(docs, "key_text")
    chosen = chosen.withColumn(text_name, F.xxhash64("text")).dropDuplicates(["doc_id", text_name])
    return alone.unionByName(chosen.drop(text_name))
