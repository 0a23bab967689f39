"""Exact dedup by content-defined chunk recipes.

A text, with each run of white space as one space, is cut where a rolling hash of the last
16 bytes hits a pattern, so equal passages are cut alike wherever they stand. Chunks are
deduplicated by identifier, and the deduplication compares their bytes: an identifier counts
only if all chunks that carry it are identical. From then on a document is its recipe, the
ordered list of chunk identifiers, and only recipes are shuffled and compared.

Defined cases: a null text counts as empty; empty texts equal each other (an empty recipe);
of rows that repeat a doc_id one stays; a null doc_id comes after all others, and its group
has a null keep_id only if no row of the group has an id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import encoded, in_arrow, lists, one_spaced, sliced, task_id
from martloom.operators.scratch import materialize

WINDOW = 16
CUT_BITS = 10  # a cut every 1,024 bytes on average
LONGEST = 16 << 10  # a chunk without a cut is cut after so many bytes

RECIPES = "doc_id bigint, row bigint, text_sha256 string, recipe array<binary>"


def _gear() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)


def cut_points(data: bytes, ends: np.ndarray) -> np.ndarray:
    """End offsets of the chunks of texts that lie one after another in ``data``.

    ``ends`` are the texts' end offsets. A cut depends on the text's own bytes only.
    """
    h = _gear()[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    cuts = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    starts = np.concatenate([[0], ends[:-1]])
    cuts = cuts[cuts - starts[np.searchsorted(ends, cuts, "left")] >= WINDOW] if len(cuts) else cuts
    cuts = np.union1d(cuts, ends[ends > starts])
    gaps = np.diff(cuts, prepend=0)
    forced = [
        np.arange(cuts[i] - gaps[i] + LONGEST, cuts[i], LONGEST)
        for i in np.flatnonzero(gaps > LONGEST)
    ]
    return np.sort(np.concatenate([cuts, *forced])).astype(np.int64)


def _chunked(batch: pa.RecordBatch, seed: int):
    texts = [one_spaced(x) for x in encoded(batch.column("text"))]
    ends = np.cumsum([len(x) for x in texts])
    data = b"".join(texts)
    cuts = cut_points(data, ends)
    starts = np.concatenate([[0], cuts[:-1]]).astype(np.int64) if len(cuts) else cuts
    pairs = zip(starts.tolist(), cuts.tolist(), strict=True)
    ids = [xxhash.xxh3_128_digest(data[a:b], seed) for a, b in pairs]
    return texts, ends, data, cuts, pa.array(ids, pa.binary())


def recipes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: digest of the text and ordered chunk identifiers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = task_id() << 33
        for batch in sliced(batches, "text"):
            texts, ends, _, cuts, ids = _chunked(batch, seed)
            offsets = np.concatenate([[0], np.searchsorted(cuts, ends, "right")])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.arange(row, row + len(texts)), pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                    lists(offsets, ids),
                ],
                names=["doc_id", "row", "text_sha256", "recipe"],
            )
            row += len(texts)

    return in_arrow(docs.select(F.col("doc_id").cast("bigint"), "text"), run, RECIPES)


def chunks(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Every chunk occurrence: identifier and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            _, _, data, cuts, ids = _chunked(batch, seed)
            offsets = np.concatenate([[0], cuts]).astype(np.int64)
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
            content = pa.Array.from_buffers(pa.binary(), len(cuts), buffers)
            yield pa.RecordBatch.from_arrays([ids, content], names=["id", "chunk"])

    return in_arrow(docs.select("text"), run, "id binary, chunk binary")


def distinct_chunks(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The chunk store: identifier, bytes, occurrences, and whether all occurrences agree."""
    return (
        chunks(docs, seed)
        .groupBy("id")
        .agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("last"), F.count("*").alias("n"))
        .select("id", "chunk", "n", (F.col("chunk") == F.col("last")).alias("verified"))
    )


def verified_recipes(docs: DataFrame) -> DataFrame:
    """Written recipes over identifiers that the chunk bytes have confirmed.

    Should two chunks ever share an identifier, all are named anew with another seed.
    """
    seed = 0
    while not distinct_chunks(docs, seed).where(~F.col("verified")).isEmpty():
        seed += 1
    return materialize(recipes(docs, seed), "recipes")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, one row per row of ``docs``.

    A group's size and first row are combined before the shuffle. Groups of two rows or more
    are written and joined back by recipe; as both sides of that join are plain scans, adaptive
    execution can split a group that holds a large part of the rows.
    """
    own = verified_recipes(docs)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("r"))
    found = own.groupBy("recipe").agg(F.min(rank).alias("first"), F.count("*").alias("group_size"))
    shared = materialize(found.where("group_size > 1"), "groups")
    alone = F.col("first").isNull()
    return own.join(shared, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("first.r"))).alias("kept"),
        "text_sha256",
    )
