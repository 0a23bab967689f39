"""Benchmark decontamination with a positional inverted index.

The corpus is indexed once, in segments of a few megabytes of text: a segment keeps its sorted
terms, how often each occurs, and their positions in one running count of words. A phrase is
answered inside each segment: its terms' position lists, shifted by their offsets, are
intersected from the segment's rarest term on, so a phrase of which one term is missing costs
one look-up. Phrases go to the segments in blocks of bounded size, and what the blocks find in
a document is united afterwards, so a benchmark of any size passes.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased. Defined
cases: a null or wordless text has no words and no hits; a null item_id is listed as an empty
string; rows that repeat an item_id are one item; each row of ``docs`` gives one row, repeated
rows and null doc_ids included. A document is never cut, so a segment holds one at least.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import encoded, free_name, in_arrow, lists, sliced, task_id
from martloom.operators.scratch import materialize

WINDOW = 10
SEGMENT_BYTES = 4 << 20
BLOCK_PHRASES = 50_000

_NOT_WORD = bytes(
    0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)

INDEX = (
    "first_row bigint, doc_ids array<bigint>, starts array<int>,"
    " terms binary, counts binary, positions binary"
)
HITS = "row bigint, doc_id bigint, n_words bigint, spans array<array<int>>, items array<string>"
MATCHES = "row bigint, doc_id bigint, item_ids array<string>, start int, length int, exact boolean"


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(_NOT_WORD).split()


def index(docs: DataFrame) -> DataFrame:
    """One row per segment. ``starts`` has one entry more than ``doc_ids``; documents are
    one position apart, so no phrase reaches from one into the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = task_id() << 33
        packer = zstandard.ZstdCompressor(level=1)
        for batch in sliced(batches, "text", SEGMENT_BYTES):
            flat: list[bytes] = []
            lengths = []
            for text in encoded(batch.column("text")):
                found = words(text)
                lengths.append(len(found))
                flat += found
            starts = np.concatenate([[0], np.cumsum(np.array(lengths) + 1)]).astype(np.int32)
            coded = pa.array(flat, pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy()
            position = np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)
            ordered = position[np.argsort(codes, kind="stable")].astype(np.uint32)
            counts = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row], pa.int64()),
                    lists(np.array([0, batch.num_rows]), batch.column("doc_id")),
                    lists(np.array([0, len(starts)]), pa.array(starts)),
                    pa.array([packer.compress(b"\n".join(coded.dictionary.to_pylist()))]),
                    pa.array([packer.compress(counts.tobytes())]),
                    pa.array([packer.compress(ordered.tobytes())]),
                ],
                names=["first_row", "doc_ids", "starts", "terms", "counts", "positions"],
            )
            row += batch.num_rows

    return in_arrow(docs.select(F.col("doc_id").cast("bigint"), "text"), run, INDEX)


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items' words, each with the ids of the items that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for item_id, text in zip(ids, encoded(batch.column("text")), strict=True):
                found = words(text)
                last = max(1, len(found) - window + 1) if found else 0
                texts = [b" ".join(found[i : i + window]) for i in range(last)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * last, pa.string()), pa.array(texts, pa.binary())],
                    names=["item_id", "phrase"],
                )

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    found = in_arrow(named, run, "item_id string, phrase binary")
    return found.groupBy("phrase").agg(F.collect_set("item_id").alias("item_ids"))


@dataclass(frozen=True)
class Block:
    """Phrases over a numbered vocabulary; shorter phrases are filled up with -1."""

    vocabulary: dict[bytes, int]
    terms: np.ndarray
    lengths: np.ndarray
    item_ids: list[list[str]]


def block_of(rows: Sequence) -> Block:
    split = [bytes(r.phrase).split(b" ") for r in rows]
    vocabulary: dict[bytes, int] = {}
    for phrase in split:
        for term in phrase:
            vocabulary.setdefault(term, len(vocabulary))
    longest = max(map(len, split))
    terms = np.full((len(split), longest), -1)
    for i, phrase in enumerate(split):
        terms[i, : len(phrase)] = [vocabulary[t] for t in phrase]
    return Block(vocabulary, terms, np.array([len(p) for p in split]), [list(r.item_ids) for r in rows])


def blocks(items: DataFrame, window: int = WINDOW, size: int = BLOCK_PHRASES) -> Iterator[Block]:
    """The phrases in blocks of about ``size``, one block in the driver at a time."""
    stored = materialize(phrases(items, window), "phrases")
    n_blocks = ceil(stored.count() / size)
    for k in range(n_blocks):
        rows = stored.where(F.pmod(F.xxhash64("phrase"), F.lit(n_blocks)) == k).collect()
        if rows:
            yield block_of(rows)


class _Segment:
    """Position lists of one segment for the terms of one block."""

    def __init__(self, starts, terms, counts, positions, block: Block):
        unpack = zstandard.ZstdDecompressor()
        self.starts = starts
        all_terms = unpack.decompress(terms).split(b"\n")
        all_counts = np.frombuffer(unpack.decompress(counts), np.uint32)
        ends = np.cumsum(all_counts.astype(np.int64))
        positions = np.frombuffer(unpack.decompress(positions), np.uint32)
        self.counts = np.zeros(len(block.vocabulary) + 1, np.int64)
        self.counts[-1] = np.iinfo(np.int64).max  # the filler -1 never limits a phrase
        self.lists: dict[int, np.ndarray] = {}
        for i, term in enumerate(all_terms):
            number = block.vocabulary.get(term)
            if number is not None:
                self.counts[number] = all_counts[i]
                self.lists[number] = positions[ends[i] - all_counts[i] : ends[i]].astype(np.int64)

    def document(self, position):
        return np.searchsorted(self.starts, position, "right") - 1

    def find(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of a phrase, and which are exact: with ``slop``, each term may stand so many
        words from its place, in the same document."""
        order = np.argsort(self.counts[terms], kind="stable")
        start = self.lists[terms[order[0]]] - order[0]
        exact = np.ones(len(start), bool)
        for offset in order[1:]:
            held = self.lists[terms[offset]] - offset
            right = np.minimum(np.searchsorted(held, start), len(held) - 1)
            left = np.maximum(right - 1, 0)
            off = np.minimum(np.abs(held[right] - start), np.abs(held[left] - start))
            near = off <= slop
            start, exact = start[near], (exact & (off == 0))[near]
            if not len(start):
                break
        if slop and len(start):
            doc = self.document(np.maximum(start, 0))
            within = (start >= 0) & (start + len(terms) < self.starts[doc + 1])
            start, exact = start[within], exact[within]
        return start, exact


def _found(batch: pa.RecordBatch, block: Block, slop: int = 0):
    """Per segment of the batch: first_row, doc_ids, starts, and (phrase, starts, exact)."""
    for r in batch.to_pylist():
        starts = np.array(r["starts"], np.int64)
        segment = _Segment(starts, r["terms"], r["counts"], r["positions"], block)
        possible = np.flatnonzero((segment.counts[block.terms] > 0).all(axis=1))
        hits = []
        for p in possible:
            start, exact = segment.find(block.terms[p, : block.lengths[p]], slop)
            if len(start):
                hits.append((p, start, exact))
        yield r["first_row"], r["doc_ids"], starts, segment, hits


def matches(indexed: DataFrame, block: Block, slop: int = 0) -> DataFrame:
    """Every occurrence of the block's phrases: exact ones and, with ``slop``, near ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, doc_ids, starts, segment, hits in _found(batch, block, slop):
                for p, start, exact in hits:
                    doc = segment.document(start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(first_row + doc, pa.int64()),
                            pa.array([doc_ids[d] for d in doc], pa.int64()),
                            pa.array([block.item_ids[p]] * len(start), pa.list_(pa.string())),
                            pa.array(start - starts[doc], pa.int32()),
                            pa.array([block.lengths[p]] * len(start), pa.int32()),
                            pa.array(exact),
                        ],
                        names=["row", "doc_id", "item_ids", "start", "length", "exact"],
                    )

    return in_arrow(indexed, run, MATCHES)


def _hits(indexed: DataFrame, block: Block, all_rows: bool) -> DataFrame:
    """Per document the merged spans of its hit words and the items found; documents without
    any only if ``all_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, doc_ids, starts, segment, hits in _found(batch, block):
                change = np.zeros(starts[-1] + 1, np.int32)
                items: dict[int, set[str]] = {}
                for p, start, _ in hits:
                    np.add.at(change, start, 1)
                    np.add.at(change, start + block.lengths[p], -1)
                    for d in np.unique(segment.document(start)).tolist():
                        items.setdefault(d, set()).update(block.item_ids[p])
                hit = np.concatenate([[False], np.cumsum(change) > 0, [False]])
                edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
                spans: dict[int, list] = {}
                held_by = segment.document(edges[:, 0]).tolist()
                for d, (a, b) in zip(held_by, edges.tolist(), strict=True):
                    spans.setdefault(d, []).append([a - int(starts[d]), b - int(starts[d])])
                rows = range(len(doc_ids)) if all_rows else sorted(spans)
                n_words = [int(starts[d + 1] - starts[d] - 1) for d in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first_row + d for d in rows], pa.int64()),
                        pa.array([doc_ids[d] for d in rows], pa.int64()),
                        pa.array(n_words, pa.int64()),
                        pa.array([spans.get(d, []) for d in rows], pa.list_(pa.list_(pa.int32()))),
                        pa.array([sorted(items.get(d, ())) for d in rows], pa.list_(pa.string())),
                    ],
                    names=["row", "doc_id", "n_words", "spans", "items"],
                )

    return in_arrow(indexed, run, HITS)


_NOTHING = Block({}, np.zeros((0, 1), int), np.zeros(0, int), [])

_COVERED = """aggregate(
    array_sort(flatten(collect_list(spans))),
    named_struct('n', 0L, 'until', 0),
    (a, s) -> named_struct('n', a.n + greatest(0, s[1] - greatest(s[0], a.until)),
                           'until', greatest(a.until, s[1])),
    a -> a.n)"""


def hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_size: int = BLOCK_PHRASES
) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence) and the sorted item ids, a row per
    row of ``docs``. The first block lists all documents, later ones those with hits."""
    indexed = materialize(index(docs), "index")
    parts: list[DataFrame] = []
    for block in blocks(items, window, block_size):
        parts.append(_hits(indexed, block, all_rows=not parts))
    parts = parts or [_hits(indexed, _NOTHING, all_rows=True)]
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.expr(_COVERED).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, a row per document."""
    return hits(docs, items, window).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit word, all columns as they are, whatever their names.

    Rows are told apart by a hash of id and text, so equal rows share their fate.
    """
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select(key.alias("doc_id"), "text")
    bad = hits(keyed, items).where("n_hit > 0").select("doc_id").distinct()
    name = free_name(docs, "contaminated_key")
    bad = materialize(bad, "contaminated").withColumnRenamed("doc_id", name)
    return docs.join(bad, key == F.col(name), "left_anti")
