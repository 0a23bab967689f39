"""Token ids in bit-plane shuffled binary files.

Texts are tokenized in ascending doc_id order into shards, one per range of ids, and each shard
is cut into blocks of BLOCK ids. A block's 32-bit ids are transposed into planes, the first byte
(or bit) of every id, then the second, and so on, and each plane is compressed with zstandard:
ids of a vocabulary below 65,536 leave the upper planes empty, and like bits stand together.

Layout below a folder: ``blocks`` has a row per block with its planes and the documents in it
(a document may go over several blocks); ``index`` has a row per block with its place, sizes
and a checksum of its ids, from which readers find the blocks of any range of ids. Both are
Parquet, so the files go to any store that Spark writes to, and a task that is run again
replaces its output.

Defined cases: a null text is empty and has the end id only; rows that repeat a doc_id are
written one after another, by text; a null doc_id comes last.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, in_arrow, sliced, strings, task_id
from martloom.operators.scratch import scratch_path

BLOCK = 1 << 16
END_ID = 2
LEVEL = 3
_KNOWN_PIECES = 300_000
_KNOWN_LETTERS = 4_000_000

BLOCKS = (
    "shard int, block int, first bigint, n_ids int, plane_bits int, crc32 bigint,"
    " doc_ids array<bigint>, places array<bigint>, lengths array<int>, planes array<binary>"
)
PARTS = "shard int, place bigint, doc_id bigint, block int, first bigint, n int, crc32 bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PieceTokenizer:
    """Ids of whole texts, put together from the ids of their white-space separated pieces.

    For a tokenizer that drops white space and lower-cases, such as ``word_bpe_49k``: no token
    reaches over white space, so each distinct piece is encoded once and remembered, until there
    are _KNOWN_PIECES of them or, as in texts without white space, _KNOWN_LETTERS in them.
    """

    _PLAIN = "^[a-zß-öø-ÿ]+[.,]?$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.marks = {m: self._whole(m) for m in (".", ",")}
        # byte-level models name a byte by a printable character
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        self.byte_names = {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}
        self._forget()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.letters = 0
        self.lengths, self.flat = array("q"), array("I")

    def _ids(self, word: str) -> list[int]:
        """Ids of plain lower-case letters."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.byte_names)
        return [token.id for token in self.model.tokenize(word)]

    def _learn(self, plain: list[str], others: list[str]) -> None:
        """Remember the ids of plain words, and of any other pieces."""
        known = self.numbers
        plain, others = [w for w in plain if w not in known], [p for p in others if p not in known]
        found = [self._ids(w) for w in plain]
        found += [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        known.update(zip(plain + others, range(len(known), len(known) + len(found)), strict=True))
        self.letters += sum(map(len, plain)) + sum(map(len, others))
        self.lengths.extend(map(len, found))
        self.flat.extend(chain.from_iterable(found))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        # "<|" may begin a special token, whose letters must stay as they are
        special = pc.match_substring(texts, "<|")
        lists = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        encoded = lists.flatten().dictionary_encode()
        ids, lengths = self._piece_ids(encoded.dictionary)
        ids, lengths = _gathered(ids, lengths, encoded.indices.to_numpy())
        pieces = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        return ids, np.diff(np.concatenate([[0], np.cumsum(lengths)])[pieces])

    def _piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after another, and how many each has. A plain word is
        remembered without the mark after it, which is a token of its own."""
        if len(self.numbers) > _KNOWN_PIECES or self.letters > _KNOWN_LETTERS:
            self._forget()
        plain = pc.match_substring_regex(pieces, self._PLAIN)
        words = pc.if_else(plain, pc.utf8_rtrim(pieces, ".,"), pieces)
        words = words.dictionary_encode()
        distinct = words.dictionary
        letters = pc.match_substring_regex(distinct, self._PLAIN)  # other pieces have none alone
        self._learn(strings(distinct.filter(letters)), strings(distinct.filter(pc.invert(letters))))
        numbers = np.array([self.numbers[w] for w in strings(distinct)], np.int64)
        numbers = numbers[words.indices.to_numpy()]
        ids, lengths = _gathered(
            np.frombuffer(self.flat, np.uint32), np.frombuffer(self.lengths, np.int64), numbers
        )
        ends = np.cumsum(lengths)
        for mark, own in self.marks.items():
            at = np.flatnonzero(pc.and_(plain, pc.ends_with(pieces, mark)).to_numpy(False))
            ids = np.insert(ids, np.repeat(ends[at], len(own)), np.tile(own, len(at)))
            lengths[at] += len(own)
            ends = np.cumsum(lengths)
        return ids, lengths


def _gathered(flat: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values one after another, ``lengths`` to each entry, those of the entries ``numbers``."""
    if not len(numbers):
        return np.zeros(0, flat.dtype), np.zeros(0, np.int64)
    starts, own = (np.cumsum(lengths) - lengths)[numbers], lengths[numbers]
    ends = np.cumsum(own)
    at = np.repeat(starts - (ends - own), own) + np.arange(int(ends[-1]))
    return flat[at], own


def tokenizer(path: str) -> PieceTokenizer:
    return held(("tokenizer", path), lambda: PieceTokenizer(path))


def to_planes(ids: np.ndarray, plane_bits: int = 8) -> list[bytes]:
    """The planes of a block of 32-bit ids: 4 of bytes or 32 of bits."""
    held = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if plane_bits == 1:
        held = np.packbits(np.unpackbits(held, axis=1, bitorder="little"), axis=0)
    return [np.ascontiguousarray(plane).tobytes() for plane in held.T]


def from_planes(planes: list[bytes], n: int, plane_bits: int = 8) -> np.ndarray:
    held = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    if plane_bits == 1:
        held = np.packbits(np.unpackbits(held, axis=0, count=n), axis=1, bitorder="little")
    return np.ascontiguousarray(held).view("<u4").ravel()


def _with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(lengths), end), lengths + 1


def _blocks(docs: DataFrame, path: str, end: int, block: int, plane_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, number, first = task_id(), 0, 0, 0
        packer = zstandard.ZstdCompressor(level=LEVEL)
        held: list[np.ndarray] = []
        parts: list[tuple] = []  # doc_id, place, ids in this block
        size = 0

        def emit() -> pa.RecordBatch:
            nonlocal held, parts, size, number, first
            ids = np.concatenate(held)
            planes = [packer.compress(p) for p in to_planes(ids, plane_bits)]
            row = {
                "shard": shard, "block": number, "first": first, "n_ids": size,
                "plane_bits": plane_bits, "crc32": zlib.crc32(ids.astype("<u4").tobytes()),
                "doc_ids": [p[0] for p in parts], "places": [p[1] for p in parts],
                "lengths": [p[2] for p in parts], "planes": planes,
            }
            held, parts, number, first, size = [], [], number + 1, first + size, 0
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64())]
            + [("n_ids", pa.int32()), ("plane_bits", pa.int32()), ("crc32", pa.int64())]
            + [("doc_ids", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))]
            + [("lengths", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary()))]
        )
        for batch in sliced(batches, "text"):
            texts = pc.fill_null(batch.column("text"), "")
            ids, lengths = _with_end(*tokenizer(path).encode(texts), end)
            at = 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), lengths.tolist(), strict=True):
                left = n
                while left:
                    now = min(left, block - size)
                    held.append(ids[at : at + now])
                    parts.append((doc_id, place, now))
                    at, left, size = at + now, left - now, size + now
                    if size == block:
                        yield emit()
                place += 1
        if size:
            yield emit()

    return in_arrow(docs, run, BLOCKS)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str | None = None,
    end: int = END_ID,
    block: int = BLOCK,
    plane_bits: int = 8,
) -> None:
    """Write ``blocks`` and ``index`` of the whole texts below ``folder``."""
    path = tokenizer_path or default_tokenizer()
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(*order)
    blocks = _blocks(ranged.sortWithinPartitions(*order), path, end, block, plane_bits)
    blocks.write.mode("overwrite").parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    sizes = F.transform("planes", F.octet_length).alias("plane_bytes")
    index = stored.select("shard", "block", "first", "n_ids", "plane_bits", "crc32", sizes)
    index.write.mode("overwrite").parquet(f"{folder}/index")


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all shards before each shard, from the index; one row per shard."""
    index = spark.read.parquet(f"{folder}/index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))


def decoded(row: dict) -> np.ndarray:
    """The ids of one row of ``blocks``, checked against its checksum."""
    unpack = zstandard.ZstdDecompressor()
    planes = [unpack.decompress(p) for p in row["planes"]]
    ids = from_planes(planes, row["n_ids"], row["plane_bits"])
    if zlib.crc32(ids.tobytes()) != row["crc32"]:
        raise ValueError(f"shard {row['shard']}, block {row['block']}: checksum differs")
    return ids


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and block, with a checksum of the ids that the block has of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time
                row = batch.slice(i, 1).to_pylist()[0]
                data = decoded(row).tobytes()
                lengths = row["lengths"]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["places"], pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["block"]] * n, pa.int32()),
                        pa.array(row["first"] + starts, pa.int64()),
                        pa.array(lengths, pa.int32()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["shard", "place", "doc_id", "block", "first", "n", "crc32"],
                )

    return in_arrow(spark.read.schema(BLOCKS).parquet(f"{folder}/blocks"), run, PARTS)


def joined_crc32(parts: list[tuple[int, int]]) -> int:
    """The crc32 of data given as (crc32, length in bytes) of its consecutive parts: a
    checksum is carried over the next part as over so many zeros, whose own is taken off."""
    total = parts[0][0]
    for crc, length in parts[1:]:
        zeros = bytes(length)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 per document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("parts").to_pylist()
            sums = [joined_crc32([(p["crc32"], 4 * p["n"]) for p in own]) for own in lists]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    parts = F.array_sort(F.collect_list(F.struct("block", "n", "crc32"))).alias("parts")
    whole = (
        _parts(spark, folder)
        .groupBy("shard", "place")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.min("first").alias("first"),
            F.sum("n").alias("n_tokens"),
            parts,
        )
        .join(shard_starts(spark, folder), "shard")
        .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "parts")
    )
    return in_arrow(whole, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_and_read(docs: DataFrame) -> DataFrame:
    """Write the files of ``docs`` below the scratch folder and read their digests back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write(docs, folder)
    return read_digests(docs.sparkSession, folder)
