"""Product codes of vectors by exact integer arithmetic: limb-split products, first argmin.

Each component x becomes floor(256 * x). A vector is cut into equal consecutive parts, and every
part is coded by the index of the nearest entry of its position's codebook. The codebooks start
as the parts of the first vectors by id and are moved by a few rounds of integer means.

Distances are exact. |a - b|^2 = |a|^2 - 2ab + |b|^2, where the products ab come from float64
matrix products: the integers are broken into limbs of so few bits that a sum of their products
stays below 2**53, where float64 still counts by ones, and the products of limbs are put together
again in int64. The first smallest distance wins, so ties go to the lower index on any machine
and with any matrix library. Batches or codebooks with numbers so large that a squared distance
may leave int64 are counted with Python's integers instead.

A round is one scan: tasks hand back a row of sums for each entry they used, whatever their
number of vectors, and these are added up by Spark. Only codebooks (``entries`` times the
dimension) reach the driver and the tasks.

Defined cases: rows without a vector, or with a null or non-finite component, are left out. A
vector shorter than the longest one, or whose length ``parts`` does not divide, is filled with
zeros at its end. Rows with equal ids are coded row by row; as codebook starts they follow by
vector, and rows without an id come last. With fewer rows than ``entries`` the codebooks are that
much smaller; an empty table has no rows. An error, or a label's sum of errors, is null where it
exceeds a BIGINT. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import in_arrow
from martloom.operators.scratch import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

EXACT = 53  # float64 holds every integer up to 2**53
LIMB = 60  # sums travel as numbers of so many bits, whatever their size
CODES = "vec_id bigint, code string, error bigint, label {label}"
SUMS = "part int, entry int, place int, limb int, total bigint, n bigint"

_LONGEST = 2**63 - 1


class Codebooks(NamedTuple):
    """``values[part][entry]`` is a list of Python integers, ``width`` numbers long."""

    values: list[list[list[int]]]
    width: int

    def digest(self) -> str:
        numbers = [str(x) for part in self.values for entry in part for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def limbs(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """int64 numbers as float64 arrays with ``numbers == sum(limb[k] << (k * bits))``: the lower
    ones in 0 .. 2**bits - 1, the last one signed and of at most ``bits`` bits."""
    found = []
    while numbers.size and (numbers.max() >= 1 << bits or numbers.min() < -(1 << bits)):
        found.append((numbers & ((1 << bits) - 1)).astype(np.float64))
        numbers = numbers >> bits
    return [*found, numbers.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices whose true products fit int64."""
    bits = (EXACT - max(a.shape[1], 1).bit_length()) // 2
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for k, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << ((i + k) * bits)
    return out


def _fits(width: int, *arrays: np.ndarray) -> bool:
    """True where no squared distance, nor its three parts, can leave int64."""
    largest = max((max(abs(int(x.min())), abs(int(x.max()))) for x in arrays if x.size), default=0)
    return 4 * max(width, 1) * largest * largest < 2**62


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest row of ``entries`` for each row of ``vectors``, and its squared
    distance. Both are integer matrices of int64, or of Python's integers (dtype object)."""
    if vectors.dtype != object and entries.dtype != object and _fits(vectors.shape[1], vectors, entries):
        own, other = (vectors * vectors).sum(1), (entries * entries).sum(1)
        distances = own[:, None] - 2 * exact_products(vectors, entries) + other[None, :]
    else:
        distances = np.zeros((len(vectors), len(entries)), object)
        for k in range(vectors.shape[1]):
            gap = vectors[:, k].astype(object)[:, None] - entries[:, k].astype(object)[None, :]
            distances += gap * gap
    best = distances.argmin(1)
    return best, distances[np.arange(len(vectors)), best]


def integers(values: np.ndarray) -> np.ndarray:
    """floor(256 * x); as Python's integers where int64 is too small."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        wide = [int(x) if np.isfinite(x) else int(v) * SCALE for x, v in zip(scaled.flat, values.flat, strict=True)]
        out = np.empty(len(wide), object)
        out[:] = wide
        return out.reshape(values.shape)
    return scaled.astype(np.int64)


def _kept(column: Column) -> Column:
    return column.isNotNull() & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def _matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The finite vectors of a batch, filled up with zeros to ``width``, and their row numbers."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy().astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)  # null components become NaN
    row_of = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0), np.maximum(sizes, 0))
    good = sizes >= 0
    good[row_of[~np.isfinite(flat)]] = False
    out = np.zeros((len(sizes), width))
    out[row_of, place] = flat
    rows = np.flatnonzero(good)
    return integers(out[rows]), rows


def _arrays(books: Codebooks) -> list[np.ndarray]:
    """An integer matrix for each part, of int64 where that holds its numbers."""
    found = []
    for entries in books.values:
        book = np.empty((len(entries), books.width), object)
        for e, entry in enumerate(entries):
            book[e] = entry
        small = all(abs(x) < 2**62 for x in book.flat)
        found.append(book.astype(np.int64) if small else book)
    return found


def _coded(matrix: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x parts) indexes, and the squared distances summed over the parts."""
    width = books[0].shape[1]
    cut = [matrix[:, p * width : (p + 1) * width] for p in range(len(books))]
    found = [nearest(x, book) for x, book in zip(cut, books, strict=True)]
    wide = any(d.dtype == object or (d >= 2**58).any() for _, d in found)  # 16 sum to 2**62
    kind = object if wide or len(books) > 16 else np.int64
    return np.stack([i for i, _ in found], 1), sum(d.astype(kind) for _, d in found)


def _rows(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    return vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).alias("label"),
    )


def _start(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    kept = rows.where(_kept(F.col("vector")))
    longest = kept.agg(F.max(F.size("vector")).alias("n")).first().n or 0
    width = -(-longest // parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    matrix = np.zeros((len(first), width * parts))
    for i, row in enumerate(first):
        matrix[i, : len(row.vector)] = row.vector
    whole = integers(matrix).tolist()
    values = [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]
    return Codebooks(values, width)


def _split(number: int) -> list[int]:
    """Limbs of LIMB bits, the lowest first; the last one carries the sign."""
    found = []
    while not -(1 << LIMB) <= number < 1 << LIMB:
        found.append(number & ((1 << LIMB) - 1))
        number >>= LIMB
    return [*found, number]


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, place, limb, total, n): sums of the components coded by each used entry, in
    limbs of LIMB bits."""
    parts, width = len(books.values), books.width
    total = books.width * parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, arrays = len(books.values[0]), _arrays(books)
        totals = np.zeros((parts, size, width), object)
        counts = np.zeros((parts, size), np.int64)
        for batch in batches:
            matrix, _ = _matrix(batch.column("vector"), total)
            if not len(matrix):
                continue
            codes, _ = _coded(matrix, arrays)
            for p in range(parts):
                own = matrix[:, p * width : (p + 1) * width]
                part = np.zeros((size, width), own.dtype)
                if own.dtype != object and not _fits(len(own), own):
                    own, part = own.astype(object), part.astype(object)
                np.add.at(part, codes[:, p], own)
                totals[p] += part.astype(object)
                counts[p] += np.bincount(codes[:, p], minlength=size)
        found = []
        for p, e in zip(*map(np.ndarray.tolist, counts.nonzero()), strict=True):
            for k in range(width):
                for limb, x in enumerate(_split(int(totals[p, e, k]))):
                    found.append((p, e, k, limb, x, int(counts[p, e])))
        if found:
            kinds = [pa.int32()] * 4 + [pa.int64()] * 2
            columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "limb", "total", "n"])

    return in_arrow(rows, run, SUMS)


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry becomes the floor of the mean of what it codes."""
    sums = _sums(rows, books).groupBy("part", "entry", "place", "limb")
    values = [[list(entry) for entry in part] for part in books.values]
    totals, counts = Counter(), Counter()
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    # a few rows per component of the codebooks, whatever the number of vectors
    for r in sums.agg(total, F.sum("n").alias("n")).collect():
        at = (r.part, r.entry, r.place)
        totals[at] += int(r.total) << (LIMB * r.limb)
        counts[at] = max(counts[at], r.n)  # every vector has a lowest limb
    for (p, e, k), x in totals.items():
        values[p][e][k] = x // counts[p, e, k]
    return Codebooks(values, books.width)


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = _start(rows, parts, entries)
    if books.values[0]:
        for _ in range(rounds):
            books = _moved(rows, books)
    return books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, code, error, label) of each kept row."""
    total = books.width * len(books.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(books)
        for batch in batches:
            matrix, kept = _matrix(batch.column("vector"), total)
            if not len(kept):
                continue
            codes, errors = _coded(matrix, arrays)
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            taken = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(taken),
                    pa.array(text, pa.string()),
                    pa.array([x if x <= _LONGEST else None for x in errors.tolist()], pa.int64()),
                    batch.column("label").take(taken),
                ],
                names=["vec_id", "code", "error", "label"],
            )

    label = rows.schema["label"].dataType.simpleString()
    return in_arrow(rows, run, CODES.format(label=label))


def compressed(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each row with a finite vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = _rows(vectors, vec_id, vector, label)
    books = trained(rows, parts, entries, rounds)
    if not books.values[0]:
        none = rows.where(F.lit(False)).select("vec_id", F.lit("").alias("code"))
        return none.select("*", *[F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")],
                           F.lit(books.digest()).alias("codebooks_sha256"))
    codes = materialize(coded(rows, books), "codes")
    # A row per label, combined before the shuffle; written, so that its size is known when joined.
    error = F.col("error").cast("decimal(38,0)")
    total = F.when(F.count_if(error.isNull()) == 0, F.sum(error))
    own = codes.groupBy(F.col("label").alias("_label")).agg(
        F.when(total <= _LONGEST, total).cast("bigint").alias("label_error")
    )
    joined = codes.join(materialize(own, "label_errors"), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
