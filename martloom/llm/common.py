"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize

T = TypeVar("T")

SLICE_BYTES = 2 << 20

_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gave for ``key`` before in this worker. Only the last key is remembered: a
    worker that goes on to another operator does not keep the memory of the one before."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


#: Rows and bytes of the batches that a Python worker is handed.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in small batches.

    The session's usual batches of 10,000 texts stand several times in an executor's memory,
    on both sides of each of its workers, so the session is set to smaller ones. The worker
    hands back what a batch took.
    """
    for key, value in BATCHES.items():
        df.sparkSession.conf.set(key, value)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)

    return df.mapInArrow(task, schema)


def sliced(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches to about ``limit`` bytes of ``column`` each; a longer value comes alone.

    What a worker holds beside its input batch is then bounded by the longest text.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def encoded(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """``column.to_pylist()`` without an Arrow scalar for each value."""
    return column.to_numpy(zero_copy_only=False).tolist()


def one_spaced(text: bytes) -> bytes:
    """``text`` with each run of ``[\\x20\\x09-\\x0D]`` replaced by one space."""
    text = text.translate(_SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def task_id() -> int:
    """The partition number of the running task; 0 where no task runs, as in tests."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def fold(doc_id: str, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``, null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def _known(labels: DataFrame, label: str, fit: Column) -> DataFrame:
    known = labels.where(fit & F.col(label).isin(0, 1)).groupBy("doc_id")
    return known.agg(F.max(label).cast("int").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, fit: Column) -> DataFrame:
    """(text, y): every row of ``docs`` that a row of ``labels`` for which ``fit`` holds labels 0
    or 1."""
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    return texts.join(_known(labels, label, fit), "doc_id").select("text", "y")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, fit: Column, per_class: int
) -> DataFrame:
    """(doc_id, text, y): at most ``per_class`` documents of each label 0 and 1, chosen by a hash
    of the doc_id among the rows of ``labels`` for which ``fit`` holds."""
    known = _known(labels, label, fit)
    order = F.xxhash64("doc_id", F.lit(5))
    chosen = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    ids = materialize(chosen[0].unionByName(chosen[1]), "sample")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    found = texts.join(ids, "doc_id").groupBy("doc_id")  # rows that repeat an id give one text
    return materialize(found.agg(F.min("text").alias("text"), F.max("y").alias("y")), "texts")


def class_sizes(labels: DataFrame, label: str, fit: Column) -> tuple[int, int]:
    """Labelled rows of class 0 and of class 1 among those for which ``fit`` holds."""
    own = labels.where(fit)
    row = own.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    found = row.first()
    return found.n0, found.n1


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve of ``y`` over ``x`` (Platt scaling, with
    targets drawn in a little so that separable classes keep a finite slope)."""
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = x.std() or 1.0
    design = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (target - p)) - ridge * beta * np.array([1, 0])
        curve = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design
        step = np.linalg.solve(curve + ridge * np.eye(2), slope)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * x.mean() / scale)


def probability(x: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(curve[0] * x + curve[1], -30, 30)))
