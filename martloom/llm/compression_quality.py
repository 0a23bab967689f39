"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is built from passages of good labelled documents, one from bad ones. A passage
of a bad document may be a good one, and the other way round, so dictionaries are built anew
from the passages that they themselves put on their own side. A text is compressed in blocks,
so that the dictionaries and not the text's own beginning decide, with both; the difference of
the two sizes over the text's length, calibrated on labelled documents, is its score. For the
calibration each labelled document is measured with dictionaries built without its part of the
sample, as its own passages would flatter it.

Defined cases: a null or empty text has the difference 0; without labels of both classes, or
where a class has no passage of its own or all of them are in one part of the sample, each text
has the share of label 1 as its score; a null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import (
    class_sizes,
    encoded,
    fold,
    in_arrow,
    labelled_sample,
    logistic,
    sliced,
)

PER_CLASS = 2000  # labelled documents of each class to fit on
PASSAGES = 12_000  # distinct passages of each class for the dictionaries, at most
PASSAGE = 512  # bytes
SHORTEST = 64  # bytes; shorter passages come after all others
BLOCK = 2048  # bytes of a text that are compressed at once
DICTIONARY = 1 << 16
LEVEL = 3
ROUNDS = 2
PARTS = 3  # of the sample, for the calibration
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    curve: tuple[float, float]


def _dictionary(passages: list[bytes]) -> bytes:
    """A trained dictionary; the passages themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, passages).as_bytes()
    except zstandard.ZstdError:
        return b"".join(passages)[-DICTIONARY:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def difference(text: bytes, model: Model) -> float:
    """Bytes saved by the good over the bad dictionary, over the length of the text."""
    good, bad = _compressor(model.good), _compressor(model.bad)
    saved = 0
    for at in range(0, len(text), BLOCK):
        block = text[at : at + BLOCK]
        saved += len(bad.compress(block)) - len(good.compress(block))
    return saved / max(1, len(text))


def dictionaries(good: list[bytes], bad: list[bytes]) -> Model:
    model = Model(_dictionary(good), _dictionary(bad), (1.0, 0.0))
    for _ in range(ROUNDS):
        own_good = [p for p in good if difference(p, model) > 0]
        own_bad = [p for p in bad if difference(p, model) <= 0]
        model = Model(_dictionary(own_good or good), _dictionary(own_bad or bad), (1.0, 0.0))
    return model


def passages(sample: DataFrame) -> DataFrame:
    """Distinct (y, passage, part) of the sample's whole texts; a passage of both classes is left
    out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found: list[bytes] = []
            owners: list[int] = []
            for i, text in enumerate(encoded(batch.column("text"))):
                own = [text[at : at + PASSAGE] for at in range(0, len(text), PASSAGE)]
                found += own
                owners += [i] * len(own)
            labels = batch.select(["y", "part"]).take(pa.array(owners, pa.int32()))
            yield labels.append_column("passage", pa.array(found, pa.binary()))

    cut = in_arrow(sample.select("y", "part", "text"), run, "y int, part int, passage binary")
    once = cut.groupBy("passage").agg(
        F.min("y").alias("y"), F.max("y").alias("last"), F.min("part").alias("part")
    )
    return once.where("y = last").select("y", "passage", "part")


def fit(docs: DataFrame, labels: DataFrame, held_in) -> Model:
    """Train on labelled documents for which ``held_in`` (a column of ``labels``) holds."""
    n0, n1 = class_sizes(labels, "quality", held_in)
    prior = (n1 + 1) / (n0 + n1 + 2)
    constant = Model(b"", b"", (0.0, float(np.log(prior / (1 - prior)))))
    if not n0 or not n1:
        return constant
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    sample = labelled_sample(docs, labels, "quality", held_in, PER_CLASS).withColumn("part", part)
    found = passages(sample)
    sides = []
    for y in (1, 0):
        short = F.octet_length("passage") < SHORTEST
        chosen = found.where(F.col("y") == y).orderBy(short, F.xxhash64("passage"), "passage")
        sides.append([(bytes(r.passage), r.part) for r in chosen.limit(PASSAGES).collect()])
    if not all(sides):
        return constant
    rows = []
    for k in range(PARTS):
        others = [[p for p, own in side if own != k] for side in sides]
        if all(others):
            texts = sample.where(F.col("part") == k).select("y", "text")
            rows += _differences(texts, "y", "int", dictionaries(*others)).collect()
    if not rows:
        return constant
    model = dictionaries(*[[p for p, _ in side] for side in sides])
    x, y = np.array([r.difference for r in rows]), np.array([r.y for r in rows])
    share = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum()))
    return Model(model.good, model.bad, logistic(x, y, share * len(y) / share.sum()))


def _differences(texts: DataFrame, key: str, kind: str, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [difference(t, model) for t in encoded(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(found, pa.float64())], names=[key, "difference"]
            )

    return in_arrow(texts, run, f"{key} {kind}, difference double")


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(fold(doc_id, 5) == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, a row per row of ``docs``."""
    model = fit(docs, labels, ~_held_out())
    own = docs.select(F.col("doc_id").cast("bigint"), "text")
    exponent = F.col("difference") * model.curve[0] + model.curve[1]
    found = _differences(own, "doc_id", "bigint", model).withColumn(
        "score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), exponent))))
    )
    return found.select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
