from __future__ import annotations

import random
import zlib

import numpy as np

from martloom.llm import compression_quality as cq
from martloom.llm.common import table

SCHEMA = "text string, score double, doc_id bigint, lang string, y string, difference int"
LABELS = "doc_id bigint, quality int, toxic int, y int"


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    parts = ["ta", "re", "mi", "lo", "ne", "shi", "or", "un", "ka", "el"]

    def say(k):
        return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(k)]

    docs, labels = [], []
    for i in range(n):
        good = int(rng.random() < 0.7)
        words = say(rng.randint(40, 300))
        text = " ".join(words) + "." if good else " ".join(f"{w.upper()}!!" for w in words)
        docs.append((text, None, i, "xx", None, 0))
        if i % 3:
            labels.append((i, good, 0, 0))
    return docs, labels


def test_held_out_labels_and_odd_texts(spark):
    docs, labels = corpus()
    odd = [("", 10_000), (None, 10_001), ("x" * 500_000, 10_002), (docs[0][0], None), ("\U0001f600", 10_003)]
    rows = docs + [(t, None, i, None, None, 0) for t, i in odd] + docs[:5]
    got = cq.scored(
        spark.createDataFrame(rows, SCHEMA).repartition(4),
        spark.createDataFrame([*labels, (None, 1, 1, 0), (5, None, 1, 0)], LABELS),
    ).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[1] for r in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95
    for r in got:
        crc = zlib.crc32(str(r.doc_id).encode()) % 5 if r.doc_id is not None else None
        assert r.held_out == (crc == 0) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= cq.THRESHOLD)
    assert len({r.score for r in got if r.doc_id in (10_000, 10_001)}) == 1


def test_labels_held_out_are_never_learned(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, SCHEMA)
    flipped = [
        (i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t, y) for i, q, t, y in labels
    ]
    first = cq.fit(frame, spark.createDataFrame(labels, LABELS), ~cq._held_out())
    second = cq.fit(frame, spark.createDataFrame(flipped, LABELS), ~cq._held_out())
    assert first == second


def test_without_labels_every_text_has_the_prior(spark):
    docs, labels = corpus(40)
    frame = spark.createDataFrame(docs, SCHEMA)
    for known in ([], [r for r in labels if r[1]]):
        scores = {r.score for r in cq.scored(frame, spark.createDataFrame(known, LABELS)).collect()}
        assert len(scores) == 1
    assert cq.scored(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).count() == 0


def test_short_texts_alone_are_learned(spark):
    docs, labels = corpus()
    docs = [(t[:40], *r) for t, *r in docs]
    got = cq.scored(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    truth = {r[0]: r[1] for r in labels}
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean(held) > 0.9


def test_few_passages_serve_as_they_are():
    model = cq.dictionaries([b"the quick brown fox " * 5], [b"BUY NOW!! CHEAP!! " * 5])
    assert cq.difference(b"the quick brown fox jumps", model) > 0
    assert cq.difference(b"CHEAP!! BUY NOW!!", model) < 0 == cq.difference(b"", model)


def test_held_out_accuracy_on_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = cq.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hit = [r.predicted == r.quality for r in rows]
    assert len(hit) > 60 and np.mean(hit) > 0.9
