from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from martloom.llm import string_kernel as sk
from martloom.llm.common import logistic, probability, table

SCHEMA = "text string, score double, doc_id bigint, lang string, source string, margin int"
LABELS = "doc_id bigint, quality int, toxic int, y int"
BAD = ["grobbel", "snarfly", "quizzert", "plonkash"]


def brute_kernel(a, b):
    """Sum over all letter triples within the span, by definition."""

    def space(word):
        word = "^" + word + "$"
        found = {}
        for i, j, k in combinations(range(len(word)), 3):
            if k - i < sk.SPAN:
                key = (word[i], word[j], word[k])
                key = tuple("^" if c in "^$" else c for c in key)
                found[key] = found.get(key, 0) + sk.DECAY ** (k - i + 1 - 3)
        return found

    x, y = space(a), space(b)
    dot = sum(v * y.get(t, 0) for t, v in x.items())
    return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_kernel_against_its_definition():
    words = ["stupid", "stuupid", "a", "ab", "aaaaaaa", "banana", "bandana", "straße", "x"]
    got = sk.kernel(words, sk._landmark_table(words))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-5)


def test_folding_the_landmarks_changes_no_margin():
    positive = {w: 9.0 for w in BAD}
    rng = random.Random(1)
    negative = {"".join(rng.choice("aeioulrmn") for _ in range(6)): 3.0 for _ in range(80)}
    landmarks = [*BAD, *list(negative)[:20]]
    weights, offset = sk.train_words(positive, negative, landmarks)
    model = sk.Model(weights.astype(np.float32).tobytes(), offset, (1.0, 0.0))
    words = ["grobbel", "grobxbel", "anelor"]
    table_ = sk._landmark_table(landmarks)
    alpha = np.linalg.lstsq(table_.astype(float), weights.astype(float), rcond=None)[0]
    assert model.margins(words) == pytest.approx(sk.kernel(words, table_) @ alpha + offset, abs=1e-3)


def corpus(n=700, seed=3):
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice(["ta", "re", "mi", "lo", "ne", "shi", "or", "un"]) for _ in range(rng.randint(1, 4)))

    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        text = ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        docs.append((text, None, i, "xx", None, 0))
        if i % 3:
            labels.append((i, 1, toxic, 0))
    return docs, labels


def test_held_out_labels_and_bent_words(spark):
    docs, labels = corpus()
    good = docs[0][0].split(".")[0]
    odd = [("", 10_000), (None, 10_001), ("?! 12", 10_002), ("ta " * 200_000 + "snarfly", 10_003)]
    odd += [("ta re s n a r f l y lo", 10_004), ("ta gro-bbel lo", 10_005), ("ta plonkxash", 10_006)]
    odd += [("ta.re,quizzert/lo", 10_009)]
    odd += [("SNARFLY!", None), ("x" * 300_000, 10_007), (good, 10_008), (good, 10_008)]
    rows = docs + [(t, None, i, None, None, 0) for t, i in odd]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    truth = {r[0]: r[2] for r in labels}
    got = sk.scored(frame, spark.createDataFrame([*labels, (None, 1, 1, 0), (5, 1, None, 0)], LABELS)).collect()
    assert len(got) == len(rows)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97
    for r in got:
        crc = zlib.crc32(str(r.doc_id).encode()) % 4 if r.doc_id is not None else None
        assert r.held_out == (crc == 2) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= sk.THRESHOLD)
    by_id = {r.doc_id: r.predicted for r in got}
    assert [by_id[10_000 + i] for i in range(9)] == [0, 0, 0, 1, 1, 1, 1, 0, 0] and by_id[None] == 1
    assert by_id[10_009] == 1


def test_labels_held_out_are_never_learned(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, SCHEMA)
    flipped = [
        (i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t, y) for i, q, t, y in labels
    ]
    first = sk.fit(frame, spark.createDataFrame(labels, LABELS), ~sk._held_out())
    second = sk.fit(frame, spark.createDataFrame(flipped, LABELS), ~sk._held_out())
    assert first == second


def test_accepted_keeps_columns_and_clean_rows(spark):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels, LABELS)
    kept = sk.accepted(frame, known)
    assert kept.schema == frame.schema
    predicted = {r.doc_id: r.predicted for r in sk.scored(frame, known).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in predicted.items() if not p}


def test_without_labels_every_text_has_the_prior(spark):
    docs, labels = corpus(40)
    frame = spark.createDataFrame(docs, SCHEMA)
    for known in ([], [r for r in labels if not r[2]]):
        scores = {r.score for r in sk.scored(frame, spark.createDataFrame(known, LABELS)).collect()}
        assert len(scores) == 1
    assert sk.scored(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).count() == 0


def test_calibration_follows_the_share():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    slope, offset = logistic(x, y, np.ones(4000))
    assert slope == pytest.approx(2, abs=0.3) and offset == pytest.approx(-1, abs=0.2)
    assert probability(np.array([0.5]), (2.0, -1.0))[0] == pytest.approx(0.5)


def test_held_out_accuracy_on_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = sk.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hit = [r.predicted == r.toxic for r in rows]
    assert len(hit) > 60 and np.mean(hit) > 0.9


CYRILLIC_BAD = ["дуралей", "мерзавка", "болванчик"]


def cyrillic_corpus(n=700, seed=5):
    """Clean words as long as the insults are in every text."""
    rng = random.Random(seed)
    clean = ["".join(rng.choice("авекноптуы") for _ in range(k)) for k in (7, 8, 9) for _ in range(60)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.4)
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(CYRILLIC_BAD))
        text = ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        docs.append((text, None, i, "ru", None, 0))
        labels.append((i, 1, toxic, 0))
    return docs, labels


def test_letters_beyond_a_to_z_are_told_apart():
    words = ["дуралей", "приятно", "дурралей", "侮辱的话", "友好的话", "βλάκας", "straße", "strasse"]
    got = sk.kernel(words, sk._landmark_table(words))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(brute_kernel(a, b), abs=0.1)  # hashes may meet


def test_insults_of_another_script(spark):
    docs, labels = cyrillic_corpus()
    odd = [("ноты ДУРАЛЕЙ окно", 10_000), ("ноты дурралей окно", 10_001), ("ноты окно авекноп", 10_002)]
    frame = spark.createDataFrame(docs + [(t, None, i, None, None, 0) for t, i in odd], SCHEMA)
    got = sk.scored(frame, spark.createDataFrame(labels, LABELS)).collect()
    truth = {r[0]: r[2] for r in labels}
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean(held) > 0.97
    by_id = {r.doc_id: r.predicted for r in got}
    assert [by_id[10_000 + i] for i in range(3)] == [1, 1, 0]


def test_evidence_reads_more_than_the_calibration_sample(spark, monkeypatch):
    """One insult is in too few texts of a sample to stand out there."""
    docs, labels = corpus(900)
    rows = [(t.replace("snarfly", "ta").replace("quizzert", "ta"), *r) for t, *r in docs]
    toxic = [i for i, _, t, _ in labels if t]
    for k, i in enumerate(toxic):
        text = rows[i][0]
        if k % 3 == 0:
            text += f". vuxwyck lo{k}"
        rows[i] = (text, *rows[i][1:])
    monkeypatch.setattr(sk, "PER_CLASS", 30)
    learned, train = set(), sk.train_words
    monkeypatch.setattr(sk, "train_words", lambda p, *rest: learned.update(p) or train(p, *rest))
    known = spark.createDataFrame(labels, LABELS)
    sk.fit(spark.createDataFrame(rows, SCHEMA), known, ~sk._held_out())
    assert {"vuxwyck", "grobbel"} <= learned


def test_evidence_and_scores_read_the_same_words(spark):
    """Any white space parts pieces, signs part words, and long words are read in parts."""
    long = "".join("abcdefghij"[i % 10] for i in range(95))
    text = f"今天　愚か者　天気 idiot/moron Été, ta-re {long}"
    counts, totals = sk.word_counts(spark.createDataFrame([(text, 1), (text.upper(), 1), (None, 0)], "text string, y int"))
    learned = {r.word for r in counts.collect()}
    pieces, _, _ = sk._pieces(sk.pa.array([text]))
    read, numbers, _, _ = sk._words(pieces)
    assert learned == set(read) and (totals.all1, totals.all0) == (1, 1)
    assert {"愚か者", "idiotmoron", "idiot", "moron", "ete", "tare"} <= learned
    assert all(len(w) <= sk.LONGEST for w in learned)
