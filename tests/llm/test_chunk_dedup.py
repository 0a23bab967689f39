from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from martloom.llm import chunk_dedup

SCHEMA = "text string, keep_id string, doc_id bigint, recipe int"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t, _ in rows]
    out = []
    for i, (_, doc_id) in enumerate(rows):
        same = [j for j in range(len(rows)) if norm[j] == norm[i]]
        first = min(same, key=lambda j: (rows[j][1] is None, rows[j][1] or 0, j))
        digest = hashlib.sha256(norm[i].encode()).hexdigest()
        out.append((doc_id, rows[first][1], len(same), i == first, digest))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = ["ab", "çé", "the", "zz", " x", "日本"]
    long = " ".join(rng.choice(words) + str(rng.random()) for _ in range(9000))
    rows = [(None, 1), ("", 2), (" ", 3), ("\t\n", 4), ("a  b", 7), ("a\x0bb", 6), ("a b", 6)]
    rows += [(long, 20), (long.replace(" ", "\r\n"), 19), (long + "x", 21), ("x" * 100_000, None)]
    rows += [("x" * 100_000, None), ("a b", None), ("solo", 8)]
    rows += [(" ".join(rng.choice(words) for _ in range(2)), 100 + i) for i in range(200)]
    docs = spark.createDataFrame([(t, "clash", i, 1) for t, i in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in chunk_dedup.groups(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    assert chunk_dedup.groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cuts_do_not_depend_on_the_neighbours():
    rng = np.random.default_rng(1)
    a, b = rng.bytes(50_000), rng.bytes(20_000)
    alone = chunk_dedup.cut_points(a, np.array([len(a)]))
    after = chunk_dedup.cut_points(b + a, np.array([len(b), len(b) + len(a)]))
    assert list(alone) == [x - len(b) for x in after if x > len(b)]
    assert max(np.diff(alone, prepend=0)) <= chunk_dedup.LONGEST and len(alone) > 20


def test_equal_passages_share_chunks(spark):
    rng = random.Random(5)
    passage = " ".join(str(rng.random()) for _ in range(1500))
    docs = spark.createDataFrame([(1, passage), (2, "other start " + passage)], "doc_id int, text string")
    store = chunk_dedup.distinct_chunks(docs).collect()
    assert all(r.verified for r in store) and sum(r.n > 1 for r in store) > 10


def test_a_shared_identifier_is_named_anew(spark, monkeypatch):
    calls = []
    real = chunk_dedup.distinct_chunks

    def clash(docs, seed):
        calls.append(seed)
        found = real(docs, seed)
        return found.withColumn("verified", found.n < 0) if seed == 0 else found

    monkeypatch.setattr(chunk_dedup, "distinct_chunks", clash)
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b")], "doc_id bigint, text string")
    assert {r.keep_id for r in chunk_dedup.groups(docs).collect()} == {1} and calls == [0, 1]
