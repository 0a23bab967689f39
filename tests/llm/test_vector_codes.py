"""Vector codes against a brute force with Python's integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from martloom.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, parts=16, entries=64, rounds=2):
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            found = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)) for e in books[p]]
                found.append((d.index(min(d)), min(d)))
            out.append(found)
        return out

    for _ in range(rounds):
        coded = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[k][p] for k in range(len(kept)) if coded[k][p][0] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    coded = assign()
    errors = [sum(d for _, d in found) for found in coded]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] += error
    numbers = ",".join(str(x) for part in books for entry in part for x in entry)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    return [
        (i, "".join(f"{e:02x}" for e, _ in found), error, by_label[label], sha)
        for (i, _, label), found, error in zip(kept, coded, errors, strict=True)
    ]


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


def _floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def test_limbs_give_the_numbers_and_products_back():
    rng = np.random.default_rng(1)
    for top in (1, 255, 2**20, 2**27):
        a = rng.integers(-top, top, (40, 5))
        b = rng.integers(-top, top, (30, 5))
        for bits in (3, 11, 25):
            total = sum(x.astype(np.int64) << (k * bits) for k, x in enumerate(vc.limbs(a, bits)))
            assert (total == a).all()
        want = a.astype(object) @ b.astype(object).T
        assert (vc.exact_products(a, b) == want).all()


def test_long_vectors_keep_products_below_the_exact_range():
    rng = np.random.default_rng(2)
    a = rng.integers(-(2**24), 2**24, (3, 3000))
    b = rng.integers(-(2**24), 2**24, (4, 3000))
    assert (vc.exact_products(a, b) == a.astype(object) @ b.astype(object).T).all()


def test_first_of_equally_near_entries():
    best, distance = vc.nearest(np.array([[0], [5]]), np.array([[1], [-1], [1], [6], [4]]))
    assert best.tolist() == [0, 3] and distance.tolist() == [1, 1]


@pytest.mark.parametrize("spread", [0.3, 3e4, 1e12, 1e30])
def test_codes_equal_brute_force(spark, spread):
    rng = np.random.default_rng(3)
    rows = _floats([(i, (rng.normal(size=32) * spread).tolist(), i % 3 or None) for i in range(150)])
    got = vc.compressed(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=9)
    want = brute_force(rows, entries=9)
    longest = 2**63 - 1
    want = [(i, c, e if e <= longest else None, t if t <= longest else None, s) for i, c, e, t, s in want]
    assert _got(got) == sorted(want, key=str)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [rng.normal(size=16).tolist() for _ in range(6)]
    rows = [
        (1, good[0], 1), (1, good[1], 1), (1, good[0], 1), (None, good[2], None), (None, good[3], 2),
        (5, None, 1), (6, good[4][:-1] + [None], 1), (7, [float("nan")] * 16, 1),
        (8, [float("inf")] + good[0][1:], 1), (9, good[5][:7], 1), (10, [], 3), (11, good[5] + [0.5], None),
    ]
    rows = _floats(rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS vector", "1 AS code", "2 AS error")
    for entries in (64, 3, 1):
        got = vc.compressed(frame, entries=entries)
        assert _got(got) == sorted(brute_force(rows, entries=entries), key=str)


def test_empty_tables(spark):
    assert vc.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 2)], SCHEMA)
    got = vc.compressed(nothing)
    assert got.count() == 0
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_vectors_without_components(spark):
    rows = [(2, [], 1), (1, [], None)]
    got = vc.compressed(spark.createDataFrame(rows, SCHEMA))
    assert _got(got) == sorted(brute_force(rows), key=str)


def test_one_vector_in_a_third_of_the_rows(spark):
    """Result does not depend on partitions; equal vectors need one entry only."""
    rng = np.random.default_rng(5)
    rows = _floats([(i, [0.25] * 16 if i % 3 == 0 else rng.normal(size=16).tolist(), 1) for i in range(120)])
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute_force(rows, entries=4), key=str)
    for n in (1, 7):
        assert _got(vc.compressed(frame.repartition(n), entries=4)) == want
