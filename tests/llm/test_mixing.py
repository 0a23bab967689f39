from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from martloom.llm import mixing

SCHEMA = "text string, size int, doc_id bigint, source string, target int, n int"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share, stop the full ones, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, full = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set()
    while True:
        rest = total - sum(target[s] for s in full)
        active = [s for s in names if s not in full]
        shared = sum(weight[s] for s in active)
        for s in active:
            target[s] = rest * weight[s] / shared
        over = {s for s in active if target[s] >= 2 * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
        full |= over
        if len(full) == len(names):
            return target


def sample(seed=1):
    rng = random.Random(seed)
    rows = []
    for s, n in [("a", 400), ("B", 30), ("é", 200), ("z", 3), (None, 60), ("", 1), ("empty", 4)]:
        for _ in range(n):
            size = 0 if s == "empty" else rng.choice([0, 1, 5, 17, 90, rng.randint(1, 400)])
            rows.append((" \t".join("w x" for _ in range(size)), s))
    rows += [("same", "hot")] * 3000 + [(None, "hot"), ("w " * 30_000, "hot")]
    rng.shuffle(rows)
    return [(t, i, s) for i, (t, s) in enumerate(rows)] + [(rows[0][0], 0, rows[0][1])]


def frame(spark, rows, parts=4):
    data = [(t, 0, i, s, 0, 0) for t, i, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def test_targets_and_taken_words(spark):
    rows = sample()
    got = mixing.mix(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (i, s, n_words(t)) for t, i, s in rows
    )
    sizes = defaultdict(int)
    for text, _, source in rows:
        sizes[source] += n_words(text)
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        taken[r.source] += r.taken
    for source, target in want.items():
        longest = max(n_words(t) for t, _, s in rows if s == source)
        assert abs(taken[source] - target) <= longest / 2 + 1
        if source in ("a", "é"):  # documents of many lengths
            assert abs(taken[source] - target) <= 1
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_whatever_the_partitions(spark):
    rows = sample(seed=2)
    first = sorted(map(str, mixing.mix(frame(spark, rows, 2)).collect()))
    assert first == sorted(map(str, mixing.mix(frame(spark, rows, 7)).collect()))
    some = [
        {r.doc_id for r in mixing.mix(frame(spark, rows), budget=0.5, seed=s).collect() if r.copies}
        for s in (1, 1, 99)
    ]
    assert some[0] == some[1] != some[2]


def test_mixed_repeats_rows(spark):
    rows = sample(seed=3)
    table = frame(spark, rows)
    out = mixing.mixed(table)
    assert out.schema == table.schema
    want = Counter()
    for r in mixing.mix(table).collect():
        want[(r.doc_id, r.source)] += r.copies
    got = Counter((r.doc_id, r.source) for r in out.collect())
    assert got == +want


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mixed(frame(spark, [])).count() == 0
    rows = mixing.mix(frame(spark, [("", 1, "a"), (None, 2, None)])).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


def test_fit_against_all_choices():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lengths = rng.choice(np.arange(0, 40), rng.integers(1, 6), replace=False)
        counts = rng.integers(1, 5, len(lengths))
        words = int((lengths * counts).sum())
        budget = int(rng.integers(0, words + 3))
        left = mixing._knapsack(lengths, counts, budget)
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + k * n for s in sums for k in range(c + 1)}
        assert (left <= counts).all()
        assert int((lengths * left).sum()) == max(s for s in sums if s <= budget)
        taken = mixing.fit(lengths, counts, min(budget, words))
        assert (taken <= counts).all() and (taken >= 0).all()
        gap = abs(int((lengths * taken).sum()) - min(budget, words))
        assert gap <= min(abs(budget - s) for s in sums) + lengths.max() / 2


def test_fit_of_a_large_source():
    lengths = np.arange(1, 20_000, 7)
    counts = np.full(len(lengths), 10**9)
    words = int((lengths * counts).sum())
    taken = mixing.fit(lengths, counts, words // 3)
    assert int((lengths * taken).sum()) == words // 3


def test_a_third_of_the_rows_under_one_null_id(spark, monkeypatch):
    """Rows without an id, alike and not, are taken as exactly as others; some of equal rows."""
    monkeypatch.setattr(mixing, "GROUP", 7)
    monkeypatch.setattr(mixing, "CHUNK", 9)
    rng = random.Random(6)
    rows = [("one two three", None, "a")] * 200 + [(f"x{k} two three", None, "a") for k in range(100)]
    rows += [("w " * rng.randint(1, 9), k, rng.choice("ab")) for k in range(300)]
    rng.shuffle(rows)
    table = frame(spark, rows)
    for budget in (0.3, 0.9, 1.5):
        got = mixing.mix(table, budget=budget).collect()
        assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, n_words(t)) for t, i, s in rows)
        taken, target = defaultdict(int), {}
        for r in got:
            taken[r.source] += r.taken
            target[r.source] = r.target
        assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
        out = Counter((r.text, r.doc_id, r.source) for r in mixing.mixed(table, budget=budget).collect())
        copies = defaultdict(int)
        for r in got:
            copies[r.doc_id, r.source, r.size] += r.copies
        drawn = defaultdict(int)
        for (text, i, s), n in out.items():
            drawn[i, s, n_words(text)] += n
        assert drawn == {k: n for k, n in copies.items() if n}


def test_columns_of_any_name_pass_through(spark):
    schema = "doc_id bigint, text string, source string, `_mix_key` int, row string, h int, size int, cut map<string,int>, `a.b` int"
    rows = [(i, "w " * (i % 5), "s", 7, f"r{i}", i, -1, {"k": i}, i) for i in range(60)]
    table = spark.createDataFrame(rows, schema)
    out = mixing.mixed(table, budget=0.5)
    assert out.schema == table.schema
    assert {tuple(map(str, r)) for r in out.collect()} <= {tuple(map(str, r)) for r in rows}
    assert 0 < out.count() < 60


def test_texts_are_not_moved(spark):
    """The plan is broadcast: no exchange in the plan of the drawn rows."""
    out = mixing.mixed(frame(spark, sample(seed=5)))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "Window" not in text
