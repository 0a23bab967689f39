"""The prefix trie against a brute force, and its contraction on trees of many shapes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from martloom.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def _sha(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute_force(rows, family=100, shared=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, role, _sha(role, text)), (role, text)))
    own = {c: [said for _, said in sorted(x)] for c, x in own.items()}
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % shared
        base = c - (c % family if c >= 0 else -(-c % family))
        convs[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in sorted(convs.items()):
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out, total = [], {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids[node]) or 1
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        total[node] = (leaves, saved + sum(total[k][1] for k in kids[node]))
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(kids[node]), *total[node], digest))
    return sorted(out, key=str)


def _got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def _frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_small_tables(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert _got(pt.rebuilt_trie(table)) == brute_force(rows)


def test_shared_starts_hot_conversations_and_ends(spark):
    rng = random.Random(7)
    rows = []
    for c in range(260):
        n = 1 if c % 3 == 0 else rng.randint(1, 9)  # a third of all is one and the same text
        for t in range(n):
            text = "hot" if c % 3 == 0 else rng.choice("ab")
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    assert _got(pt.rebuilt_trie(_frame(spark, rows))) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"), (-5, 0, "user", "x"), (-105, 1, None, None), (-105, None, "user", "y"),
        (0, 0, "user", "a"), (0, 0, "user", "b"), (0, 0, "assistant", "b"), (0, 1, "user", ""), (0, 1, "user", ""),
        (1, 7, "user", "a"), (2, 0, "", "a"), (2, 0, "", "a"), (3, 0, "user", "\U0001f600é" * 3),
        (104, 0, "user", "alone"), (105, 0, "us", "er"), (105, 0, "use", "r"), (99999999999, 0, "user", "a" * 300_000),
    ]
    frame = _frame(spark, rows).selectExpr("*", "1 AS depth", "2 AS place", "'k' AS key", "0 AS chars")
    assert _got(pt.rebuilt_trie(frame)) == brute_force(rows)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "t") for c in range(101, 120)]  # no conversation 100
    got = _got(pt.rebuilt_trie(_frame(spark, rows)))
    assert got == brute_force(rows)
    assert next(r for r in got if r[1] == 0)[-1] != hashlib.sha256().hexdigest()


def test_one_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 16)
    monkeypatch.setattr(pt, "PIECE", 10)
    rows = [(7, t // 2 if t % 5 else None, "user", f"{t % 11}") for t in range(150)]
    rows += [(c, t, "user", "s") for c in range(100, 160) for t in range(2)]
    assert _got(pt.rebuilt_trie(_frame(spark, rows))) == brute_force(rows)


def test_empty_table(spark):
    assert _got(pt.rebuilt_trie(spark.createDataFrame([], SCHEMA))) == []
    assert _got(pt.rebuilt_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []


def test_equal_keys_of_different_prefixes_are_refused(spark):
    schema = "conv_id bigint, depth bigint, key struct<a:int>, parent_key struct<a:int>, turn_sha binary, chars bigint"
    rows = [(1, 1, (5,), (0,), b"x", 1), (2, 1, (5,), (0,), b"y", 1)]
    with pytest.raises(Exception, match="different prefixes share a key"):
        pt.nodes(spark.createDataFrame(rows, schema), 2, 1).collect()


def _tree(parents):
    """Rows of a tree given by each node's parent; ids are (number, depth)."""
    depth, rows = {}, []
    for v, p in enumerate(parents):
        depth[v] = 0 if p is None else depth[p] + 1
    for v, p in enumerate(parents):
        rows.append((v, depth[v], p, parents.count(v), v + 1))
    want = [r[4] for r in rows]
    for v in range(len(parents) - 1, 0, -1):
        if parents[v] is not None:
            want[parents[v]] += want[v]
    return rows, {(v, depth[v]): w for v, w in enumerate(want)}


_RNG = random.Random(3)


@pytest.mark.parametrize(
    "parents",
    [
        [None],
        [None, *range(70)],  # a chain
        [None] + [0] * 60,  # a star
        [None] + [x for i in range(25) for x in (2 * i, 2 * i)],  # a spine with a leaf at each node
        [None, *[_RNG.randint(0, i) for i in range(80)]],
        [None, *[_RNG.randint(max(0, i - 2), i) for i in range(80)]],
        [None, None, 0, 1, 2, 3],  # two roots
    ],
)
def test_contraction_of_any_shape(spark, parents):
    rows, want = _tree(parents)
    schema = "conv_id bigint, depth bigint, parent_conv_id bigint, n_children bigint, w bigint"
    got = pt.subtree_totals(spark.createDataFrame(rows, schema), ["w"]).collect()
    assert {(r.conv_id, r.depth): r.w for r in got} == want and len(got) == len(want)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    compress = pt._compress
    monkeypatch.setattr(pt, "_compress", lambda *a: rounds.append(1) or compress(*a))
    rows, _ = _tree([None, *range(127)])
    schema = "conv_id bigint, depth bigint, parent_conv_id bigint, n_children bigint, w bigint"
    pt.subtree_totals(spark.createDataFrame(rows, schema), ["w"]).collect()
    assert len(rounds) <= 9
