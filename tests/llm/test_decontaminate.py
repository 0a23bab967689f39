from __future__ import annotations

import hashlib
import random
import re

from martloom.llm import decontaminate

DOCS = "text string, n_hit int, doc_id bigint, items int, row int"
ITEMS = "text string, item_id bigint, phrase int"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items):
    windows = {}
    for text, item_id in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item_id is None else str(item_id))
    out = []
    for text, doc_id in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def sample():
    rng = random.Random(11)
    vocabulary = ["the", "of", "Ärger", "日本", "x1", "a-b", "ZZ", "zz", "it's", "9"]
    vocabulary += [f"w{i}" for i in range(40)]

    def say(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(say(n), i) for i, n in enumerate([1, 3, 9, 10, 11, 40, 25, 2])]
    items += [(None, 50), ("", 51), ("!!", 52), (items[5][0], 53), ("only here twice", None)]
    items += [("the the the the the the the the the the the the", 60), (say(30), 5)]
    docs = [(None, 1), ("", 2), ("?!", 3), ("the " * 500, 4), (say(20_000), 5), ("one", None)]
    docs += [(say(rng.randint(1, 120)), 100 + i) for i in range(60)]
    for i, (text, _) in enumerate(items[:8] + items[11:13]):
        docs.append((f"{say(7)}, {text.upper() if i % 2 else text}. {say(9)}", 200 + i))
        docs.append((" ".join(words(text)[: max(1, len(words(text)) // 2)]), 300 + i))
    return docs + docs[10:14], items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(t, 0, i, 0, 0) for t, i in docs], DOCS).repartition(4),
        spark.createDataFrame([(t, i, 0) for t, i in items], ITEMS),
    )


def test_against_brute_force(spark):
    docs, items = sample()
    got = decontaminate.contamination(*frames(spark, docs, items)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, items), key=key)


def test_blocks_give_the_same_as_one_block(spark, monkeypatch):
    docs, items = sample()
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 3000)
    one = decontaminate.hits(*frames(spark, docs, items)).drop("row").collect()
    many = decontaminate.hits(*frames(spark, docs, items), block_size=25).drop("row").collect()
    assert sorted(map(tuple, one), key=key) == sorted(map(tuple, many), key=key)


def test_empty_tables(spark):
    docs, items = sample()
    none, full = frames(spark, [], []), frames(spark, docs, items)
    assert decontaminate.contamination(none[0], full[1]).count() == 0
    rows = decontaminate.contamination(full[0], none[1]).collect()
    assert len(rows) == len(docs) and not any(r.contaminated for r in rows)


def test_near_matches_lie_within_the_slop(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d"), (2, "a x b c d"), (3, "a x y z b c d"), (4, "a b"), (5, "c d")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame([(7, "a b c d")], "item_id bigint, text string")
    indexed = decontaminate.index(docs.coalesce(1))
    (block,) = decontaminate.blocks(items)
    exact = decontaminate.matches(indexed, block).collect()
    near = decontaminate.matches(indexed, block, slop=1).collect()
    assert [(r.doc_id, r.start, r.length, r.item_ids) for r in exact] == [(1, 0, 4, ["7"])]
    assert {(r.doc_id, r.exact) for r in near} == {(1, True), (2, False)}


def test_clean_keeps_columns_and_clean_rows(spark):
    docs, items = sample()
    table, benchmark = frames(spark, docs, items)
    kept = decontaminate.clean(table, benchmark)
    assert kept.schema == table.schema
    want = [d[0] for d, b in zip(docs, brute(docs, items), strict=True) if not b[5]]
    assert sorted((r.text or "") for r in kept.collect()) == sorted(t or "" for t in want)


def test_clean_passes_columns_of_any_name(spark):
    item = " ".join(f"w{k}" for k in range(12))
    rows = [(1, item, 5, "x"), (2, "clean words", 6, "y"), (None, None, 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, contaminated_key int, _contaminated_key string")
    items = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    out = decontaminate.clean(docs, items)
    assert out.schema == docs.schema
    assert {tuple(r) for r in out.collect()} == set(rows[1:])
