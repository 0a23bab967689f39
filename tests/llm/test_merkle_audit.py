from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from martloom.llm import merkle_audit as ma

SCHEMA = "html string, file int, page_id bigint, url string, offset int, seq int"
PLACE = "file bigint, seq bigint, offset bigint, page_id bigint, record binary"


def stored(spark, rows):
    return spark.createDataFrame(rows, PLACE)


def replica(files=3, n=600):
    rows = []
    for f in range(files):
        offset = 0
        for s in range(n + f):
            data = f"record {f} {s}".encode() * (1 + s % 3)
            rows.append((f, s, offset, f * 10_000 + s, data))
            offset += len(data)
    return rows


def found(spark, mine, theirs):
    rows = ma.audit(ma.leaves(stored(spark, mine)), ma.leaves(stored(spark, theirs))).collect()
    return {(r.file, r.page_id, r.status) for r in rows}


def test_all_kinds_of_damage_are_located(spark):
    mine = replica()
    theirs = [list(r) for r in mine]
    theirs[5][4] = b"changed"
    theirs[700][4] = theirs[700][4][:-1]
    del theirs[1300]
    theirs.append([1, 9000, 99_999, 77, b"one too many"])  # its tree is higher
    theirs = [r for r in theirs if r[0] != 2 or r[1] > 3]
    want = {(0, 5, "altered"), (1, mine[700][3], "altered"), (1, 77, "extra")}
    want |= {(mine[1300][0], mine[1300][3], "missing")}
    want |= {(2, 20_000 + s, "missing") for s in range(4)}
    assert found(spark, mine, theirs) == want


def test_equal_replicas_and_lost_files(spark):
    mine = replica(2, 40)
    assert found(spark, mine, mine) == set()
    assert found(spark, mine, mine[:40]) == {(1, 10_000 + s, "missing") for s in range(41)}
    assert found(spark, [], mine[:1]) == {(0, 0, "extra")} and found(spark, [], []) == set()


def test_the_descent_reads_only_differing_branches(spark):
    mine = replica(4, 500)
    theirs = [list(r) for r in mine]
    theirs[3][4] = b"x"
    a, b = ma.tree(ma.leaves(stored(spark, mine))), ma.tree(ma.leaves(stored(spark, theirs)))
    assert [t.count() for t in a] == [2006, 128, 8, 4]
    for level, (x, y) in enumerate(zip(a, b, strict=True)):
        (bad,) = ma._different(x, y).collect()
        assert (bad.file, bad.node) == (0, 3 // ma.FANOUT**level)


def test_archive_of_odd_pages(spark):
    pages = [("<p>é</p>", 1), (None, 2), ("", 5000), ("x" * 300_000, 4), ("dup", 7), ("dup", 7), ("n", None)]
    frame = spark.createDataFrame([(h, 0, i, f"http://x/{i}", 0, 0) for h, i in pages], SCHEMA)
    rows = ma.archive(frame).orderBy("file", "seq").collect()
    assert [r.page_id for r in rows] == [None, 1, 2, 4, 7, 7, 5000]
    end = {}
    for r in rows:
        assert r.offset == end.get(r.file, 0) and r.length == len(r.record)
        end[r.file] = r.offset + r.length
    head, body = bytes(rows[1].record).split(b"\r\n\r\n", 1)
    assert b"Content-Length: 9" in head and body == "<p>é</p>\r\n\r\n".encode()


def test_audit_of_decayed_pages(spark):
    pages = spark.createDataFrame([(f"body {i}", 0, i, None, 0, 0) for i in range(3000)], SCHEMA)
    got = {r.page_id: r for r in ma.audit_pages(pages).collect()}
    marks = {}
    for r in ma.archive(pages).select("page_id", F.col("record")).collect():
        marks[r.page_id] = hashlib.sha256(bytes(r.record)).hexdigest()
    want = {i: m[:2] for i, m in marks.items() if m[:2] in ("00", "01", "02")}
    assert set(got) == set(want) and len(want) > 10
    for i, mark in want.items():
        assert got[i].status == ("missing" if mark == "01" else "altered")
        assert got[i].sha256 == marks[i]
    assert ma.audit_pages(spark.createDataFrame([], SCHEMA)).count() == 0
