from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import chat_format as cf
from martloom.operators.scratch import scratch_path

SCHEMA = "text string, n_turns int, conv_id bigint, role string, turn bigint, piece string"

bits = st.sampled_from([*cf.CONTROLS, "\\", " ", "\n", "[", "]", "<", ">", "ROLE", "a", "é", "/"])
texts = st.lists(bits, max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), texts)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_any_conversation_comes_back(turns):
    pieces = [cf.round_trip(r, t) for r, t in turns]
    assert cf.parse("".join(p for p, _, _ in pieces)) == turns
    for (_, text), (piece, a, b) in zip(turns, pieces, strict=True):
        assert cf.unescape(piece[a:b]) == text


def test_plain_text_is_left_as_it_is():
    assert cf.round_trip("user", "hi [ok] \\ <x>") == ("[INST] hi [ok] \\ <x> [/INST]", 7, 20)
    assert cf.round_trip("assistant", "</s>")[0] == "<s> \\</s> </s>"


@pytest.mark.parametrize("bad", ["x", "[INST] a", "[INST] a </s>", "</s>", "[INST]a [/INST]", "<s> a </s> "])
def test_the_parser_refuses_other_texts(bad):
    with pytest.raises(ValueError):
        cf.parse(bad)


def brute(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv_id]
        own.sort(key=lambda o: (o[0] is not None, o[0] or 0, o[1], cf.round_trip(o[1], o[2])[0]))
        turns = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        learned = "".join(x for _, r, x in own if r == "assistant")
        loss = hashlib.sha256(learned.encode()).hexdigest()
        chars = 0
        for _, role, text in own:
            tags = {"user": 15, "assistant": 9, "system": 17}
            shown = len(text) + len(re.findall("|".join(map(re.escape, cf.CONTROLS)), text))
            chars += shown + tags.get(role, 23 + len(role))
        out[conv_id] = (len(own), turns, len(learned), loss, chars)
    return out


def test_digests_against_brute_force(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"turn {t} é{c}") for c in range(30) for t in range(6)]
    rows += [(50, t, "assistant", f"long {t} " * 50) for t in range(3000)]
    rows += [(60, 0, None, None), (60, None, "tool", "[/ROLE]"), (60, 0, "user", "x"), (60, 0, "user", "x")]
    rows += [(None, 1, "user", "nobody"), (61, 0, "user", ""), (62, 0, "assistant", "\U0001f600" * 9)]
    rows += [(63, 0, "user", "w " * 300_000), (-3, 0, "system", "<<SYS>> \\<s>")]
    frame = spark.createDataFrame([(x, 0, c, r, t, "p") for c, t, r, x in rows], SCHEMA).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in cf.digests(frame).collect()}
    assert got == brute(rows)


def test_pieces_are_written_in_order(spark):
    rows = [(f"t{t}", 0, c, "user", t, "") for c in range(20) for t in range(20)]
    folder = scratch_path(spark, "chats")
    cf.write(spark.createDataFrame(rows, SCHEMA).repartition(7), folder)
    stored = [(r.conv_id, r.turn) for r in spark.read.parquet(folder).coalesce(1).collect()]
    by_file = spark.read.parquet(folder).selectExpr("conv_id", "turn", "input_file_name() f").collect()
    runs = {}
    for r in by_file:
        runs.setdefault(r.f, []).append((r.conv_id, r.turn))
    assert all(run == sorted(run) for run in runs.values()) and len(stored) == 400
    spans = sorted((run[0], run[-1]) for run in runs.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cf.digests(none).count() == 0
    (row,) = cf.digests(cf.with_conflict(none)).collect()
    assert row.conv_id == -7 and row.n_turns == 2 and row.loss_chars == 21
