from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martloom.llm import token_planes as tp
from martloom.operators.scratch import scratch_path

SCHEMA = "text string, start int, doc_id bigint, shard int, n int"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(tp.default_tokenizer())


def hard_texts(seed=2, n=300):
    rng = random.Random(seed)
    letters = "abcXYZ.,'!?-_0129 \t\n\r\x0b\x0céßÄñçŒœ日本語𝄞́̈  ΣςİIıǅﬁ…<|>\\\x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    texts += ["<|x ABC Def, ghi. <|endoftext|>"]
    texts += ["<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "it's don't, 'S. we'll.. x.,y", ""]
    texts += ["é. é.", "Stupid, words. (and) more.", "a" * 5000, "..,,", "word.", "ÄÖ. Straße,"]
    return texts


def test_pieces_give_the_ids_of_the_whole_text(reference):
    own = tp.PieceTokenizer(tp.default_tokenizer())
    texts = hard_texts()
    ids, lengths = own.encode(pa.array(texts, pa.string()))
    got = [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    assert got == want


def test_forgetting_changes_nothing(monkeypatch):
    texts = hard_texts(seed=4)
    whole = tp.PieceTokenizer(tp.default_tokenizer()).encode(pa.array(texts, pa.string()))[0]
    monkeypatch.setattr(tp, "_KNOWN_PIECES", 3)
    own = tp.PieceTokenizer(tp.default_tokenizer())
    assert np.concatenate([own.encode(pa.array([t], pa.string()))[0] for t in texts]).tolist() == whole.tolist()


def test_long_pieces_are_forgotten_by_their_letters(reference):
    rng = random.Random(6)
    own = tp.PieceTokenizer(tp.default_tokenizer())
    most = 0
    for _ in range(12):  # 6 million letters in few pieces: texts without white space
        texts = ["".join(rng.choices("日本語のテキスト。", k=5_000)) for _ in range(100)]
        ids, lengths = own.encode(pa.array(texts, pa.string()))
        most = max(most, sum(map(len, own.numbers)))
        want = reference.encode(texts[-1], add_special_tokens=False).ids
        assert ids[-lengths[-1] :].tolist() == want
    assert most <= 4_500_000  # the limit, and one batch


@pytest.mark.parametrize("plane_bits", [1, 8])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(plane_bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    planes = tp.to_planes(ids, plane_bits)
    assert len(planes) == 32 // plane_bits
    assert tp.from_planes(planes, n, plane_bits).tolist() == ids.tolist()


def test_joined_checksums():
    data = bytes(range(256)) * 9
    cuts = [0, 5, 5, 700, len(data)]
    parts = [(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    assert tp.joined_crc32(parts) == zlib.crc32(data)


def brute(rows, reference):
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0))
    out, start = [], 0
    for text, doc_id in order:
        ids = reference.encode(text or "", add_special_tokens=False).ids + [tp.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("plane_bits", [1, 8])
def test_files_against_brute_force(spark, reference, plane_bits):
    rows = [(t, i * 7 % 1000) for i, t in enumerate(hard_texts(n=120))]
    rows += [(None, 5001), ("long words " * 20_000, 333_333), ("same", 5003), ("same", 5003), ("end", None)]
    docs = spark.createDataFrame([(t, 0, i, 0, 0) for t, i in rows], SCHEMA).repartition(3)
    folder = scratch_path(spark, "tokens")
    tp.write(docs, folder, block=1000, plane_bits=plane_bits)
    got = [tuple(r) for r in tp.read_digests(spark, folder).orderBy("start").collect()]
    assert got == brute(rows, reference)
    index = spark.read.parquet(f"{folder}/index")
    assert index.where("n_ids > 1000").count() == 0 and index.count() > 40


def test_empty_table(spark):
    folder = scratch_path(spark, "tokens")
    tp.write(spark.createDataFrame([], SCHEMA), folder)
    assert tp.read_digests(spark, folder).count() == 0


def test_a_damaged_block_is_reported():
    ids = np.arange(10, dtype=np.uint32)
    import zstandard

    planes = [zstandard.ZstdCompressor().compress(p) for p in tp.to_planes(ids)]
    row = {"planes": planes, "n_ids": 10, "plane_bits": 8, "crc32": 1, "shard": 0, "block": 0}
    with pytest.raises(ValueError, match="checksum"):
        tp.decoded(row)
