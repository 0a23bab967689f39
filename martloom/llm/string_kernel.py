"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel compares words by the subsequences of three letters they share. A subsequence may
leave out letters within a span of five and counts less the wider it is, so ``stuupid`` and
``st.upid`` stay close to ``stupid``, and a stem is known under endings never seen. Labelled
sentences tell which words mark toxic text: sentences of toxic documents are positive, those
of clean ones negative, and equal sentences count once, whatever the number of copies. The
evidence is a sample of at most EVIDENCE labelled documents of each class, chosen by a hash of
their ids; a word stands out with Z_SCORE, which takes 18 toxic sentences where both classes have
as many and no clean sentence has it. A support vector machine on the landmarks' kernel values then separates the
words that stand out, with letters inserted as well, from the words of clean sentences; it is
trained again with the clean words it took for toxic ones.

As the machine is linear in the kernel's subsequences, its landmarks fold into one weight per
subsequence, and a word is scored without visiting the landmarks. Letters of all scripts count:
a subsequence of a to z has a weight of its own, others share a table by a hash of their code
points. A document has the score of its worst word, calibrated on labelled documents.

Words are white-space separated pieces with everything but letters taken out, folded to lower
case without accents; of a piece with other signs inside, each run of four letters or more is
a word as well, and a word beyond LONGEST letters is read in overlapping parts. Evidence and
scores read the same words; scores also read a run of four single-letter pieces or more as one
word. A batch is split and encoded in Arrow, and each distinct word of it is scored once. Defined
cases: a text without words has the lowest margin; without labels of both classes, or without
a word that stands out, each text has the share of label 1 as its score; a null doc_id is not
held out.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import (
    class_sizes,
    fold,
    held,
    in_arrow,
    labelled_sample,
    logistic,
    probability,
    sliced,
    strings,
)
from martloom.operators.scratch import materialize

LETTERS = 3  # of a subsequence
SPAN = 5
DECAY = 0.8  # per letter left out
SIGNS = 27  # a word's border, a to z
BUCKETS = 1 << 18  # for subsequences: a cell each for those of SIGNS, hashed cells for all others
LONGEST = 40  # longer words are scored in overlapping parts
SPELLED = 4  # single letters in a row that are read as a word

EVIDENCE = 20_000  # labelled documents of each class to find the words in
PER_CLASS = 3000  # of these, documents of each class to calibrate on
POSITIVES = 4000  # words that stand out in toxic sentences, at most
NEGATIVES = 12_000  # words of clean sentences in the first round
HARD = 4000  # clean words added to each further round
ROUNDS = 2
LANDMARKS = 384
Z_SCORE = 4.0
INSERTED = 6  # variants of each positive word with a letter inserted
THRESHOLD = 0.3
FLOOR = -3.0  # margin of a text without words

_KNOWN_WORDS = 300_000
_RUN = re.compile(r"[^\W\d_]{4,}")
_SENTENCE = re.compile(r"[.!?\n|]+")
_SHAPES = [
    ((0, *rest), DECAY ** (rest[-1] + 1 - LETTERS))
    for rest in combinations(range(1, SPAN), LETTERS - 1)
]
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def folded(piece: str) -> str:
    """The piece's letters in lower case, without accents."""
    if piece.isascii() and piece.isalpha():
        return piece.lower()
    plain = unicodedata.normalize("NFKD", piece.lower())
    return "".join(c for c in plain if c.isalpha())


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct white-space separated pieces of a batch, in lower case; each text's pieces as
    numbers of these, one text after another; and how many each text has."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    encoded = lists.flatten().dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(), lists.value_lengths().to_numpy()


def _words(pieces: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of the pieces; the words that are read, as numbers of these, and of
    their pieces; and which pieces are one letter.

    A piece is read as one word; where other signs stand between letters, so is each longer run.
    """
    plain = pc.utf8_normalize(pieces, form="NFKD")
    whole = pc.replace_substring_regex(plain, r"[^\p{L}]+", "")
    lengths = pc.utf8_length(whole).to_numpy()
    short = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
    more: list[str] = []
    of: list[int] = []
    long = np.flatnonzero(lengths > LONGEST)
    for i, word in zip(long.tolist(), strings(whole.take(pa.array(long))), strict=True):
        more += _parts(word)
        of += [i] * (len(more) - len(of))
    inner = np.flatnonzero(pc.match_substring_regex(plain, r"\p{L}[^\p{L}\p{M}]+\p{L}").to_numpy(False))
    for i, piece in zip(inner.tolist(), strings(pieces.take(pa.array(inner))), strict=True):
        for run in dict.fromkeys(folded(run) for run in _RUN.findall(piece)):
            more += _parts(run) if run else []
        of += [i] * (len(more) - len(of))
    read = pa.concat_arrays([whole.take(pa.array(short)), pa.array(more, pa.string())]).dictionary_encode()
    owners = np.concatenate([short, np.array(of, np.int64)])
    return strings(read.dictionary), read.indices.to_numpy(), owners, lengths == 1


def _parts(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST - SPAN - 3
    return [word[i : i + LONGEST] for i in range(0, len(word) - SPAN - 3, step)]


def _features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words of one length each: their numbers, their subsequences and the weights, scaled
    so that a word's similarity to itself is one."""
    alike: dict[tuple[int, bool], list[int]] = {}
    for i, word in enumerate(words):
        alike.setdefault((len(word), word.isascii()), []).append(i)
    for (length, plain), numbers in alike.items():
        for at in range(0, len(numbers), 8192):
            own = np.array(numbers[at : at + 8192])
            letters = "".join(words[i] for i in own).encode("utf-32-le")
            code = np.frombuffer(letters, np.uint32).reshape(len(own), length).astype(np.int32) - 96
            other = (code < 1) | (code >= SIGNS)
            plain = plain and not other.any()
            code[other] += 96 + SIGNS  # code points, apart from the signs
            code = np.pad(code, ((0, 0), (1, 1)))
            found, weights = [], []
            for shape, weight in _SHAPES:
                for start in range(code.shape[1] - shape[-1]):
                    triple = [code[:, start + offset] for offset in shape]
                    found.append(_cells(triple) if plain else _hashed_cells(triple))
                    weights.append(weight)
            if not found:
                continue
            signs = np.stack(found, axis=1)
            weight = np.broadcast_to(np.array(weights, np.float32), signs.shape)
            yield own, signs, weight / _norms(signs, weight)[:, None]


def _cells(triple: list[np.ndarray]) -> np.ndarray:
    """The cell of each subsequence of signs, its own."""
    cell = np.zeros(len(triple[0]), np.int32)
    for code in triple:
        cell = cell * SIGNS + code
    return cell


def _hashed_cells(triple: list[np.ndarray]) -> np.ndarray:
    """The cell of each subsequence of any letters: those with a letter beyond the signs share
    the cells after SIGNS**LETTERS by a hash of their code points."""
    h = np.zeros(len(triple[0]), np.uint64)
    for code in triple:
        h = (h ^ code.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    beyond = np.any([code >= SIGNS for code in triple], axis=0)
    own = SIGNS**LETTERS
    hashed = own + (h % np.uint64(BUCKETS - own)).astype(np.int32)
    return np.where(beyond, hashed, _cells([np.minimum(code, SIGNS - 1) for code in triple]))


def _norms(signs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Lengths of the words in the space of subsequences; equal ones of a word add up."""
    order = np.argsort(signs, axis=1, kind="stable")
    ordered = np.take_along_axis(signs, order, axis=1)
    sums = np.cumsum(np.take_along_axis(weight, order, axis=1), axis=1)
    last = np.ones(signs.shape, bool)
    last[:, :-1] = ordered[:, 1:] != ordered[:, :-1]
    total, before = np.zeros(len(signs)), np.zeros(len(signs))
    for j in range(signs.shape[1]):
        total += np.where(last[:, j], (sums[:, j] - before) ** 2, 0)
        before = np.where(last[:, j], sums[:, j], before)
    return np.sqrt(total)


def _cells_of(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells that the landmarks have weight in, and for each of all cells its place among
    them; a cell without weight has the place after the last."""
    cells = np.unique(np.concatenate([[0], *(signs.ravel() for _, signs, _ in _features(landmarks))]))
    row = np.full(BUCKETS, len(cells), np.int32)
    row[cells] = np.arange(len(cells))
    return cells, row


def _landmark_table(landmarks: list[str], row: np.ndarray | None = None) -> np.ndarray:
    """The landmarks' weights, a row per cell, or with ``row`` at the places it gives the cells."""
    rows = BUCKETS if row is None else int(row.max()) + 1
    table = np.zeros((rows, len(landmarks)), np.float32)
    for own, signs, weight in _features(landmarks):
        signs = signs if row is None else row[signs]
        for j in range(signs.shape[1]):
            np.add.at(table, (signs[:, j], own), weight[:, j])
    return table


def kernel(words: list[str], landmark_table: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Similarity of each word to each landmark, 0 to 1."""
    values = np.zeros((len(words), landmark_table.shape[1]), np.float32)
    for own, signs, weight in _features(words):
        signs = signs if row is None else row[signs]
        for j in range(signs.shape[1]):
            values[own] += weight[:, j : j + 1] * landmark_table[signs[:, j]]
    return values


@dataclass(frozen=True)
class Model:
    """A weight per subsequence, the offset, and the calibration curve."""

    weights: bytes  # float32
    offset: float
    curve: tuple[float, float]

    def margins(self, words: list[str]) -> np.ndarray:
        table = np.frombuffer(self.weights, np.float32)
        margin = np.full(len(words), np.float32(self.offset))
        for own, signs, weight in _features(words):
            margin[own] += (table[signs] * weight).sum(axis=1)
        return margin


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 10.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on the rows
    inside the margin."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        inside = y * (x @ beta) < 1
        own = x[inside] * weight[inside, None]
        step = np.linalg.solve(ridge * np.eye(x.shape[1]) + own.T @ x[inside], own.T @ y[inside])
        if np.abs(step - beta).max() < 1e-6:
            break
        beta = step
    return beta


def _inserted(words: list[str], known: set[str]) -> list[str]:
    """Variants of the words with one letter put in, places and letters by hash: one of a to z,
    or of the word's own letters if it has others."""
    found = []
    for word in words:
        for k in range(INSERTED):
            h = zlib.crc32(f"{word}{k}".encode())
            place = 1 + h % max(1, len(word) - 1)
            letters = _ALPHABET if word.isascii() else word
            variant = word[:place] + letters[(h >> 8) % len(letters)] + word[place:]
            if variant not in known:
                found.append(variant)
    return found


def train_words(
    positive: dict[str, float], negative: dict[str, float], landmarks: list[str]
) -> tuple[np.ndarray, float]:
    """Weight per subsequence and offset from words with the sentences they were seen in."""
    words = [*positive, *negative]
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    seen = np.sqrt(np.array([*positive.values(), *negative.values()], float))
    sides = np.where(y > 0, seen / seen[y > 0].sum(), seen / seen[y < 0].sum()) * len(y) / 2
    cells, row = _cells_of(landmarks)
    table = _landmark_table(landmarks, row)
    value, vector = np.linalg.eigh(kernel(landmarks, table, row).astype(float))
    kept = value > 1e-3 * value.max()
    nystrom = vector[:, kept] / np.sqrt(value[kept])
    x = np.hstack([kernel(words, table, row) @ nystrom, np.ones((len(words), 1))])
    beta = _svm(x, y, sides)
    weights = np.zeros(BUCKETS, np.float32)
    weights[cells] = table[: len(cells)] @ (nystrom @ beta[:-1]).astype(np.float32)
    return weights, float(beta[-1])


def word_counts(texts: DataFrame):
    """(word, n1, n0): distinct sentences of toxic and of clean documents that hold it, and the
    row (all1, all0) of all their sentences. A sentence of both is a clean one; sentences are the
    same that have the same pieces in the same order, told by a hash of 128 bits."""
    schema = "h1 bigint, h2 bigint, y int, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            lists = pc.split_pattern_regex(pc.fill_null(batch.column("text"), ""), _SENTENCE.pattern)
            of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            pieces, flat, sizes = _pieces(lists.flatten())
            distinct, read, owners, _ = _words(pieces)
            order = np.argsort(owners, kind="stable")
            words = [distinct[i] for i in read[order].tolist()]
            ends = np.searchsorted(owners[order], np.arange(len(pieces) + 1))
            y, names = batch.column("y").to_pylist(), strings(pieces)
            found: dict[tuple[int, int], tuple[int, set[str]]] = {}
            at = 0
            for text, size in zip(of.tolist(), sizes.tolist(), strict=True):
                own = flat[at : at + size].tolist()
                at += size
                sentence = " ".join(names[i] for i in own).strip()
                key = xxhash.xxh3_128_intdigest(sentence)
                key = ((key >> 64) - 2**63, (key & (2**64 - 1)) - 2**63)
                if key in found:
                    found[key] = (min(found[key][0], y[text]), found[key][1])
                else:
                    found[key] = (y[text], {w for i in own for w in words[ends[i] : ends[i + 1]]})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.int64()),
                    pa.array([k[1] for k in found], pa.int64()),
                    pa.array([v[0] for v in found.values()], pa.int32()),
                    pa.array([sorted(v[1]) for v in found.values()], pa.list_(pa.string())),
                ],
                names=["h1", "h2", "y", "words"],
            )

    sentences = in_arrow(texts.select("text", "y"), run, schema).groupBy("h1", "h2")
    sentences = sentences.agg(F.min("y").alias("y"), F.first("words").alias("words"))
    word = F.explode(F.array_append("words", F.lit(""))).alias("word")  # "" counts the sentences
    counted = sentences.select(word, "y").groupBy("word")
    counted = counted.agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))
    counted = materialize(counted, "words")
    totals = counted.where("word = ''").agg(F.sum("n1").alias("all1"), F.sum("n0").alias("all0"))
    return counted.where("word != ''"), totals.first()


def _standing_out(counts: DataFrame, all1: int, all0: int) -> dict[str, float]:
    share1, share0 = F.col("n1") / all1, F.col("n0") / all0
    spread = F.sqrt((F.col("n1") + 1) / all1**2 + (F.col("n0") + 1) / all0**2)
    z = (share1 - share0) / spread
    far = counts.where((z > Z_SCORE) & (share1 > 9 * share0))
    rows = far.orderBy(z.desc(), "word").limit(POSITIVES).collect()
    return {r.word: float(r.n1) for r in rows}


def fit(docs: DataFrame, labels: DataFrame, held_in) -> Model:
    """Train on labelled documents for which ``held_in`` (a column of ``labels``) holds."""
    all0, all1 = class_sizes(labels, "toxic", held_in)
    prior = (all1 + 1) / (all0 + all1 + 2)
    constant = Model(
        np.zeros(BUCKETS, np.float32).tobytes(), 0.0, (0.0, float(np.log(prior / (1 - prior))))
    )
    if not all0 or not all1:
        return constant
    sample = labelled_sample(docs, labels, "toxic", held_in, EVIDENCE)
    counts, totals = word_counts(sample)
    if not totals.all1 or not totals.all0:
        return constant
    positive = _standing_out(counts, totals.all1, totals.all0)
    if not positive:
        return constant
    clean = counts.where("n0 > 0")
    by_hash = F.xxhash64("word")
    rows = clean.orderBy(F.desc("n0"), "word").limit(NEGATIVES // 2).collect()
    rows += clean.orderBy(by_hash, "word").limit(NEGATIVES // 2).collect()
    negative = {r.word: float(r.n0) for r in rows if r.word not in positive}
    words = list(positive)
    half = LANDMARKS // 2
    landmarks = words[:half] + list(negative)[:: max(1, len(negative) // half)][:half]
    seen = set(positive) | set(negative)
    bent = {v: max(1.0, positive[w] / INSERTED) for w in words for v in _inserted([w], seen)}
    for further in range(ROUNDS + 1):
        weights, offset = train_words(positive | bent, negative, landmarks)
        model = Model(weights.astype(np.float32).tobytes(), offset, (1.0, 0.0))
        if further < ROUNDS:
            hard = _scored_words(clean, model).orderBy(F.desc("margin"), "word").limit(HARD)
            for r in hard.collect():
                if r.word not in positive:
                    negative[r.word] = float(r.n0)
    rows = in_arrow(_calibrating(sample), _margin_task(model), "margin double, y int").collect()
    x, y = np.array([r.margin for r in rows]), np.array([r.y for r in rows])
    share = np.where(y == 1, all1 / max(1, (y == 1).sum()), all0 / max(1, (y == 0).sum()))
    return Model(model.weights, model.offset, logistic(x, y, share * len(y) / share.sum()))


def _scored_words(words: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = model.margins(strings(batch.column("word")))
            yield batch.append_column("margin", pa.array(margin, pa.float32()))

    return in_arrow(words.select("word", "n0"), run, "word string, n0 bigint, margin float")


def _calibrating(sample: DataFrame) -> DataFrame:
    """(text, y) of at most PER_CLASS documents of each class, chosen by a hash of their ids."""
    order = F.xxhash64("doc_id", F.lit(6))
    ids = [sample.where(F.col("y") == y).orderBy(order, "doc_id").limit(PER_CLASS) for y in (0, 1)]
    chosen = materialize(ids[0].unionByName(ids[1]).select("doc_id"), "calibrating")
    return sample.join(chosen, "doc_id", "left_semi").select("text", "y")


def _margins(model: Model, words: list[str]) -> np.ndarray:
    """Margins of distinct words; those of earlier batches are remembered."""
    known = held(model, dict)
    if len(known) > _KNOWN_WORDS:
        known.clear()
    new = [w for w in words if w not in known]
    known.update(zip(new, model.margins(new).tolist(), strict=True))
    return np.array([known[w] for w in words], np.float32)


def score(model: Model, texts: pa.Array) -> np.ndarray:
    """The margin of each text's worst word."""
    pieces, flat, sizes = _pieces(texts)
    words, read, owners, single = _words(pieces)
    margin = np.full(len(pieces), np.float32(FLOOR))
    np.maximum.at(margin, owners, _margins(model, words)[read])
    result = np.full(len(texts), FLOOR)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        result[full] = np.maximum.reduceat(margin[flat], starts)
        _spelled(model, result, pieces, flat, single[flat], sizes)
    return result


def _spelled(model: Model, result, pieces: pa.Array, flat, single, sizes) -> None:
    """Words spelled out as single letters; a run may go over the border of two texts."""
    ends = np.cumsum(sizes)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))).reshape(-1, 2)
    for a, b in edges[edges[:, 1] - edges[:, 0] >= SPELLED].tolist():
        while b - a >= SPELLED:
            doc = int(np.searchsorted(ends, a, "right"))
            stop = min(b, int(ends[doc]))
            if stop - a >= SPELLED:
                word = "".join(folded(p) for p in pieces.take(pa.array(flat[a:stop])).to_pylist())
                result[doc] = max(result[doc], model.margins(_parts(word)).max())
            a = stop


def _margin_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            margins = score(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(margins, pa.float64()), batch.column("y")], names=["margin", "y"]
            )

    return run


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(fold(doc_id, 4) == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, a row per row of ``docs``."""
    model = fit(docs, labels, ~_held_out())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = probability(score(model, batch.column("text")), model.curve)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    own = docs.select(F.col("doc_id").cast("bigint"), "text")
    found = in_arrow(own, run, "doc_id bigint, score double")
    return found.select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, all columns as they are."""
    model = fit(docs, labels, ~_held_out())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            margins = score(model, batch.column("text"))
            yield batch.filter(pa.array(probability(margins, model.curve) < THRESHOLD))

    return in_arrow(docs, run, docs.schema)
