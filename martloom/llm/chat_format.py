"""Chat formatting with a grammar round trip.

Each turn is rendered between control strings, parsed again by a deterministic parser, and
compared with its source. If they differ, because the text holds control strings itself, those
are escaped by a backslash and the turn is rendered again, until the parser gives back the very
same turn. A turn's rendering does not depend on its neighbours, so a conversation of any
length is rendered in parallel and written as consecutive pieces; its formatted text is the
pieces one after another. Beside each piece stand the borders of its loss mask, the assistant's
text in code points of the piece.

Grammar (a control string preceded by a backslash is text)::

    turn    := "[INST] " text " [/INST]"            user
             | "<s> " text " </s>"                  assistant
             | "<<SYS>> " text " <</SYS>>"          system
             | "[ROLE] " role " [TEXT] " text " [/ROLE]"   any other role

Defined cases: a null text is empty; a null role is an empty one; turns with the same number,
or without one (these come first), follow by role and rendered text; rows without a conv_id
are one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import in_arrow, sliced
from martloom.operators.scratch import scratch_path

TAGS = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
    "system": ("<<SYS>> ", " <</SYS>>"),
}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
CONTROLS = tuple(t.strip() for pair in (*TAGS.values(), OTHER) for t in pair)
LEARNED = "assistant"

_CONTROL = re.compile(r"(\\*)(" + "|".join(map(re.escape, CONTROLS)) + ")")
_ROLE_OF = {opening.strip(): role for role, (opening, _) in TAGS.items()}

FORMATTED = (
    "conv_id bigint, turn bigint, role string, piece string, mask_start int, mask_end int"
)
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint,"
    " loss_sha256 string, formatted_chars bigint"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[1]}\\{m[2]}", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1][:-1] + m[2], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn between its control strings, and where its text stands."""
    if role in TAGS:
        opening, closing = TAGS[role]
    else:
        opening, closing = f"{OTHER[0]}{role}{OTHER[1]}", OTHER[2]
    return opening + text + closing, len(opening), len(opening) + len(text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; an error where it does not follow the grammar."""
    controls = [m for m in _CONTROL.finditer(formatted) if not m[1]]
    turns, at, i = [], 0, 0

    def expect(control: str) -> re.Match:
        nonlocal i
        if i >= len(controls) or controls[i][2] != control:
            raise ValueError(f"{control} expected after {at}")
        i += 1
        return controls[i - 1]

    def content(opening: re.Match, closing: re.Match) -> str:
        start, end = opening.end() + 1, closing.start() - 1
        if end < start or formatted[start - 1] != " " or formatted[end] != " ":
            raise ValueError(f"blanks expected around the text at {start}")
        return unescape(formatted[start:end])

    while at < len(formatted):
        if i >= len(controls) or controls[i].start() != at:
            raise ValueError(f"a control string expected at {at}")
        opening = controls[i]
        i += 1
        if opening[2] in _ROLE_OF:
            role = _ROLE_OF[opening[2]]
            closing = expect(TAGS[role][1].strip())
        elif opening[2] == OTHER[0].strip():
            middle = expect(OTHER[1].strip())
            role = content(opening, middle)
            opening, closing = middle, expect(OTHER[2].strip())
        else:
            raise ValueError(f"{opening[2]} opens no turn")
        turns.append((role, content(opening, closing)))
        at = closing.end()
    return turns


def _same(piece: str, role: str, text: str) -> bool:
    try:
        return parse(piece) == [(role, text)]
    except ValueError:
        return False


def round_trip(role: str, text: str) -> tuple[str, int, int]:
    """Render a turn so that the parser gives it back: as it is, else with what conflicts
    escaped."""
    for shown_role, shown in ((role, text), (escape(role), escape(text))):
        # an unknown role never looks like one of the named ones
        rendered = render(shown_role if role not in TAGS else role, shown)
        if _same(rendered[0], role, text):
            return rendered
    raise ValueError(f"a turn cannot be rendered: {role[:50]!r}, {text[:50]!r}")


def formatted(conversations: DataFrame) -> DataFrame:
    """A piece per turn, with the borders of its loss mask (null where nothing is learned)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            found = [round_trip(r, t) for r, t in zip(roles, texts, strict=True)]
            masks = [(a, b) if r == LEARNED else (None, None) for r, (_, a, b) in zip(roles, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    batch.column("role"),
                    pa.array([piece for piece, _, _ in found], pa.string()),
                    pa.array([a for a, _ in masks], pa.int32()),
                    pa.array([b for _, b in masks], pa.int32()),
                ],
                names=["conv_id", "turn", "role", "piece", "mask_start", "mask_end"],
            )

    own = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return in_arrow(own, run, FORMATTED)


_ORDER = ("conv_id", "turn", "role", "piece")


def write(conversations: DataFrame, folder: str) -> None:
    """Write the pieces in order. Ranges over turns too, so a conversation with a large part of
    all turns is sorted and written by many tasks."""
    pieces = formatted(conversations)
    pieces = pieces.repartitionByRange("conv_id", "turn", F.xxhash64("piece"))
    pieces.sortWithinPartitions(*_ORDER).write.mode("overwrite").parquet(folder)


class _Conversation:
    """What is kept of a conversation while its pieces pass: two running digests."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        for role, text in parse(piece):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescape(piece[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(piece)

    def row(self) -> tuple:
        turns, loss = self.turns.hexdigest(), self.loss.hexdigest()
        return self.conv_id, self.n_turns, turns, self.loss_chars, loss, self.chars


def read_digests(pieces: DataFrame) -> DataFrame:
    """A row per conversation, from its pieces in order. A digest needs its conversation's
    pieces one after another, but they only pass by: memory holds one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
            + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )
        current: _Conversation | None = None
        for batch in sliced(batches, "piece"):
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "mask_start", "mask_end")]
            for conv_id, piece, start, end in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current:
                        done.append(current.row())
                    current = _Conversation(conv_id)
                current.add(piece, start, end)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)],
                    schema=schema,
                )
        if current:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(current.row(), schema, strict=True)], schema=schema
            )

    ordered = pieces.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return in_arrow(ordered, run, DIGESTS)


def digests(conversations: DataFrame) -> DataFrame:
    """Write the formatted conversations below the scratch folder and read them back."""
    spark = conversations.sparkSession
    folder = scratch_path(spark, "chats")
    write(conversations, folder)
    return read_digests(spark.read.schema(FORMATTED).parquet(folder))


def with_conflict(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts look like the end and start of turns."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    schema = "conv_id bigint, turn bigint, role string, text string"
    own = conversations.select("conv_id", "turn", "role", "text")
    return own.unionByName(conversations.sparkSession.createDataFrame(rows, schema))
