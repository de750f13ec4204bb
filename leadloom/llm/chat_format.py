"""Chat formatting with a grammar round trip."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The markers of the template, and strings that chat models take for control tokens.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL_STRINGS = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LEARNED_ROLE = "assistant"


class Turn(NamedTuple):
    role: str
    text: str
    begin: int  # of the text as it stands in the formatted string
    end: int


# Every control string is its first character and a rest; an escape puts a backslash between them.
_RESTS = {f: "|".join(re.escape(c[1:]) for c in CONTROL_STRINGS if c[0] == f) for f in "<["}
_PLAIN = re.compile("|".join(re.escape(c) for c in CONTROL_STRINGS))
_ANY = re.compile("|".join(rf"{re.escape(f)}\\*(?={rest})" for f, rest in _RESTS.items()))
_ESCAPED = re.compile("|".join(rf"{re.escape(f)}\\+(?={rest})" for f, rest in _RESTS.items()))


def escape(text: str) -> str:
    """One more backslash in every control string, escaped ones included, so that it can be undone."""
    return _ANY.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """One backslash less in every escaped control string."""
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


def _header(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role(header: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(header))


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted string, in one pass without backtracking.

    The grammar is (START header NEWLINE body END NEWLINE)*; a plain control string may stand
    only where the grammar has it. Anything else raises ValueError.
    """
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if not formatted.startswith(START, at) or line < 0:
            raise ValueError(f"no turn begins at {at}")
        header = formatted[at + len(START) : line]
        marker = _PLAIN.search(formatted, line + 1)
        if _PLAIN.search(header) or marker is None or marker[0] != END or not formatted.startswith("\n", marker.end()):
            raise ValueError(f"the turn at {at} does not end as it should")
        turns.append(Turn(_role(header), unescape(formatted[line + 1 : marker.start()]), line + 1, marker.start()))
        at = marker.end() + 1
    return turns


def render(role: str, text: str) -> tuple[str, Turn]:
    """One formatted turn and what the parser reads back from it.

    The text goes in as it is; where the parser then does not recover exactly this one turn,
    its control strings are escaped and the turn is parsed again.
    """
    for body in (text, escape(text)):
        piece = f"{START}{_header(role)}\n{body}{END}\n"
        try:
            turns = parse(piece)
        except ValueError:
            continue
        if len(turns) == 1 and (turns[0].role, turns[0].text) == (role, text):
            return piece, turns[0]
    raise ValueError(f"a turn of {role!r} cannot be recovered")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``formatted``, ``loss_begin``, ``loss_end``.

    The formatted conversation is its turns one after another, by ``turn`` (null first) and
    then by the formatted text. It is kept as turns, so a conversation of any length is
    formatted by many tasks. The loss mask covers the text of assistant turns: code points
    [``loss_begin``, ``loss_end``) of the turn; null elsewhere. Null roles and texts are
    empty; repeated rows are turns of their own; other columns are not read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, begins, ends = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                piece, turn = render(role or "", text or "")
                learned = turn.role == LEARNED_ROLE
                pieces.append(piece)
                begins.append(turn.begin if learned else None)
                ends.append(turn.end if learned else None)
            columns = [batch.column(0), batch.column(1), pa.array(pieces, pa.string())]
            columns += [pa.array(x, pa.int64()) for x in (begins, ends)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "formatted", "loss_begin", "loss_end"])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return rows.mapInArrow(task, "conv_id long, turn long, formatted string, loss_begin long, loss_end long")


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, begin: int | None, end: int | None) -> None:
        for turn in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
        if begin is not None:
            learned = unescape(formatted[begin:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_READ_BACK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the rows of ``format_turns``.

    ``n_turns``, ``turns_sha256`` (role, newline, text, newline of each turn), ``loss_chars`` and
    ``loss_sha256`` (unescaped text under the loss mask), ``formatted_chars``. A digest runs
    over a conversation in order, so its turns meet in one task; they pass through it as a
    sorted stream, and the task holds one batch of them however long a conversation is.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Digest | None = None
        for batch in batches:
            done = []
            for conv_id, piece, begin, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if current is None or current.conv_id != conv_id:
                    if current:
                        done.append(current.row())
                    current = _Digest(conv_id)
                current.add(piece, begin, end)
            yield _batch(done)
        if current:
            yield _batch([current.row()])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(
        task,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in _READ_BACK]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ_BACK)], schema=_READ_BACK)


def escaped_sql(text: str) -> str:
    """``escape`` as DuckDB SQL, written with one replacement per first character."""
    for first, rest in _RESTS.items():
        text = rf"regexp_replace({text}, '({re.escape(first)}\\*)({rest})', '\1\\\2', 'g')"
    return text
