"""Chat formatting with a grammar round trip.

A conversation is rendered as a sequence of turns, each between marks that
name its role; what an assistant says lies under the loss mask. The rendered
text is read again by a deterministic parser and compared with the source. A
turn that is not recovered is escaped further until it is:

  0  as it is
  1  a backslash before every control string in it
  2  the same, and every backslash doubled

The parser takes a backslash and the character after it as that character, so
level 2 always reads back. Marks begin and end every turn, and no control
string can straddle two turns, so a conversation parses to its turns exactly if
each turn parses alone. Reading back takes a conversation as one text: the
parser carries its state from row to row and is not told where a row ends. Only
a turn is held in memory, never a conversation.

Scale. Rendering is row by row, without a shuffle. Digests of a conversation
need its turns in order: rows are sorted by (conversation, turn) and streamed,
so a conversation of any length passes through in bounded memory.

Cases: a null text or role is an empty one; any role is allowed, and kept; a
null turn sorts first, turns that tie sort by role, then text; repeated rows
are repeated turns; a null ``conv_id`` is a conversation of its own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The template's marks: (begin, end) of a turn by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
#: A turn of any other role: its name stands between ROLE marks, escaped alike.
OTHER, OTHER_END = "<<ROLE>>", "<</ROLE>>"
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", OTHER, OTHER_END)
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TOKEN = re.compile(r"\\(?s:.)|" + _CONTROL.pattern)
LOSS_ROLE = "assistant"


class Unreadable(ValueError):
    """Text that the grammar does not derive."""


def escaped(text: str, level: int) -> str:
    if level == 2:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: "\\" + m[0], text) if level else text


class Reader:
    """The parser, fed a rendered text in pieces that may be cut anywhere.

    It keeps the turn it is in and the last few characters, where a mark may
    have begun; where pieces end tells it nothing.
    """

    #: More characters than a mark and its blank have.
    HELD = max(map(len, CONTROL)) + 2

    def __init__(self) -> None:
        self.text, self.at, self.base = "", 0, 0   # what is not read yet, from where, and where it began
        self.role: str | None = None               # of the turn it is in
        self.end = ""                              # the mark that ends what it is in; none between turns
        self.start = 0
        self.out: list[str] = []

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int, int]]:
        """(role, text, body start, body end, turn end) of each turn that ends in what has come so far."""
        self.base += self.at
        self.text, self.at = self.text[self.at:] + piece, 0
        while self.at < len(self.text):
            if not self.end:
                if not self._begin():
                    return
            elif (body := self._body()) is None:
                return
            elif self.role is None:
                self.role, self.start = body[0], self.base + self.at
            else:
                text, stop = body
                yield self.role, text, self.start, stop, self.base + self.at
                self.role, self.end = None, ""

    def close(self) -> None:
        """The text ends here."""
        if self.end or self.at < len(self.text):
            raise Unreadable("no end mark")

    def _begin(self) -> bool:
        for role, begin, end in [(r, b, e) for r, (b, e) in MARKS.items()] + [(None, OTHER, OTHER_END)]:
            if self.text.startswith(begin, self.at):
                self.at += len(begin)
                self.role, self.end, self.start, self.out = role, end, self.base + self.at, []
                return True
            if len(self.text) - self.at < len(begin) and begin.startswith(self.text[self.at:]):
                return False
        raise Unreadable("no begin mark")

    def _body(self) -> tuple[str, int] | None:
        """Unescaped text up to the mark ``end`` and where it stops; None if the mark has not come yet."""
        mark = self.end.strip()
        pad = self.end[: len(self.end) - len(mark)]
        while (m := _TOKEN.search(self.text, self.at)) is not None:
            if m[0][0] == "\\":
                self.out += self.text[self.at:m.start()], m[0][1]
                self.at = m.end()
            elif m[0] == mark and self.text.endswith(pad, self.at, m.start()):
                stop = m.start() - len(pad)
                body = "".join(self.out) + self.text[self.at:stop]
                self.at, self.out = m.end(), []
                return body, self.base + stop
            else:
                raise Unreadable(m[0])
        if (sure := len(self.text) - self.HELD) > self.at:
            self.out.append(self.text[self.at:sure])
            self.at = sure
        return None


def parse(text: str) -> Iterator[tuple[str, str, int, int, int]]:
    """(role, text, body start, body end, turn end) of each turn of a rendered text."""
    reader = Reader()
    yield from reader.feed(text)
    reader.close()


def render_turn(role: str, text: str) -> str:
    """The shortest rendering of a turn that the parser reads back as it was."""
    for level in (0, 1, 2):
        if role in MARKS:
            begin, end = MARKS[role]
            out = begin + escaped(text, level) + end
        else:
            out = OTHER + escaped(role, 2) + OTHER_END + escaped(text, level) + OTHER_END
        try:
            if [t[:2] for t in parse(out)] == [(role, text)]:
                return out
        except Unreadable:
            pass
    raise AssertionError("level 2 reads back by construction")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted) per row of ``turns``.

    The ``formatted`` of a conversation, in order, are its formatted text. Null
    roles and texts come out empty.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                        ("formatted", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            roles, texts = part.column(2).to_pylist(), part.column(3).to_pylist()
            out = [render_turn(r, t) for r, t in zip(roles, texts)]
            yield pa.record_batch([*part.columns, pa.array(out, pa.string())], schema=schema)

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *plain)
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, formatted string")


def read_back(rendered: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says, a row per conversation.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars),
    from ``formatted`` alone: one parser reads the conversation through, whatever
    its rows are cut at, and turns are hashed as they stream by. A conversation
    that is no rendered text ends the job with an error that names it.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, loss, n, chars, size, reader = None, None, None, 0, 0, 0, Reader()

        def read(step: Callable, *given: str) -> list:
            try:
                return list(step(*given) or [])
            except Unreadable as e:
                raise Unreadable(f"conversation {conv}: {e}") from e

        for part in parts:
            done = []
            for key, formatted in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if turns is None or key != conv:
                    if turns is not None:
                        read(reader.close)
                        done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                    conv, turns, loss, n, chars, size, reader = key, hashlib.sha256(), hashlib.sha256(), 0, 0, 0, Reader()
                size += len(formatted)
                for role, text, *_ in read(reader.feed, formatted):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        loss.update(text.encode())
                        chars += len(text)
            yield _digests(done, schema)
        if turns is not None:
            read(reader.close)
            yield _digests([(conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)], schema)

    spread = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return spread.select("conv_id", "formatted").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
