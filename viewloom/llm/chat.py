"""Chat formatting: a finite-state machine over roles and a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@lru_cache
def _breaks(controls: tuple[str, ...]) -> re.Pattern:
    """Matches the escape character and the first character of each control string, overlapping ones too."""
    heads: dict[str, list[str]] = {}
    for control in controls:
        heads.setdefault(control[0], []).append(re.escape(control[1:]))
    return re.compile("|".join([re.escape(ESCAPE), *(f"{re.escape(h)}(?={'|'.join(tails)})" for h, tails in heads.items())]))


@dataclass(frozen=True)
class RoleMarks:
    """How a turn of a role begins and ends, and whether its text is learned."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of the known roles, marks for any other role (its name stands between ``open`` and ``named``), and the turn order.

    ``moves`` maps a state to the next state by role. A conversation starts in ``start``, a turn without a move is an error and leads
    to the state ``lost``; it is in order if it ends in one of ``final`` and met no error. All marks must differ and hold no escape character.
    """

    roles: dict[str, RoleMarks]
    other: RoleMarks
    named: str
    moves: dict[str, dict[str, str]]
    start: str
    final: frozenset[str]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for r in [*self.roles.values(), self.other] for m in (r.open, r.close)] + [self.named]
        if len(set(marks)) < len(marks) or any(not m or ESCAPE in m or len(m) < 2 for m in marks):
            raise ValueError("marks must be distinct, of two characters at least, and without the escape character")
        object.__setattr__(self, "controls", tuple(sorted(marks, key=len, reverse=True)))

    def escape(self, text: str) -> str:
        """A text without any control string: the escape character is doubled, and put behind the first character of each control string."""
        return _breaks(self.controls).sub(lambda m: m[0] + ESCAPE, text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


LLAMA_STYLE = Template(
    roles={
        "system": RoleMarks("<<SYS>>", "<</SYS>>"),
        "user": RoleMarks("[INST]", "[/INST]"),
        "assistant": RoleMarks("<s>", "</s>", loss=True),
    },
    other=RoleMarks("<<ROLE>>", "<</ROLE>>"),
    named="<<SAYS>>",
    moves={
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="start",
    final=frozenset({"answered"}),
)

#: One row per piece of formatted text.
SEGMENT = "conv_id long, segment long, turn long, text string, loss boolean, state string"


def segments(turns: DataFrame, template: Template = LLAMA_STYLE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The formatted conversations as rows (conv_id, segment, turn, text, loss, state).

    Segments and turns are numbered from 0 in a conversation; each turn gives its opening mark, its escaped text (under the loss mask if the
    role is learned) and its closing mark. ``state`` is the state of the machine after the turn, ``lost`` from the first turn that is out of order.
    Text and role that are null count as empty, a null turn comes first, ties are ordered by role and text, repeated rows are turns of their own, rows
    with a null conversation form one conversation. Rows are sorted by conversation in each partition, and read one by one: a
    long conversation is streamed and never held. The result keeps that order.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("t"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("r"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("x")
    )
    dealt = rows.repartition("c").sortWithinPartitions("c", "t", "r", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, segment, number = object(), template.start, 0, 0
        for batch in batches:
            out: list[tuple] = []
            for c, r, x in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != now:
                    now, state, segment, number = c, template.start, 0, 0
                state = template.moves.get(state, {}).get(r, "lost")
                marks = template.roles.get(r)
                opening = marks.open if marks else template.other.open + template.escape(r) + template.named
                marks = marks or template.other
                for piece, loss in ((opening, False), (template.escape(x), marks.loss), (marks.close, False)):
                    out.append((c, segment, number, piece, loss, state))
                    segment += 1
                number += 1
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=["conv_id", "segment", "turn", "text", "loss", "state"])

    return dealt.mapInArrow(run, SEGMENT)


class Reader:
    """Reads formatted text back, piece by piece: turns as (role, text), and digests of turns and of what the loss mask covers."""

    def __init__(self, template: Template):
        self.template = template
        self.marks = re.compile("|".join(map(re.escape, template.controls)))
        self.opens = {m.open: r for r, m in template.roles.items()}
        self.closes = {m.close for m in [*template.roles.values(), template.other]}
        self.role: str | None = None
        self.held = ""
        self.turns = self.chars = self.loss_chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss: bool) -> None:
        """A piece never splits a mark; the text of a turn may come in several pieces."""
        self.chars += len(text)
        if loss:
            plain = self.template.unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(_bytes(plain))
        at = 0
        for m in self.marks.finditer(text):
            self.held += text[at : m.start()]
            at = m.end()
            if m[0] in self.opens:
                self.role, self.held = self.opens[m[0]], ""
            elif m[0] == self.template.other.open:
                self.role, self.held = None, ""
            elif m[0] == self.template.named:
                self.role, self.held = self.template.unescape(self.held), ""
            elif m[0] in self.closes:
                self.turns += 1
                self.turns_hash.update(_bytes(f"{self.role}\n{self.template.unescape(self.held)}\n"))
                self.held = ""
        self.held += text[at:]

    def row(self, conv: int | None, state: str) -> tuple:
        ordered = state in self.template.final
        return conv, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars, ordered


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"


def read_back(formatted: DataFrame, template: Template = LLAMA_STYLE, sorted_by_conversation: bool = False) -> DataFrame:
    """One row per conversation, from its formatted text and loss mask alone: what ``segments`` gives, in any order.

    ``in_order`` says whether the machine accepted the turns. With ``sorted_by_conversation`` the rows come as ``segments`` deals them and are not sorted again.
    Digests are kept while the segments stream by. An empty table gives an empty result.
    """
    rows = formatted.select("conv_id", "segment", "text", "loss", "state")
    if not sorted_by_conversation:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, last = None, None, ""
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        names = [x.split()[0] for x in DIGEST.split(", ")]

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            out = []
            for c, text, loss, state in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if reader is None or c != now:
                    if reader is not None:
                        out.append(reader.row(now, last))
                    now, reader = c, Reader(template)
                reader.feed(text, loss)
                last = state
            if out:
                yield frame(out)
        if reader is not None:
            yield frame([reader.row(now, last)])

    return rows.mapInArrow(run, DIGEST)
