"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  Successive turn prefixes are rendered
and consecutive outputs compared: what the longer output adds is the turn's piece, and where a marker in place of
the text comes up in it is the text's span.  A template whose longer output does not begin with the shorter one
rewrites history; its pieces then say how much of the output before them stays.

The rows of a conversation pass through one task in order of turn, as a running digest needs.  Every prefix is
rendered whole, as a template may look at any turn before, so a task holds the turns of one conversation and its
last output, and the time of a conversation grows with the square of its turns.  A template that declares by
``appends`` how far it looks back is rendered on those turns only: time is then linear and a task holds a few turns.
The declaration is compared with whole renderings after 1, 2, 4, ... ``CHECKED_TURNS`` turns of each conversation.

Defined cases: a null text or role is empty.  Turns are ordered by turn (null first), role and text; repeated rows
are turns of their own.  Rows with a null id are one conversation.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_LEXEME = re.compile(r"\\.|" + _CONTROL.pattern, re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
MARK = "\ue0f0\ue0f1\ue0f2"  # private-use code points
CHECKED_TURNS = 64

PIECES = """conv_id long, number long, role string, piece string, stays long, rewrites boolean,
loss_from long, loss_to long"""


def escape(text: str) -> str:
    """Backslashes doubled, one put before every control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def appends(look_back: int = 0) -> Callable[[Template], Template]:
    """Declares that a template only appends, and that a turn's piece depends on nothing but whether it is the first,
    the turn and the ``look_back`` turns before it.
    """

    def declare(template: Template) -> Template:
        template.look_back = look_back
        return template

    return declare


def bracket_template(turns: list[Turn]) -> str:
    """``[INST] user [/INST] assistant </s>``; any other role is named in ``[ROLE]`` marks."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)} </s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE] {escape(text)} </s>")
    return "".join(out)


class BracketReader:
    """Turns of text written by ``bracket_template``, fed piece by piece."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[Turn]:
        self.rest += piece
        while (found := self._one()) is not None:
            turn, end = found
            self.rest = self.rest[end:]
            yield turn

    def _one(self) -> tuple[Turn, int] | None:
        marks = ((m[0], m.start(), m.end()) for m in _LEXEME.finditer(self.rest) if m[0][0] != "\\")
        for mark, start, end in marks:
            if mark == "[INST]":
                close = next(marks, None)
                return close and (("user", unescape(self.rest[end + 1 : close[1] - 1])), close[2])
            if mark == "[ROLE]":
                named, close = next(marks, None), next(marks, None)
                return close and ((unescape(self.rest[end : named[1]]), unescape(self.rest[named[2] + 1 : close[1] - 1])), close[2])
            return ("assistant", unescape(self.rest[1 : start - 1])), end
        return None


def locate(template: Template, before: list[Turn], turn: Turn) -> tuple[str, int, bool, int, int]:
    """``piece, stays, rewrites, from, to`` of ``turn`` after the turns ``before``; -1 where the text is not found."""
    return _compare(template, before, turn, template(before), template([*before, turn]))


def _compare(template: Template, before: list[Turn], turn: Turn, shorter: str, longer: str) -> tuple[str, int, bool, int, int]:
    """``locate`` with the outputs before and after ``turn``."""
    mark = MARK
    while mark in turn[0]:
        mark += MARK[-1]
    probe = template([*before, (turn[0], mark)])
    stays, rewrites = len(shorter), not longer.startswith(shorter)
    if rewrites:
        stays = len(os.path.commonprefix([shorter, longer]))
    piece, at = longer[stays:], probe.find(mark, min(stays, len(probe)))
    if at < 0:
        return piece, stays, rewrites, -1, -1
    head, tail = probe[:at], probe[at + len(mark) :]
    if len(longer) < len(head) + len(tail) or not (longer.startswith(head) and longer.endswith(tail)):
        return piece, stays, rewrites, -1, -1
    return piece, stays, rewrites, len(head) - stays, len(longer) - len(tail) - stays


class _Prefixes:
    """The successive prefixes of one conversation: whole ones, or the turns that a declared template looks back to."""

    def __init__(self, template: Template):
        self.template, self.look_back = template, getattr(template, "look_back", None)
        self.before: list[Turn] = []
        self.shorter, self.turns, self.chars = template([]), 0, 0
        self.first: list[Turn] = []
        self.shown = hashlib.sha256()

    def add(self, turn: Turn) -> tuple[str, int, bool, int, int]:
        longer = self.template([*self.before, turn])
        found = _compare(self.template, self.before, turn, self.shorter, longer)
        self.before.append(turn)
        self.turns += 1
        if self.look_back is None:
            self.shorter = longer
            return found
        piece, _, rewrites, lo, hi = found
        if not self.turns - 1:  # what an empty conversation shows stays too
            self.chars = len(self.shorter)
            self.shown.update(_utf8(self.shorter))
        stays, self.chars = self.chars, self.chars + len(piece)
        self._check(turn, piece, rewrites)
        window = max(1, self.look_back)
        if len(self.before) > window:
            del self.before[:-window]
            longer = self.template(self.before)
        self.shorter = longer
        return piece, stays, False, lo, hi

    def _check(self, turn: Turn, piece: str, rewrites: bool) -> None:
        broken = rewrites
        if self.turns <= CHECKED_TURNS:
            self.first.append(turn)
            self.shown.update(_utf8(piece))
            if self.turns & (self.turns - 1) == 0:
                broken = broken or hashlib.sha256(_utf8(self.template(self.first))).digest() != self.shown.digest()
        else:
            self.first = []
        if broken:
            raise ValueError(f"the template does not append as it declares, seen at turn {self.turns}")


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def format_turns(
    turns: DataFrame, template: Template = bracket_template, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """The pieces of all conversations of ``turns`` (``conv_id, turn, role, text``), in order within a conversation.

    ``loss_from`` and ``loss_to`` are code points of the piece under the loss mask, -1 where nothing is.
    """

    def render(batches):
        conversation, prefixes = object(), None
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != conversation:
                    conversation, prefixes = conv, _Prefixes(template)
                turn = (role or "", text or "")
                number = prefixes.turns
                piece, stays, rewrites, lo, hi = prefixes.add(turn)
                if turn[0] not in loss_roles:
                    lo = hi = -1
                rows.append((conv, number, turn[0], piece, stays, rewrites, lo, hi))
            yield _batch(rows, PIECES)

    text = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    order = text.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return order.select("conv_id", "role", "text").mapInArrow(render, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.replace("\n", " ").split(",")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


DIGESTS = """conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
formatted_chars long"""


def digests(pieces: DataFrame) -> DataFrame:
    """What the formatted text of each conversation holds, read back from its pieces alone."""

    def read(batches):
        conversation, state = object(), None
        for batch in batches:
            rows = []
            for conv, piece, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_from", "loss_to")), strict=True):
                if conv != conversation:
                    if state is not None:
                        rows.append(_digest(conversation, state))
                    conversation = conv
                    state = {"reader": BracketReader(), "turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "loss_chars": 0, "chars": 0}
                for role, text in state["reader"].feed(piece):
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    state["n"] += 1
                state["chars"] += len(piece)
                if lo >= 0:
                    text = unescape(piece[lo:hi])
                    state["loss"].update(text.encode())
                    state["loss_chars"] += len(text)
            yield _batch(rows, DIGESTS)
        if state is not None:
            yield _batch([_digest(conversation, state)], DIGESTS)

    order = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "number")
    return order.select("conv_id", "piece", "loss_from", "loss_to").mapInArrow(read, DIGESTS)


def _digest(conversation, state: dict) -> tuple:
    if state["reader"].rest:
        raise ValueError(f"conversation {conversation} ends inside a turn")
    return (conversation, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])
