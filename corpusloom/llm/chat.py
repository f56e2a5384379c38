"""Chat formatting with loss masks (operator 10).

A declarative template names the marks of a turn.  A finite-state machine over
the roles checks the order of turns and emits text segments, each with a flag
that says whether it counts for the loss.  Rows are dealt out by conversation
and streamed in order of turns, so a conversation of any length is formatted in
constant memory; only one turn at a time is held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, turn_no long, seg_no long, kind string, text string, loss boolean, valid boolean"


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the roles' names in them, the roles that are learned, and which role may follow which.

    In a text the escape and the first characters of both marks are followed by
    the escape, which no mark has as its second character: so no mark can appear
    inside a text, and taking the escapes out again gives the text back.
    """

    opening: str = "### "
    naming: str = ": "
    closing: str = "</turn>\n"
    escape: str = "\\"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    learned: frozenset[str] = frozenset({"assistant"})
    start: frozenset[str] = frozenset({"system", "user"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {"system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})

    def __post_init__(self) -> None:
        for mark in (self.opening, self.naming, self.closing):
            if len(mark) < 2 or len(self.escape) != 1 or self.escape in mark[:2]:
                raise ValueError("marks have two characters at least and none of these is the escape")

    def _risky(self, more: str = "") -> str:
        """A pattern of the characters that are guarded."""
        return "[" + re.escape("".join(sorted({self.escape, self.opening[0], self.closing[0], *more}))) + "]"

    def _guard(self, text: str, more: str = "") -> str:
        return re.sub(self._risky(more), lambda m: m[0] + self.escape, text)

    def unguard(self, text: str, more: str = "") -> str:
        return re.sub(f"({self._risky(more)}){re.escape(self.escape)}", r"\1", text)

    def head(self, role: str) -> str:
        """The opening of a turn; a role without a name is written out after ``=``."""
        name = self.names.get(role)
        return f"{self.opening}{name if name is not None else '=' + self._guard(role, self.naming[0])}{self.naming}"

    def body(self, text: str) -> str:
        return self._guard(text)

    def parse(self, turn: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        named, said = (f"((?:(?!{self._risky(x)}).|{self._risky(x)}{re.escape(self.escape)})*)" for x in (self.naming[0], ""))
        found = re.fullmatch(f"{re.escape(self.opening)}{named}{re.escape(self.naming)}{said}{re.escape(self.closing)}", turn, re.S)
        if not found:
            raise ValueError("not a formatted turn")
        roles = {name: role for role, name in self.names.items()}
        role = self.unguard(found[1][1:], self.naming[0]) if found[1].startswith("=") else roles[found[1]]
        return role, self.unguard(found[2])


def in_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation in one partition, by turn; rows of the same turn by role and text, nulls first."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Formats ``conversations(conv_id, turn, role, text)``: three segments a turn, in order within partitions.

    ``valid`` is true while the roles seen so far follow the template's order.
    A null role or text is as empty; a row of a null conversation belongs to
    the conversation null; repeated rows are turns of their own; other columns
    are ignored.  The text of the turns of learned roles has ``loss``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, last, turn_no, valid = object(), None, 0, True
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                out: list[tuple] = []
                for c, role, text in zip(*(batch.column(i).slice(begin, 1000).to_pylist() for i in (0, 2, 3)), strict=True):
                    if c != conv:
                        conv, last, turn_no, valid = c, None, 0, True
                    valid = valid and role in (template.start if last is None else template.follows.get(last, ()))
                    parts = (("head", template.head(role)), ("body", template.body(text)), ("close", template.closing))
                    out += [(c, turn_no, 3 * turn_no + i, kind, part, kind == "body" and role in template.learned, valid) for i, (kind, part) in enumerate(parts)]
                    last, turn_no = role, turn_no + 1
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["conv_id", "turn_no", "seg_no", "kind", "text", "loss", "valid"])

    return in_order(conversations).mapInArrow(run, SEGMENTS)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of what stands in the segments, in the order in which ``segments`` gives them.

    Roles and texts are parsed out of the formatted turns, the learned text is
    what the mask covers, unescaped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, turn, done = None, False, "", []
        state: dict = {}

        def fresh() -> dict:
            return {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0, "valid": True}

        def close() -> None:
            done.append((conv, state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"], state["valid"]))

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            columns = zip(*done, strict=True) if done else [[]] * 7
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"])
            done.clear()
            return batch

        for batch in batches:
            for c, text, kind, loss, valid in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "text", "kind", "loss", "valid")), strict=True):
                if not begun or c != conv:
                    if begun:
                        close()
                    conv, begun, turn, state = c, True, "", fresh()
                state["size"] += len(text)
                state["valid"] &= valid
                turn += text
                if loss:
                    plain = template.unguard(text)
                    state["chars"] += len(plain)
                    state["loss"].update(plain.encode())
                if kind == "close":
                    role, plain = template.parse(turn)
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{plain}\n".encode())
                    turn = ""
            yield flush()
        if begun:
            close()
            yield flush()

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
