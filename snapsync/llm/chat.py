"""Chat formatting: a finite-state machine over roles, and a declarative template.

A template names the marks around a turn, the roles whose texts carry loss, and which
role may follow which. Each turn becomes segments with a loss flag each; joined in order
they are the formatted conversation. A text cannot break out of its turn: wherever it
has ``<``, any number of backslashes and ``|``, one backslash is added, so that no mark
occurs in it; taking one away gives the text back.

Turns are ordered by ``turn`` (NULL first), then role and text; repeated rows are turns
of their own. NULL roles and texts are empty. A conversation with an invalid order of
roles is formatted as well, and marked. Turns are formatted where they lie, and each is
parsed back there. The task of a conversation streams over its sorted turns for their order
and the state of the machine. What is read back comes from the segments alone: they are
joined and parsed again as one text, of which a turn at a time is in memory, so that a
conversation may be of any length. Columns other than the four are left out.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.llm.common import slices


@dataclass(frozen=True)
class Template:
    """``open`` has the place of the role as {role}; it and ``close`` hold ``<|`` marks."""

    open: str
    close: str
    loss_roles: frozenset[str]
    start: str
    follows: dict[str, frozenset[str]] = field(hash=False)
    final: frozenset[str] = frozenset()

    def step(self, state: str | None, role: str) -> str | None:
        """The state after a role; None once the order is broken."""
        return role if state is not None and role in self.follows.get(state, ()) else None


CHATML = Template(
    open="<|im_start|>{role}\n",
    close="<|im_end|>\n",
    loss_roles=frozenset({"assistant"}),
    start="",
    follows={
        "": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    final=frozenset({"assistant"}),
)

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escaped_role(role: str) -> str:
    """A role on one line, without marks."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def turn_segments(role: str, text: str, template: Template) -> list[tuple[str, bool]]:
    return [
        (template.open.replace("{role}", escaped_role(role)), False),
        (escaped(text), role in template.loss_roles),
        (template.close, False),
    ]


SEGMENTS = "array<struct<text:string,loss:boolean>>"


# What a turn has beside its order.
TURN = f"role string, segments {SEGMENTS}"


def _turns(rows: DataFrame, template: Template) -> DataFrame:
    """Each turn by itself, formatted and held against what is parsed back.

    ``plain`` is its text where the escaped one differs: turns are ordered by it.
    """
    names = ["conv_id", "turn", "plain", *(f.split()[0] for f in TURN.split(", "))]

    def run(batches):
        parser = Parser(template)
        for batch in slices(batches):
            texts, losses, plains = [], [], []
            for role, text in zip(*(batch.column(c).to_pylist() for c in ("role", "text"))):
                parts = turn_segments(role, text, template)
                whole = "".join(t for t, _ in parts)
                if parser.turns(whole) != [(role, text)]:
                    raise ValueError("a turn is not read back as it was")
                texts += [t for t, _ in parts]
                losses += [loss for _, loss in parts]
                plains.append(None if parts[1][0] == text else text)
            flat = pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array(losses, pa.bool_())], ["text", "loss"]
            )
            at = pa.array(np.arange(batch.num_rows + 1) * 3, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(plains, pa.string()),
                    batch.column("role"),
                    pa.ListArray.from_arrays(at, flat),
                ],
                names,
            )

    kind = rows.schema["turn"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id long, turn {kind}, plain string, {TURN}")


def formatted(
    df: DataFrame,
    template: Template = CHATML,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn, in order within a partition: conv_id, position, state and TURN.

    ``state`` is the state of the machine after the turn, NULL once the order is invalid.
    All turns of a conversation are in one partition.
    """
    rows = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    own = F.coalesce(F.col("plain"), F.col("segments")[1]["text"])
    ordered = _turns(rows, template).repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", own).drop("plain")
    kept = [f.split()[0] for f in TURN.split(", ")]

    def run(batches):
        current, position, state = (), 0, None
        for batch in batches:
            positions, states = [], []
            for conv, role in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role"))):
                if conv != current:
                    current, position, state = conv, 0, template.start
                state = template.step(state, role)
                positions.append(position)
                states.append(state)
                position += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(positions, pa.int64()),
                    pa.array(states, pa.string()),
                    *(batch.column(c) for c in kept),
                ],
                ["conv_id", "position", "state", *kept],
            )

    return ordered.mapInArrow(run, f"conv_id long, position long, state string, {TURN}")


class Parser:
    """Turns back from formatted text, which may come in pieces."""

    def __init__(self, template: Template):
        before, after = template.open.split("{role}")
        self.turn = re.compile(
            re.escape(before) + "(.*?)" + re.escape(after) + "(.*?)" + re.escape(template.close),
            re.DOTALL,
        )
        self.rest = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        """The turns that ``text`` completes; what is left waits for more."""
        whole, found, at = self.rest + text, [], 0
        while match := self.turn.match(whole, at):
            found.append((unescaped_role(match[1]), unescaped(match[2])))
            at = match.end()
        self.rest = whole[at:]
        return found

    def end(self) -> None:
        if self.rest:
            left, self.rest = self.rest[:40], ""
            raise ValueError(f"no turn at {left!r}")

    def turns(self, text: str) -> list[tuple[str, str]]:
        found = self.feed(text)
        self.end()
        return found


class Reading:
    """A conversation as it is read back, segment by segment."""

    def __init__(self, template: Template):
        self.template, self.parser, self.state = template, Parser(template), template.start
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = 0

    def add(self, segments: list[tuple[str, bool]]) -> None:
        whole = "".join(t for t, _ in segments)
        self.chars += len(whole)
        for role, text in self.parser.feed(whole):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.state = self.template.step(self.state, role)
            self.n += 1
        for text, loss in segments:
            if loss:
                text = unescaped(text)
                self.loss.update(text.encode())
                self.loss_chars += len(text)

    def row(self, conv) -> pa.RecordBatch:
        self.parser.end()
        names = [f.split()[0] for f in READ.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        values = [
            conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            self.state in self.template.final,
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, valid boolean"
)


def read_back(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, from its segments alone: digests of the turns and the loss texts.

    ``turns`` is what ``formatted`` returns, a conversation in order in one partition.
    ``valid``: the roles came in an order that the template allows, up to a final one.
    """

    def run(batches):
        current, reading = (), None
        for batch in batches:
            lists = batch.column("segments")
            flat = lists.flatten()
            pieces = [*zip(flat.field(0).to_pylist(), flat.field(1).to_pylist())]
            at = 0
            for conv, n in zip(batch.column("conv_id").to_pylist(), pc.list_value_length(lists).to_pylist()):
                if conv != current:
                    if reading is not None:
                        yield reading.row(current)
                    current, reading = conv, Reading(template)
                reading.add(pieces[at : at + n])
                at += n
        if reading is not None:
            yield reading.row(current)

    return turns.select("conv_id", "segments").mapInArrow(run, READ)
