r"""Conversations as training text, with a grammar that reads every turn back.

A conversation is its turns one after the other, each ``### Role: `` text newline ``</turn>`` newline. A control string that stands in a
text has a backslash before it, and one more for each that stood there before; the parser takes one off. Rendering is
a round trip: a turn is rendered as it is, parsed again, and if the parser rejects it or gives another text, its control
strings are escaped and it is tried again, until the turn comes back identical.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
NAMES = {shown: role for role, shown in ROLES.items()}
END = "</turn>"
# Other roles are shown percent-encoded after this sign.
OTHER = "="
CONTROL = re.compile(r"(\\*)(### (?:System:|User:|Assistant:|=)|</turn>)")
HEADER = re.compile(r"### (System|User|Assistant|=[^:\n]*): ")


class Conflict(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def header(role: str) -> str:
    return f"### {ROLES.get(role) or OTHER + quote(role, safe='')}: "


def parse(shown: str) -> list[tuple[str, str, int, int]]:
    """Turns as (role, text, start, stop) with the span of the text in what is shown.

    The grammar is deterministic: a turn starts with a header and ends with the first control string that has no
    backslash before it, which must be the end sign.
    """
    turns, at = [], 0
    while at < len(shown):
        head = HEADER.match(shown, at)
        if not head:
            raise Conflict(f"no header at {at}")
        start = head.end()
        stop = next((m.start() for m in CONTROL.finditer(shown, start) if not m[1]), None)
        if stop is None or not shown.startswith(END + "\n", stop) or shown[stop - 1] != "\n" or stop == start:
            raise Conflict(f"no end of the turn at {at}")
        name = head[1]
        role = NAMES.get(name) or unquote(name[len(OTHER) :])
        turns.append((role, unescape(shown[start : stop - 1]), start, stop - 1))
        at = stop + len(END) + 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn as shown text that parses back to exactly this role and text, and the span of the text in it."""
    for content in (text, escape(text)):
        shown = f"{header(role)}{content}\n{END}\n"
        try:
            turns = parse(shown)
        except Conflict:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return shown, *turns[0][2:]
    raise Conflict(f"a turn of {role!r} does not come back")


def format_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every turn as shown text: (``conv_col``, ``turn_col``, formatted, loss_start, loss_stop).

    The text of a conversation is ``formatted`` of its rows in the order of ``turn_col``; rows that share a turn come in the order of
    ``formatted``, a null turn first. The loss mask covers the text of assistant turns: characters from ``loss_start`` to
    ``loss_stop`` of the row, null for other roles. Null roles and texts count as empty; repeated rows are turns of their own;
    rows with a null conversation are one conversation; an empty table gives no rows. Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    kinds = [rows.schema[c].dataType.simpleString() for c in ("_conv", "_turn")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column("_role").to_pylist()
            shown = [render(r, t) for r, t in zip(roles, batch.column("_text").to_pylist(), strict=True)]
            learned = [r == "assistant" for r in roles]
            columns = [
                batch.column("_conv"),
                batch.column("_turn"),
                pa.array([s for s, _, _ in shown], pa.string()),
                pa.array([a if m else None for (_, a, _), m in zip(shown, learned, strict=True)], pa.int64()),
                pa.array([b if m else None for (_, _, b), m in zip(shown, learned, strict=True)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_conv", "_turn", "formatted", "loss_start", "loss_stop"])

    schema = f"_conv {kinds[0]}, _turn {kinds[1]}, formatted string, loss_start long, loss_stop long"
    out = rows.mapInArrow(run, schema)
    return out.withColumnsRenamed({"_conv": conv_col, "_turn": turn_col})


class _Reader:
    """What a conversation says, gathered turn by turn: digests and counts, never its texts."""

    def __init__(self, conv: object):
        self.conv, self.n_turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, shown: str, start: int | None, stop: int | None) -> None:
        for role, text, _, _ in parse(shown):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        if start is not None:
            learned = unescape(shown[start:stop])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(shown)

    def row(self) -> tuple:
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Per conversation what its formatted rows say: (``conv_col``, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    ``turns_sha256`` covers role, newline, text, newline of every turn, ``loss_sha256`` the text under the loss mask, unescaped, with
    nothing between. A digest is made of a conversation's bytes in order, so its rows pass through one task, sorted by Spark; the
    task holds the state of two digests and one batch, however long the conversation. No rows give no rows.
    """
    kind = formatted.schema[conv_col].dataType.simpleString()
    rows = formatted.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), "formatted", "loss_start", "loss_stop"
    )
    ordered = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "formatted")
    names = ["_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Reader | None = None
        for batch in batches:
            kinds = [batch.schema.field("_conv").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            done = []
            columns = [batch.column(c).to_pylist() for c in ("_conv", "formatted", "loss_start", "loss_stop")]
            for conv, shown, start, stop in zip(*columns, strict=True):
                if now is None or now.conv != conv:
                    done += [now.row()] if now else []
                    now = _Reader(conv)
                now.read(shown, start, stop)
            if done:
                yield _batch(done, names, kinds)
        if now:
            yield _batch([now.row()], names, kinds)

    schema = f"_conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(run, schema).withColumnRenamed("_conv", conv_col)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)
