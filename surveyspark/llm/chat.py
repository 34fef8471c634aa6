"""Chat formatting in budgeted windows.

A conversation's turns are laid out in windows that each fit a token budget. Prefix sums
of the turns' tokens choose the spans, which begin and end at turns: every turn is new in
exactly one window. The system turn at the start of a conversation is repeated in all of
its windows, as are the last turns before the span up to a limit. The loss mask covers
the assistant's texts that are new in the window; repeated ones are masked out.

A turn is `### role: text</turn>` and a line end. Inside texts and roles, `\\`, `### ` and
`</turn>` (and `: ` in roles) get a backslash before them, so that reading back is exact.
Conversations are streamed in turn order: a task holds one window and its history, however
long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_IN_TEXT = re.compile(r"\\|### |</turn>")
_IN_ROLE = re.compile(r"\\|### |</turn>|: ")
_CONTROL = re.compile(r"\\(\\|### |</turn>|: )|(### |</turn>\n|: )")
SYSTEM, TARGET = "system", "assistant"


@dataclass(frozen=True)
class Budget:
    window: int = 1024   # tokens of a window
    history: int = 256   # tokens of repeated turns in it


@dataclass
class Turn:
    role: str
    text: str
    head: str = field(init=False)
    body: str = field(init=False)
    tokens: int = field(init=False)

    def __post_init__(self):
        self.head = OPEN + _IN_ROLE.sub(r"\\\g<0>", self.role) + MIDDLE
        self.body = _IN_TEXT.sub(r"\\\g<0>", self.text)
        self.tokens = len(self.head.split()) + len(self.body.split()) + 1


@dataclass
class Window:
    text: str
    new_at: int                     # where the window's own turns begin
    spans: list[tuple[int, int]]    # the loss mask, in code points


def lay_out(system: Turn | None, history: list[Turn], own: list[Turn], first: bool) -> Window:
    parts, at, spans = [], 0, []
    new_at = 0
    for k, turn in enumerate([system, *history, *own] if system else [*history, *own]):
        if k == len(history) + (system is not None and not first):
            new_at = at
        fresh = k >= len(history) + (system is not None)
        if fresh and turn.role == TARGET:
            spans.append((at + len(turn.head), at + len(turn.head) + len(turn.body)))
        piece = turn.head + turn.body + CLOSE
        parts.append(piece)
        at += len(piece)
    return Window("".join(parts), 0 if first else new_at, spans)


def windows(turns: Iterator[Turn], budget: Budget) -> Iterator[Window]:
    """Windows of one conversation; only the turns from the history on are held."""
    system, held, sums, start, first = None, [], [0], 0, True
    for k, turn in enumerate(turns):
        if k == 0 and turn.role == SYSTEM:
            system = turn
            continue
        held.append(turn)
        sums.append(sums[-1] + turn.tokens)
        while True:
            back = bisect_left(sums, sums[start] - budget.history)
            room = budget.window - (system.tokens if system else 0) - (sums[start] - sums[back])
            stop = max(bisect_right(sums, sums[start] + room) - 1, start + 1)
            if stop >= len(held):
                break  # the next turn may still fit
            yield lay_out(system, held[back:start], held[start:stop], first)
            first, start = False, stop
            drop = bisect_left(sums, sums[start] - budget.history)
            base = sums[drop]
            held, sums, start = held[drop:], [s - base for s in sums[drop:]], start - drop
    if start < len(held) or (first and system):
        back = bisect_left(sums, sums[start] - budget.history)
        yield lay_out(system, held[back:start], held[start:], first)


def read_turns(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Role and text of each turn of a formatted string, and where its text lies in it."""
    state, role, begin, out = "open", "", 0, []
    at = 0
    for m in _CONTROL.finditer(text):
        if m.start() < at:
            continue
        sign = m[2]
        if sign is None:                     # an escaped one
            out.append(text[at:m.start()] + m[1])
        elif state == "open" and sign == OPEN:
            state, out = "role", []
        elif state == "role" and sign == MIDDLE:
            role, state, begin = "".join(out) + text[at:m.start()], "text", m.end()
            out = []
        elif state == "text" and sign == CLOSE:
            yield role, "".join(out) + text[at:m.start()], begin, m.start()
            state, out = "open", []
        else:                                # ordinary here
            out.append(text[at:m.end()])
        at = m.end()


def _unescape(text: str) -> str:
    return re.sub(r"\\(\\|### |</turn>)", r"\1", text)


def format_conversations(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """conv_id, window, text, new_at, mask (start, end) of all windows.

    Needs conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn
    (nulls first), then role and text; null roles and texts count as empty, rows without
    a conv_id form one conversation. A turn is never cut: one that exceeds the budget has
    a window of its own. An empty table gives no window.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def turns(batches):
        for batch in batches:
            yield from zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(),
                           batch.column("text").to_pylist())

    def write(batches):
        out: list[tuple] = []
        for conv, own in _grouped(turns(batches)):
            for k, w in enumerate(windows((Turn(role, text) for _, role, text in own), budget)):
                out.append((conv, k, w.text, w.new_at, [{"start": a, "end": b} for a, b in w.spans]))
                if len(out) >= 512:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    def pack(out):
        conv, k, text, new_at, mask = zip(*out)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, id_type), pa.array(k, pa.int64()), pa.array(text, pa.string()),
             pa.array(new_at, pa.int64()), pa.array(mask, span)], ["conv_id", "window", "text", "new_at", "mask"])

    id_type = to_arrow_type(conversations.schema["conv_id"].dataType)
    return rows.mapInArrow(write, f"conv_id {kind}, window long, text string, new_at long, "
                                  "mask array<struct<start:int,end:int>>")


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Runs of rows with the same first value, each as an iterator (a null is a value)."""
    return groupby(rows, key=lambda r: r[0])


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Everything is parsed from the formatted windows of format_conversations, whose order
    within a partition it relies on: turns from the part of a window that is new, the
    loss text from the mask.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    id_type = to_arrow_type(formatted.schema["conv_id"].dataType)

    def flat(batches):
        for batch in batches:
            columns = ("conv_id", "text", "new_at", "mask")
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def read(batches):
        out = []
        for conv, own in _grouped(flat(batches)):
            turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, new_at, mask in own:
                chars += len(text)
                for role, said, _, _ in read_turns(text[new_at:]):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in mask:
                    target = _unescape(text[span["start"]:span["end"]])
                    loss.update(target.encode())
                    loss_chars += len(target)
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 4096:
                yield pack(out)
                out = []
        if out:
            yield pack(out)

    def pack(out):
        kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return formatted.mapInArrow(read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
