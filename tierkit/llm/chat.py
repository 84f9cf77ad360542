"""Chat formatting: a template as a black box, located turn by turn.

The template is any function from a list of (role, text) turns to a string.
Successive prefixes of a conversation are rendered and consecutive outputs
compared: what the longer output adds is the new turn's span, and an output
that does not begin with the one before shows a template that rewrites its
history.  Inside a span the text is found by rendering the turn with two
probe texts, which share exactly what the template puts before and after.
"""

from __future__ import annotations

import os.path
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.operators._names import q

Turn = tuple[str, str]

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Earlier turns rendered with a turn; ``None`` is all of them, the whole prefix.
CONTEXT = None


def escape(text: str) -> str:
    """No control string can appear in the result; :func:`unescape` undoes it."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def marked(turns: list[Turn]) -> str:
    """The template: a start mark, role and line end, the text, an end mark."""
    return "".join(f"{START}{_escape_role(r)}\n{escape(t)}{END}\n" for r, t in turns)


_TURN = re.compile(f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of :func:`marked`."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a formatted conversation at character {at}")
        turns.append((_unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


class Span(NamedTuple):
    role: str
    start: int
    end: int
    text_start: int
    text_end: int


class Located(NamedTuple):
    formatted: str
    spans: list[Span] | None  # None if the template rewrites history
    rewritten_at: int | None  # first turn that changed what was before


def locate(turns: list[Turn], render: Callable[[list[Turn]], str], context: int | None = None) -> Located:
    """Spans of every turn in ``render(turns)``.

    With ``context`` None every prefix is rendered whole, which costs the
    square of the conversation.  With a number, only that many earlier turns
    go along, and the pieces count only if together they equal one rendering
    of the whole; else every prefix is rendered after all.
    """
    whole = render(turns)
    spans, at = [], 0
    for i, (role, text) in enumerate(turns):
        past = turns[:i] if context is None else turns[max(0, i - context) : i]
        before, after = render(past), render([*past, (role, text)])
        probes = [render([*past, (role, x)]) for x in "ab"]
        if not all(x.startswith(before) for x in (after, *probes)):
            if context is not None:
                return locate(turns, render)
            return Located(whole, None, i)
        delta, one, two = (x[len(before) :] for x in (after, *probes))
        head = len(os.path.commonprefix([one, two]))
        tail = len(os.path.commonprefix([one[head:][::-1], two[head:][::-1]]))
        spans.append(Span(role, at, at + len(delta), at + head, at + len(delta) - tail))
        if context is not None and whole[at : at + len(delta)] != delta:
            return locate(turns, render)
        at += len(delta)
    if at != len(whole):
        return locate(turns, render) if context is not None else Located(whole, None, len(turns))
    return Located(whole, spans, None)


_SPANS = "array<struct<role string, start long, end long, text_start long, text_end long>>"
FORMATTED = f"conv_id long, formatted string, spans {_SPANS}, rewritten_at long"


def _formatter(render: Callable[[list[Turn]], str], context: int | None):
    kind = pa.list_(pa.struct([("role", pa.string()), *[(n, pa.int64()) for n in Span._fields[1:]]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                locate([(t["role"] or "", t["text"] or "") for t in turns], render, context)
                for turns in (x.as_py() for x in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.formatted for x in found], pa.string()),
                    pa.array([None if x.spans is None else [s._asdict() for s in x.spans] for x in found], kind),
                    pa.array([x.rewritten_at for x in found], pa.int64()),
                ],
                names=["conv_id", "formatted", "spans", "rewritten_at"],
            )

    return run


def format_chats(
    conversations: DataFrame,
    render: Callable[[list[Turn]], str] = marked,
    context: int | None = CONTEXT,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``spans`` (code
    point ranges of each turn and of its text) and ``rewritten_at`` (the first
    turn whose rendering changed the text before it, else null; spans are null
    then, since no loss mask holds for such a template).

    Turns are ordered by turn number, then role and text, so ties and repeated
    rows have one order; a null number comes first.  Null role or text counts
    as empty.  Rows with a null conversation id form one conversation.  Other
    columns are ignored.  A conversation is one output row, so its turns meet
    in one task; nothing else does.
    """
    turns = conversations.select(
        q(conv_col).cast("long").alias("conv_id"),
        F.struct(
            q(turn_col).cast("long").alias("turn"),
            F.coalesce(q(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return whole.mapInArrow(_formatter(render, context), FORMATTED)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        turns, masked = [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns.append([{"role": r, "text": t} for r, t in read_back(text)])
            masked.append(
                None
                if spans is None
                else "".join(unescape(text[s["text_start"] : s["text_end"]]) for s in spans if s["role"] == "assistant")
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(turns, kind), pa.array(masked, pa.string())],
            names=["conv_id", "formatted", "turns", "loss_text"],
        )


def read_chats(formatted: DataFrame) -> DataFrame:
    """Read :func:`format_chats` rows of the :func:`marked` template back:
    ``conv_id``, ``formatted``, ``turns`` (role, text) and ``loss_text``, the
    unescaped text under the loss mask (the texts of assistant turns)."""
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        _reader, "conv_id long, formatted string, turns array<struct<role string, text string>>, loss_text string"
    )


def turns_digest(turns: Column) -> Column:
    """Hex SHA-256 of role, line end, text, line end of each turn."""
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
