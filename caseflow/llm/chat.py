"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  Nothing is
assumed about it: successive prefixes of a conversation are rendered and consecutive
outputs compared.  Where an output begins with the one before, the rest is the new turn's
span; where it does not, the template rewrites history.  Rendering once more with marks in
place of the last turn's role and text shows where these lie inside the span.

So that a conversation of n turns costs n renderings of bounded length, prefixes longer
than ``CONTEXT`` turns are rendered from their last ``CONTEXT`` turns; the spans found are
then checked against one rendering of the whole conversation, and if they do not add up to
it, whole prefixes are rendered.

Rows are grouped and ordered by Spark (by conversation, then turn, role and text) and read
as a stream, so a task holds one conversation at a time; its rendering is one string, which
is the result itself.

Edge cases: null text is empty, a null role is an empty role; equal turns are ordered by
role and text, and repeated rows are turns of their own; rows with a null conversation
form one conversation with a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

CONTEXT = 8
Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
#: What the plain template writes, and its escapes: strings of the template inside a text,
#: and the backslash itself. Each backslash written is followed by one of these letters.
OPEN, SEP, CLOSE = "###", ": ", "</turn>"
ESCAPES = [("\\", "\\s"), (OPEN, "\\m"), (CLOSE, "\\e"), (":", "\\c")]


def escape(text: str) -> str:
    for raw, written in ESCAPES:
        text = text.replace(raw, written)
    return text


def unescape(text: str | Column):
    """The inverse, for strings and for columns."""
    for raw, written in reversed(ESCAPES):
        if isinstance(text, Column):
            text = F.replace(text, F.lit(written), F.lit(raw))
        else:
            text = text.replace(written, raw)
    return text


def plain_template(turns: list[Turn]) -> str:
    return "".join(f"{OPEN} {escape(r)}{SEP}{escape(t)}{CLOSE}\n" for r, t in turns)


class Spans(NamedTuple):
    """A rendering, a row (``_FIELDS``) per turn, and whether any turn rewrote history."""

    formatted: str
    rows: list[tuple]
    rewrites: bool


def _marks(text: str) -> tuple[str, str]:
    """Two strings that the text does not hold."""
    n = 0
    while f"\ue000{n}" in text:
        n += 1
    return f"\ue000{n}\ue001", f"\ue000{n}\ue002"


def _places(now: str, shown: list[Turn], template: Template, marks: tuple[str, str]) -> tuple:
    """Start and end of the last turn's role and text in ``now``; None where marks do not tell."""
    role_mark, text_mark = marks
    earlier, role = shown[:-1], shown[-1][0]
    marked = template([*earlier, marks])
    r, t = marked.find(role_mark), marked.find(text_mark)
    if not 0 <= r < t:
        return None, None, None, None
    between = marked[r + len(role_mark) : t]
    tail = marked[t + len(text_mark) :]
    # with the role itself in place, the text begins where its mark is now
    at = template([*earlier, (role, text_mark)]).find(text_mark)
    end = len(now) - len(tail)
    told = now[:r] == marked[:r] and now[:at].endswith(between) and now.endswith(tail)
    if not (told and r <= at - len(between) and at <= end):
        return None, None, None, None
    return r, at - len(between), at, end


def locate(turns: list[Turn], template: Template, context: int = CONTEXT) -> Spans:
    """Spans of all turns in the rendering of the whole conversation.

    Where the template rewrites history, a turn's places are those in the rendering of the
    prefix it ends, as later ones may have moved or altered it.
    """
    full, head = template(turns), template([])
    marks = _marks(full)
    for size in (context, max(context, len(turns))):
        rows, pieces, offset = [], [head], len(head)
        for k in range(len(turns)):
            shown = turns[max(0, k - size) : k + 1]
            before, now = template(shown[:-1]), template(shown)
            changed = not now.startswith(before)
            start = _common(before, now) if changed else len(before)
            shift = 0 if changed else offset - len(before)
            places = (start, len(now), *_places(now, shown, template, marks))
            rows.append((*[None if p is None else p + shift for p in places], changed))
            pieces.append(now[start:])
            offset += len(now) - len(before)
        rewrites = any(r[-1] for r in rows)
        if size >= len(turns) or (not rewrites and "".join(pieces) == full):
            break
    return Spans(full, rows, rewrites)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


_ROW = "struct<start:int,end:int,role_start:int,role_end:int,text_start:int,text_end:int,rewritten:boolean>"
_FIELDS = ["start", "end", "role_start", "role_end", "text_start", "text_end", "rewritten"]


def format_conversations(
    rows: DataFrame,
    template: Template = plain_template,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    context: int = CONTEXT,
) -> DataFrame:
    """id, formatted, turns (spans in code points, from 0) and rewrites, a row a conversation."""
    blank = F.lit("")
    d = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), blank).alias("text"),
    )
    d = d.repartition(F.col("id")).sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    span = pa.struct([(n, pa.bool_() if n == "rewritten" else pa.int32()) for n in _FIELDS])

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        turns, last, some = [], None, False
        for b in batches:
            for i, role, text in zip(*[b.column(k).to_pylist() for k in range(3)]):
                if some and i != last:
                    yield last, turns
                    turns = []
                last, some = i, True
                turns.append((role, text))
        if some:
            yield last, turns

    def batch(out: list[tuple]) -> pa.RecordBatch:
        ids, made = zip(*out)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([m.formatted for m in made], pa.string()),
                pa.array([[dict(zip(_FIELDS, r)) for r in m.rows] for m in made], pa.list_(span)),
                pa.array([m.rewrites for m in made], pa.bool_()),
            ],
            names=["id", "formatted", "turns", "rewrites"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for i, turns in conversations(batches):
            out.append((i, locate(turns, template, context)))
            held += len(out[-1][1].formatted)
            if held > 4_000_000 or len(out) >= 1000:
                yield batch(out)
                out, held = [], 0
        if out:
            yield batch(out)

    made = d.mapInArrow(run, f"id bigint, formatted string, turns array<{_ROW}>, rewrites boolean")
    return made.withColumnRenamed("id", id_col)


def role_of(turn: Column, formatted: Column) -> Column:
    """The role of a turn, read from the rendering."""
    return unescape(F.substring(formatted, turn["role_start"] + 1, turn["role_end"] - turn["role_start"]))


def text_of(turn: Column, formatted: Column) -> Column:
    """The text of a turn, read from the rendering."""
    return unescape(F.substring(formatted, turn["text_start"] + 1, turn["text_end"] - turn["text_start"]))


def loss_mask(turns: Column, formatted: Column, role: str = "assistant") -> Column:
    """(start, end) of every text by ``role``."""
    mine = F.filter(turns, lambda t: role_of(t, formatted) == role)
    return F.transform(mine, lambda t: F.struct(t["text_start"].alias("start"), t["text_end"].alias("end")))
