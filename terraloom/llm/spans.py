"""Regular-expression spans with code-point positions, in DataFrame functions only.

Every step is linear in the text: a value that a lambda needs again and again is bound once (``let``), arrays
grow in blocks, and overlaps are looked up by cells of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A noncharacter that marks matches; in texts it stands in for nothing, so U+FFFD takes its place.
MARK, OTHER = "﷐", "�"
SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string,text:string,before:string>"
#: Code points of text kept before a match; parts of a split text walked at once (even); code points of a cell.
CONTEXT, BLOCK, CELL = 24, 512, 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once: an expression inside a lambda is evaluated at each step, a variable is not."""
    return F.transform(F.array(value), body)[0]


def no_spans() -> Column:
    return F.from_json(F.lit("[]"), f"array<{SPAN}>")


def find_spans(text: Column, pattern: str, kind: str, rank: int, keep: Callable[[Column], Column]) -> Column:
    """Array of SPANs of the leftmost non-overlapping matches whose text passes ``keep``; no retries.

    Matches are put between marks and the text is split there: odd parts are matches, and running lengths
    give the positions. The length of the text never changes, so positions are those of the original.
    ``before`` is the end of the text between the former match and this one. Patterns should repeat groups
    possessively: Java's regex recurses otherwise."""

    def state(pos: Column, hit: Column, before: Column, out: Column) -> Column:
        return F.struct(pos.alias("pos"), hit.alias("hit"), before.alias("before"), out.alias("out"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["pos"] + F.length(part)
        span = F.struct(acc["pos"].alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), part.alias("text"), acc["before"].alias("before"))
        out = F.when(acc["hit"] & keep(part), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return state(end, ~acc["hit"], F.right(part, F.lit(CONTEXT)), out)

    def walk(parts: Column) -> Column:
        def block(acc: Column, i: Column) -> Column:
            inner = F.aggregate(F.slice(parts, i * BLOCK + 1, BLOCK), state(acc["pos"], F.lit(False), acc["before"], no_spans()), step)
            return let(inner, lambda r: state(r["pos"], F.lit(False), r["before"], F.concat(acc["out"], r["out"])))

        start = state(F.lit(0).cast("bigint"), F.lit(False), F.lit(""), no_spans())
        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(parts) / BLOCK).cast("int")), start, block, lambda acc: acc["out"])

    parts = F.split(F.regexp_replace(F.translate(text, MARK, OTHER), pattern, f"{MARK}$0{MARK}"), MARK)
    return F.coalesce(let(parts, lambda p: F.when(F.size(p) > 1, walk(p))), no_spans())


def _cell(pos: Column) -> Column:
    return F.floor(pos / CELL).cast("int")


def with_cells(spans: Column, size: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the spans that touch each cell of a text of ``size`` code points."""
    cells = let(spans, lambda all_: F.transform(F.sequence(F.lit(0), _cell(size)), lambda k: F.filter(all_, lambda s: (s["start"] < (k + 1) * CELL) & (s["end"] > k * CELL))))
    return let(cells, body)


def touches(cells: Column, s: Column) -> Column:
    """Whether span ``s`` overlaps one of the spans in ``cells``."""
    near = F.slice(cells, _cell(s["start"]) + 1, _cell(s["end"]) - _cell(s["start"]) + 1)
    return F.exists(near, lambda c: F.exists(c, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def digest(spans: Column) -> Column:
    """kind:start:end of the spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
