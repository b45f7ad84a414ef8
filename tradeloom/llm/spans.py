"""Pattern matches with their places, in SQL functions only.

Places are code points of the text, the end exclusive. Patterns are Java's, matched from left to right
without overlap. Null texts have no matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,text:string>>"
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def matches(text: Column, pattern: str, keep: Callable[[Column, Column], Column], group: int = 0, hint: Column | None = None) -> Column:
    """The matches of a pattern for which ``keep(match, its group)`` holds: start, end, and the group's text.

    The text between matches gives their places. ``hint`` may name a cheap condition that texts with a
    match meet. Only kept matches are gathered, so numbers of discarded ones cost no memory.
    """
    wholes = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else wholes
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), wholes.alias("whole"), parts.alias("part"))

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["part"].alias("text")))
        kept = F.coalesce(x["whole"].isNotNull() & keep(x["whole"], x["part"]), F.lit(False))
        return F.struct(end.alias("at"), F.when(kept, F.concat(seen["found"], one)).otherwise(seen["found"]).alias("found"))

    none = F.array().cast(FOUND)
    every = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda x: x["found"])
    known = F.size(wholes) > 0
    return F.when(known if hint is None else hint & known, every).otherwise(none)


def as_spans(found: Column, kind: str, rank: int) -> Column:
    """Found matches as spans that sort by start, then by the rank of their kind."""
    return F.transform(found, lambda x: F.struct(x["start"], F.lit(rank).alias("rank"), x["end"], F.lit(kind).alias("kind"))).cast(SPANS)


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda x: (x["start"] < end) & (start < x["end"]))
