"""Positions of regex matches with Spark functions alone.

Spark returns the matches of a regex and the pieces between them, but not their places. A match starts after the pieces and
matches before it, so one pass over both arrays gives all spans. The pass goes by blocks of matches, whose lengths are then
summed up, so a text with very many matches takes time in proportion. Positions count code points; the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters before and after a match that a span keeps as its context.
CONTEXT = 24
#: Matches whose places are found together.
BLOCK = 256

SPAN = "struct<start:int,stop:int,value:string,before:string,after:string>"


def spans(text: Column, regex: str, passes: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,stop,value,before,after>>.

    ``passes`` (of the value) drops failing matches; their text isn't tried again. ``regex`` must not match the empty string. It
    should be written with possessive quantifiers and look-behinds, so that long texts take time in proportion.
    """
    pieces = F.split(text, regex, -1)
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    pairs = F.arrays_zip(pieces.alias("piece"), found.alias("value"), F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))).alias("next"))
    empty = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        piece, value = F.coalesce(x["piece"], F.lit("")), x["value"]
        begin = acc["at"] + F.length(piece)
        stop = begin + F.coalesce(F.length(value), F.lit(0))
        span = F.struct(begin.alias("start"), stop.alias("stop"), value.alias("value"),
                        F.right(piece, F.lit(CONTEXT)).alias("before"), F.left(F.coalesce(x["next"], F.lit("")), F.lit(CONTEXT)).alias("after"))
        good = value.isNotNull() & (passes(value) if passes else F.lit(True))
        return F.struct(stop.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def placed(block: Column) -> Column:
        """Places in a block, counted from its start, and its length."""
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)

    def shifted(block: Column, by: Column) -> Column:
        return F.transform(block["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["stop"] + by).alias("stop"),
                                                            *[s[c].alias(c) for c in ("value", "before", "after")]))

    def joined(all_: Column) -> Column:
        # where each block starts: few enough to be summed up one by one
        sums = F.aggregate(all_, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))
        return F.flatten(F.zip_with(all_, sums["out"], shifted))

    def blocks(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(p), F.lit(BLOCK)), lambda i: placed(F.slice(p, i, F.lit(BLOCK))))

    several = _bound(pairs, lambda p: _bound(blocks(p), joined))
    return F.when(F.size(found) > BLOCK, several).when(F.size(found) > 0, placed(pairs)["out"]).otherwise(empty)


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]
