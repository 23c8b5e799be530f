"""Pattern matches with positions, from DataFrame functions alone.

``matches`` pairs each match of a pattern with the text between it and the
match before; the running length of both gives the positions, and the last two
words up to each match are carried to the next. Positions are code points, the
end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<s:int,e:int,v:string,ctx:string>"
# the last two words before a match
BEFORE = r"(?<!\S)(\S++\s++\S++)[\s\x22'(]*+\z"
# the same where the second is no mere quote, so that no earlier pair can count
NEAR = r"\s(\S++\s++(?![\s\x22'(]*+\z)\S++)[\s\x22'(]*+\z"
# the last two words of a text that ends in a match, or the only one
ENDS = r"(?<!\S)(?:\S++\s++)?\S++\z"


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _near_end(text: Column, near: str, whole: str, group: int) -> Column:
    """What ``whole`` finds at the end of ``text``: in its last 80 characters if ``near`` does, else in all of it."""
    found = F.regexp_extract(F.substring(text, -80, 80), near, group)
    return F.when(found != "", found).otherwise(F.regexp_extract(text, whole, group))


def _words_before(text: Column) -> Column:
    return F.regexp_replace(F.lower(_near_end(text, NEAR, BEFORE, 1)), r"\s+", " ")


def _last_two(text: Column) -> Column:
    return _near_end(text, r"(?<=\s)\S++\s++\S++\z", ENDS, 0)


def matches(text: Column, pattern: str, where: Column | None = None, context: bool = False) -> Column:
    """Leftmost non-overlapping matches ``array<s, e, v, ctx>`` of ``pattern`` in ``text``.

    ``where`` is a cheap necessary condition on the row; other rows skip the
    scan. ``ctx``, filled only on ``context``, holds the two words of the text
    before the match, in lower case, or nothing if there are fewer.
    """
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda pre, v: F.struct(pre.alias("pre"), v.alias("v")))

    def add(acc, x):
        start = acc["at"] + F.length(x["pre"])
        end = start + F.coalesce(F.length(x["v"]), F.lit(0))
        before = F.concat(acc["tail"], x["pre"])
        ctx = _words_before(before) if context else F.lit("")
        # two words are all that a later match can see of this one and the text before it
        tail = F.when(x["v"].isNull(), "").otherwise(_last_two(F.concat(before, x["v"]))) if context else F.lit("")
        found = F.array(F.struct(start.alias("s"), end.alias("e"), x["v"].alias("v"), ctx.alias("ctx")))
        return F.struct(end.alias("at"), tail.alias("tail"), F.when(x["v"].isNull(), acc["out"])
                        .otherwise(F.concat(acc["out"], found.cast(f"array<{SPAN}>"))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), none().alias("out"))
    found = F.aggregate(parts, start, add, lambda acc: acc["out"])
    return found if where is None else F.when(where, found).otherwise(none())


def named(found: Column, kind: str, rank: int) -> Column:
    """Matches as ``array<s, rank, e, kind>``."""
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"),
                                                 F.lit(kind).alias("kind")))


def listed(found: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
