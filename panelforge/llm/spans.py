"""Spans of regular-expression matches as native column expressions.

``regexp_replace`` puts a mark on both sides of every leftmost non-overlapping
match, ``split`` cuts the text there, and one fold over the parts adds up
where each match starts and ends (in code points).  The mark is a code point
that no text may use (a Unicode noncharacter); texts that hold it all the same
have it replaced by U+FFFD first, which moves nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, INSTEAD = "﷐", "�"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def plain(text: Column) -> Column:
    """The text (null: empty) without marks."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, INSTEAD)).otherwise(text)


def parts(text: Column, regex: str) -> Column:
    """What is outside and inside the matches, alternating."""
    return F.split(F.regexp_replace(text, F.lit(regex), F.lit(f"{MARK}$0{MARK}")), MARK, -1)


def starts(text: Column, regex: str) -> Column:
    """Like ``parts`` with a match of ``regex`` (one group around it) wherever one
    starts, overlapping ones too: the matches are copies, the text outside is whole."""
    return F.split(F.regexp_replace(text, F.lit(f"(?={regex})"), F.lit(f"{MARK}$1{MARK}")), MARK, -1)


def spans(cut: Column, kind: str, rank: int, valid: Callable[[Column], Column] | None = None,
          score: Callable[[Column, Column], Column] | None = None, at_least: float = 0.0, near: int = 0, copies: bool = False) -> Column:
    """Spans of the valid matches in ``parts`` (``copies``: in ``starts``).  ``valid``
    sees the match, ``score`` the match and the ``near`` characters before it,
    with what matched there."""
    none = F.lit(None).cast(SPAN)
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).alias("pos"), F.lit("").alias("before"), F.coalesce(none, F.array().cast(SPAN)).alias("out"))

    def step(acc: Column, part: Column) -> Column:
        pos, end = acc["pos"], acc["pos"] + F.char_length(part)
        seen = F.right(F.concat(acc["before"], part), F.lit(near)) if near else acc["before"]
        points = score(part, acc["before"]) if score else F.lit(1.0)
        span = F.struct(pos.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), points.alias("score"))
        found = F.filter(F.array(span), lambda s: s["score"] >= at_least)
        good = acc["inside"] & valid(part) if valid else acc["inside"]
        if copies:
            end, seen = F.when(acc["inside"], pos).otherwise(end), F.when(acc["inside"], acc["before"]).otherwise(seen)
        return F.struct((~acc["inside"]).alias("inside"), end.alias("pos"), seen.alias("before"),
                        F.when(good, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(cut, start, step, lambda acc: acc["out"])


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)


def count(found: Column, kind: str) -> Column:
    return F.size(of_kind(found, kind)).cast("long")


def masked(text: Column, found: Column) -> Column:
    """The text with each span (sorted by start) replaced by its [KIND];
    overlapping spans become the first one's."""

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["pos"]
        more = F.concat(acc["out"], F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(new, more).otherwise(acc["out"]).alias("out"))

    return F.aggregate(found, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substr(text, acc["pos"] + 1, F.char_length(text))))
