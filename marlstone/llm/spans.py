"""Positions of pattern matches, as Column expressions without any UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"
CONTEXT = 48  # characters of text kept on either side of a match


def matches(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches in order: start and end in code points, and the value.

    split() and regexp_extract_all() walk the same matches, so the pieces
    between them and the values interleave to the whole text.
    """
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(pieces, 1, F.size(values)), values,
        lambda piece, value: F.struct(piece.alias("piece"), value.alias("value")))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.char_length(s["piece"])
        end = start + F.char_length(s["value"])
        span = F.struct(
            start.alias("start"), end.alias("end"), s["value"].alias("value"), F.lit("").alias("before"),
            F.lit("").alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), no_matches().alias("spans")), step)["spans"]


def match_parts(text: Column, pattern: Column | str) -> tuple[Column, Column]:
    """(values, pieces) of a pattern's matches, to be stored: each walks the text once.

    A piece, what stands between two matches, is only its length and its two ends.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.struct(
        F.char_length(p).alias("n"), F.left(p, F.lit(CONTEXT)).alias("left"), F.right(p, F.lit(CONTEXT)).alias("right")))
    return F.regexp_extract_all(text, pattern, F.lit(0)), pieces


def spans_of(values: Column, pieces: Column) -> Column:
    """The matches with their places and the text around them, from their stored parts."""
    between = F.zip_with(
        F.slice(pieces, 2, F.size(values)), F.slice(values, 2, F.size(values)),
        lambda piece, value: F.struct(piece["left"].alias("left"), F.coalesce(value, F.lit("")).alias("value")))

    def back(acc: Column, s: Column) -> Column:
        after = F.left(F.concat(s["left"], s["value"], acc["next"]), F.lit(CONTEXT))
        # a piece whose end is not in its left part is longer than what is kept
        after = F.when(F.char_length(s["left"]) < CONTEXT, after).otherwise(s["left"])
        return F.struct(after.alias("next"), F.concat(acc["all"], F.array(after)).alias("all"))

    none = F.struct(F.lit("").alias("next"), F.array().cast("array<string>").alias("all"))
    following = F.reverse(F.aggregate(F.reverse(between), none, back)["all"])
    steps = F.arrays_zip(
        F.slice(pieces, 1, F.size(values)).alias("piece"), values.alias("value"), following.alias("after"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["piece"]["n"]
        end = start + F.char_length(s["value"])
        before = F.right(F.concat(acc["last"], s["piece"]["right"]), F.lit(CONTEXT))
        span = F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value"), before.alias("before"),
                        s["after"].alias("after"))
        last = F.right(F.concat(before, s["value"]), F.lit(CONTEXT))
        return F.struct(end.alias("at"), last.alias("last"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("last"), no_matches().alias("spans"))
    return F.aggregate(steps, start, step)["spans"]


def no_matches() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text in joins."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
