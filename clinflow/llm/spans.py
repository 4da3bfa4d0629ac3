"""Spans of regular expressions as column expressions: code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,stop:bigint,rank:int,kind:string,value:string>"


def find(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """Array of the leftmost non-overlapping matches with the value of ``group``.

    The pieces between the matches give the places: match i starts after pieces 0..i and matches
    0..i-1. Their running sums are taken in parts of about the square root of their number, first over the
    parts and then in each, so that many matches do not cost their square. Texts without a match are
    not cut at all.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    pieces = F.arrays_zip(
        F.transform(found, F.char_length).alias("n"), values.alias("value"),
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
    empty = F.expr(f"cast(array() as array<{SPAN}>)")

    def within(part: Column, at: Column) -> Column:
        return F.aggregate(
            part, F.struct(at.alias("at"), empty.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + p["n"]).alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + p["n"]).alias("stop"),
                    F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                    p["value"].alias("value")))).cast(f"array<{SPAN}>").alias("out"))
        )["out"]

    def joined(parts: Column) -> Column:
        lengths = F.transform(parts, lambda part: F.aggregate(
            part, F.lit(0).cast("bigint"), lambda a, p: a + p["gap"] + p["n"]))
        starts = F.aggregate(
            lengths, F.array(F.lit(0).cast("bigint")),
            lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
        return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), within))

    def cut(whole: Column) -> Column:
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(whole))).cast("int"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(whole), F.lit(1)), step)
        return F.transform(firsts, lambda first: F.slice(whole, first, step))

    return F.when(text.rlike(pattern), _once(_once(pieces, cut), joined)).otherwise(empty)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"),
        s["kind"].alias("kind"))))
    return F.array_join(F.transform(
        ordered,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))),
        ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
