"""Coordinates as text: 1-based, inclusive, ``s..e`` joined by ``;``, a bare position for an insertion point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGES = "array<struct<start:int,end:int>>"


def written_range(start: Column, end: Column) -> Column:
    return F.concat((start + 1).cast("string"), F.lit(".."), end.cast("string"))


def written(start: Column, end: Column) -> Column:
    """A range, or an insertion point, which has no end."""
    return F.when(end.isNull(), start.cast("string")).otherwise(written_range(start, end))


def format_ranges(ranges: Column) -> Column:
    """array<struct<start, end>>; an insertion point has no end."""
    return F.array_join(F.transform(ranges, lambda r: written(r["start"], r["end"])), ";")


def _parsed(text: Column) -> tuple[Column, Column]:
    """Whether a text is no list of ranges or positions, and what it says."""
    bad = ~F.coalesce(text.rlike(r"^[0-9]{1,9}(\.\.[0-9]{1,9})?(;[0-9]{1,9}(\.\.[0-9]{1,9})?)*$"), F.lit(True))

    def one(x: Column) -> Column:
        ends = F.split(x, r"\.\.")
        first, last = F.element_at(ends, 1).try_cast("int"), F.try_element_at(ends, F.lit(2)).try_cast("int")
        return F.when(last.isNull(), F.struct(first.alias("start"), F.lit(None).cast("int").alias("end"))).otherwise(F.struct((first - 1).alias("start"), last.alias("end")))

    parsed = F.transform(F.split(text, ";"), one)
    wrong = bad | F.exists(parsed, lambda r: r["end"].isNotNull() & ((r["start"] < 0) | (r["end"] <= r["start"])))
    return wrong, parsed.cast(RANGES)


def parse_ranges(text: Column) -> Column:
    """The inverse. A text that is no list of ranges with 1 <= s <= e, or positions, raises an error."""
    wrong, parsed = _parsed(text)
    return F.when(wrong, F.raise_error(F.concat(F.lit("not coordinates: "), text)).cast(RANGES)).otherwise(parsed)


def try_parse_ranges(text: Column) -> Column:
    """As ``parse_ranges``, but null where that is an error."""
    wrong, parsed = _parsed(text)
    return F.when(~wrong, parsed)
