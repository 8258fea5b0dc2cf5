"""Joins of ranges as relations: which overlap, and which are nearest. Ranges are half-open; neither join compares all
pairs, and neither brings the rows of one key together in a task.

Overlaps: the line is cut into bins of 8, 64, 512 .. positions. A range is of the first level whose bins are as long as
it, so it lies in two bins at most. A pair meets in the bins of the longer one's level, where the shorter one
is listed, too: an equality join on level and bin. A row is listed twice for each level at most, however long ranges
are, and a bin that many rows share is a join key that Spark can split. A pair that meets in two bins is kept in that of
its later start.

Nearest: an as-of lookup. Distinct positions and regions go into one sorted sequence for each key and bin, in which the
last region end (the next region start) is carried along; what comes from earlier (later) bins is carried over one row
for each bin that has regions. Rows come back by an equality join, so a position that many rows share is looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A level's bins are 2 ** (3 * level) long.
BITS, LEVELS = 3, 11


def _level(start: Column, end: Column) -> Column:
    """The first level whose bins aren't shorter than the range."""
    size = F.greatest(end - start, F.lit(1))
    # positions of the highest bit of size - 1, rounded up to whole levels
    bits = F.when(size == 1, 0).otherwise(F.length(F.bin(size - 1)))
    return F.least(F.ceil(bits / BITS), F.lit(LEVELS - 1)).cast("int")


def _bin(position: Column, level: Column) -> Column:
    return F.call_function("shiftright", position, level * BITS)


def _listed(df: DataFrame, start: str, end: str, levels: list[int]) -> DataFrame:
    """Rows with own (their level), level and bin: those of their level and of all longer ones that occur."""
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    rows = df.filter(s < e).withColumn("own__", _level(s, e))
    at = F.filter(F.array(*map(F.lit, levels)), lambda k: k >= F.col("own__"))
    rows = rows.withColumn("level__", F.explode(at))
    first, last = _bin(s, F.col("level__")), _bin(e - 1, F.col("level__"))
    return rows.withColumn("bin__", F.explode(F.sequence(first, last)))


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal ``on`` whose ranges share a position; all columns of both. Other names must differ.

    Rows with a null or empty range, or a null key, are in no pair. Repeated rows pair as often as they stand. Ranges
    of a quarter of a long or more aren't meant.
    """
    (a, b), (c, d) = left_range, right_range
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    # which levels occur: a few small numbers
    seen = [df.select(_level(F.col(s).cast("long"), F.col(e).cast("long")).alias("k")).distinct() for df, s, e in ((left, a, b), (right, c, d))]
    levels = sorted(r["k"] for r in seen[0].union(seen[1]).distinct().collect() if r["k"] is not None)
    ours = _listed(left, a, b, levels)
    theirs = _listed(right, c, d, levels).withColumnRenamed("own__", "other__")
    pairs = ours.join(theirs, [*on, "level__", "bin__"])
    meets = (F.col("level__") == F.greatest("own__", "other__")) & (F.col(a) < F.col(d)) & (F.col(c) < F.col(b))
    in_bin = F.col("bin__") == _bin(F.greatest(F.col(a).cast("long"), F.col(c).cast("long")), F.col("level__"))
    return pairs.filter(meets & in_bin).drop("own__", "other__", "level__", "bin__")


def _asof(places: DataFrame, marks: DataFrame, on: list[str], width: int, forward: bool, name: str) -> DataFrame:
    """places (on, at) with the greatest mark at or before ``at``, or, forward, the least at or after it."""
    block = F.floor(F.col("at") / width).alias("block__")
    best = F.min if forward else F.max
    both = places.select(*on, "at", F.lit(1).alias("mine__")).unionByName(marks.select(*on, F.col("mark").alias("at"), F.lit(0).alias("mine__")).distinct())
    both = both.select("*", block)
    of_block = both.filter("mine__ = 0").groupBy(*on, "block__").agg(best("at").alias("known__"))
    # blocks of a key in order, those without a mark take what the last (next) one knows
    blocks = both.select(*on, "block__").distinct().join(of_block, [*on, "block__"], "left")
    along = Window.partitionBy(*on).orderBy(F.desc("block__") if forward else F.asc("block__")).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*on, "block__", F.last("known__", ignorenulls=True).over(along).alias("carried__"))
    order = [F.desc("at") if forward else F.asc("at"), F.asc("mine__")]  # a mark at a place counts
    within = Window.partitionBy(*on, "block__").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = F.last(F.when(F.col("mine__") == 0, F.col("at")), ignorenulls=True).over(within)
    found = both.withColumn("near__", near).filter("mine__ = 1").join(carried, [*on, "block__"])
    return found.select(*on, "at", F.coalesce("near__", "carried__").alias(name))


def nearest_regions(rows: DataFrame, regions: DataFrame, on: list[str], row_range: tuple[str, str], region_range: tuple[str, str], width: int = 1 << 16) -> DataFrame:
    """``rows`` with left_end, the end of the nearest region that ends at or before their start, and right_start, the
    start of the nearest one that begins at or after their end; null where there is none. Regions may overlap.

    ``width`` is the length of a bin; it doesn't change the result. Rows with a null key or range stay, with nulls;
    such regions count for nothing.
    """
    (a, b), (c, d) = row_range, region_range
    known = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    starts = known.select(*on, F.col(a).cast("long").alias("at")).distinct()
    ends = known.select(*on, F.col(b).cast("long").alias("at")).distinct()
    left = _asof(starts, regions.select(*on, F.col(d).cast("long").alias("mark")).filter("mark IS NOT NULL"), on, width, False, "left_end")
    right = _asof(ends, regions.select(*on, F.col(c).cast("long").alias("mark")).filter("mark IS NOT NULL"), on, width, True, "right_start")
    whole = F.col(a).isNotNull() & F.col(b).isNotNull()
    out = rows.withColumns({"from__": F.when(whole, F.col(a).cast("long")), "to__": F.when(whole, F.col(b).cast("long"))})
    out = out.join(left.withColumnRenamed("at", "from__"), [*on, "from__"], "left").join(right.withColumnRenamed("at", "to__"), [*on, "to__"], "left")
    return out.select(*rows.columns, "left_end", "right_start")
