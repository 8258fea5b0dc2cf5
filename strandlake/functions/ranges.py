"""Range algebra on pairs of columns; a range is half-open."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Range(NamedTuple):
    start: Column
    end: Column

    def moved(self, n: Column | int) -> Range:
        return Range(self.start + n, self.end + n)

    def trimmed_to(self, part: Range) -> tuple[Column, Column]:
        """How much a part leaves out on the left and on the right."""
        return part.start - self.start, self.end - part.end

    def shrunk(self, left: Column | int, right: Column | int) -> Range:
        return Range(self.start + left, self.end - right)

    def size(self) -> Column:
        return self.end - self.start

    def overlaps(self, other: Range) -> Column:
        return (self.end > other.start) & (other.end > self.start)

    def contains_point(self, right: Column) -> Column:
        """Whether an insertion point is strictly inside."""
        return (self.start < right) & (right < self.end)

    def intersect(self, other: Range) -> Range:
        """Both null where nothing is shared."""
        s, e = F.greatest(self.start, other.start), F.least(self.end, other.end)
        return Range(F.when(s < e, s), F.when(s < e, e))

    def intersect_ordered(self, following: Range) -> Range:
        some = following.start < self.end
        return Range(F.when(some, following.start), F.when(some, self.end))

    def is_superset_of(self, other: Range) -> Column:
        return (self.start <= other.start) & (other.end <= self.end)

    def strict_cmp(self, other: Range) -> Column:
        """-1 before, 1 after, 0 equal; null where they overlap otherwise."""
        equal = (self.start == other.start) & (self.end == other.end)
        return F.when(equal, 0).when(self.end <= other.start, -1).when(other.end <= self.start, 1)

    def relaxed_cmp(self, other: Range) -> Column:
        """By both ends; null where one lies strictly within the other."""
        s, e = F.signum(self.start - other.start).cast("int"), F.signum(self.end - other.end).cast("int")
        return F.when(s == e, s).when(s == 0, e).when(e == 0, s)

    def cmp_point(self, right: Column) -> Column:
        """1 where the range lies after the insertion point, -1 before; null around it."""
        return F.when(right <= self.start, 1).when(self.end <= right, -1)


def point_in_codons(right: Column) -> tuple[Column, Column]:
    """Amino acid position and codon shift of an insertion point."""
    return F.floor(right / 3).cast("int"), (right % 3).cast("int")
