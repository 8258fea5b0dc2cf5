"""Rules on the ends of an alignment, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandlake.functions.iupac import is_stop, last_codon, next_stop


def chew_offset(nt: Column, ref_len: Column, on: Column) -> Column:
    """Bases before the first ATG, if the query is longer than the reference and stays at least as long."""
    at = F.instr(nt, "ATG") - 1
    return F.when(on & (F.length(nt) > ref_len) & (at >= 0) & (F.length(nt) - at >= ref_len), at).otherwise(F.lit(0))


def repaired(q_start: Column, q_end: Column, r_start: Column, r_end: Column, q_len: Column, r_len: Column, limit: Column) -> dict[str, Column]:
    """Ends that stop short of the reference by ``limit`` bases at most are extended by what both sides have."""
    left = F.when((limit > 0) & (r_start <= limit), F.least(q_start, r_start)).otherwise(F.lit(0))
    right = F.when((limit > 0) & (r_len - r_end <= limit), F.least(q_len - q_end, r_len - r_end)).otherwise(F.lit(0))
    return {"left": left, "right": right, "q_start": q_start - left, "q_end": q_end + right, "r_start": r_start - left, "r_end": r_end + right}


def stop_extension(nt: Column, q_start: Column, q_end: Column, r_end: Column, r_len: Column, on: Column) -> Column:
    """End of the query range of an insertion that brings a stop codon in after the end of the reference; else null."""
    tail = F.substr(nt, q_end + 1)
    last = last_codon(F.substr(nt, q_start + 1, q_end - q_start))
    due = on & (r_end == r_len) & (F.length(nt) - q_end >= 3) & ~F.coalesce(is_stop(last), F.lit(False))
    return F.when(due, q_end + next_stop(tail) + 3)
