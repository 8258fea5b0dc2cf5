"""Measures of insertions and deletions in coding coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandlake.functions.iupac import translate_partial


def insertion_metrics(right: Column, inserted: Column) -> dict[str, Column]:
    return {
        "upstream_aa_pos": F.floor(right / 3).cast("int"),
        "inserted_nt": inserted,
        "inserted_aa": translate_partial(inserted),
        "upstream_nt_pos": right.cast("int"),
        "codon_shift": (right % 3).cast("int"),
    }


def deletion_metrics(start: Column, end: Column) -> dict[str, Column]:
    return {
        "del_aa_start": (F.floor(start / 3) + 1).cast("int"),
        "del_aa_end": F.ceil(end / 3).cast("int"),
        "del_aa_len": F.ceil((end - start) / 3).cast("int"),
        "in_frame": (start % 3 == 0) & ((end - start) % 3 == 0),
        "del_cds_start": (start + 1).cast("int"),
        "del_cds_end": end.cast("int"),
        "del_cds_len": (end - start).cast("int"),
    }


def reported_insertion(inserted: Column) -> Column:
    """Insertions of one or two bases, or of N only, have no row."""
    return (F.length(inserted) >= 3) & ~inserted.rlike("^N+$")


def eligible_for_shift(position: Column, size: Column) -> Column:
    """A whole number of codons, but between the bases of one."""
    return (position % 3 != 0) & (size % 3 == 0)
