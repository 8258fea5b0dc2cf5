"""Alignments as arrays of match, insertion and deletion ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandlake.schema import CDS_STATES, STATES


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n, op>>; =, X and M are one kind, clips are left out."""
    sizes = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(1)), lambda n: n.cast("int"))
    kinds = F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(2))
    ops = F.zip_with(sizes, kinds, lambda n, op: F.struct(n.alias("n"), F.translate(op, "=X", "MM").alias("op")))
    return F.filter(ops, lambda o: o["op"].isin("M", "I", "D"))


def states_of(cigar: Column, q_start: Column, r_start: Column) -> Column:
    """STATES in order. Deletions have no query range; an insertion's reference range is its point, twice."""
    acc = f"struct<q:int,r:int,out:{STATES}>"

    def add(a: Column, o: Column) -> Column:
        q = a["q"] + F.when(o["op"] == "D", 0).otherwise(o["n"])
        r = a["r"] + F.when(o["op"] == "I", 0).otherwise(o["n"])
        reads = o["op"] != "D"
        one = F.struct(o["op"].alias("op"), F.when(reads, a["q"]).alias("q_start"), F.when(reads, q).alias("q_end"), a["r"].alias("r_start"), r.alias("r_end"))
        same = F.element_at(a["out"], -1)
        joined = F.struct(same["op"].alias("op"), same["q_start"].alias("q_start"), F.when(reads, q).alias("q_end"), same["r_start"].alias("r_start"), r.alias("r_end"))
        merge = (F.size(a["out"]) > 0) & (F.try_element_at(a["out"], F.lit(-1))["op"] == o["op"])
        out = F.when(merge, F.concat(F.slice(a["out"], F.lit(1), F.size(a["out"]) - 1), F.array(joined))).otherwise(F.concat(a["out"], F.array(one)))
        return F.struct(q.alias("q"), r.alias("r"), out.alias("out")).cast(acc)

    start = F.struct(q_start.alias("q"), r_start.alias("r"), F.array().cast(STATES).alias("out")).cast(acc)
    return F.aggregate(cigar_ops(cigar), start, add, lambda a: a["out"])


def extended(states: Column, left: Column, right: Column) -> Column:
    """The first and last match made longer; both are matches."""
    n = F.size(states)

    def one(s: Column, i: Column) -> Column:
        a, b = F.when(i == 0, left).otherwise(0), F.when(i == n - 1, right).otherwise(0)
        return F.struct(s["op"].alias("op"), (s["q_start"] - a).alias("q_start"), (s["q_end"] + b).alias("q_end"), (s["r_start"] - a).alias("r_start"), (s["r_end"] + b).alias("r_end"))

    return F.transform(states, one).cast(STATES)


def written_cigar(states: Column, q_len: Column) -> Column:
    """Operations with soft clips for the query bases outside."""
    size = lambda s: F.when(s["op"] == "D", s["r_end"] - s["r_start"]).otherwise(s["q_end"] - s["q_start"])
    body = F.array_join(F.transform(states, lambda s: F.concat(size(s).cast("string"), s["op"])), "")
    reads = F.filter(states, lambda s: s["op"] != "D")
    head, tail = F.element_at(reads, 1)["q_start"], q_len - F.element_at(reads, -1)["q_end"]
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise(F.lit(""))
    return F.concat(clip(head), body, clip(tail))


def in_exons(states: Column, exons: Column) -> Column:
    """CDS_STATES: each exon's share of each state, exon by exon. Matches and deletions are cut to the exon; an
    insertion counts only strictly inside one."""

    def clip(s: Column, e: Column) -> Column:
        lo, hi = F.greatest(s["r_start"], e["ref_start"]), F.least(s["r_end"], e["ref_end"])
        shift = e["cds_start"] - e["ref_start"]
        point = s["op"] == "I"
        inside = F.when(point, (e["ref_start"] < s["r_start"]) & (s["r_start"] < e["ref_end"])).otherwise(lo < hi)
        q_start = F.when(point, s["q_start"]).otherwise(s["q_start"] + lo - s["r_start"])
        q_end = F.when(point, s["q_end"]).otherwise(s["q_end"] - (s["r_end"] - hi))
        at = F.when(point, s["r_start"]).otherwise(lo) + shift
        made = F.struct(s["op"].alias("op"), q_start.alias("q_start"), q_end.alias("q_end"), at.alias("c_start"), F.when(point, at).otherwise(hi + shift).alias("c_end"))
        return F.when(inside, made)

    return F.flatten(F.transform(exons, lambda e: F.filter(F.transform(states, lambda s: clip(s, e)), lambda x: x.isNotNull()))).cast(CDS_STATES)


def condensed(states: Column) -> Column:
    """Adjacent deletions become one."""

    def add(a: Column, s: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        both = F.coalesce((last["op"] == "D") & (s["op"] == "D"), F.lit(False))
        joined = F.struct(last["op"].alias("op"), last["q_start"].alias("q_start"), last["q_end"].alias("q_end"), last["c_start"].alias("c_start"), s["c_end"].alias("c_end"))
        return F.when(both, F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(a, F.array(s))).cast(CDS_STATES)

    return F.aggregate(states, F.array().cast(CDS_STATES), add)


def has_required_start(states: Column, nt: Column, required: Column) -> Column:
    """Whether the query's three bases at the start of the product are the required codon; U counts as T."""
    first = F.get(states, F.lit(0))
    at_start = first["op"].isin("M", "I") & (first["c_start"] == 0)
    codon = F.translate(F.substr(nt, first["q_start"] + 1, F.lit(3)), "U", "T")
    return F.coalesce(required.isNull() | (at_start & (codon == required)), F.lit(False))


def needs_frame_fix(states: Column) -> Column:
    """Whether any indel may be moved or merged; only then the sequential step runs."""
    movable = F.exists(states, lambda s: (s["op"] != "M") & (s["c_start"] % 3 != 0) & (F.when(s["op"] == "D", s["c_end"] - s["c_start"]).otherwise(s["q_end"] - s["q_start"]) % 3 == 0))
    runs = F.array_join(F.transform(states, lambda s: s["op"]), "")
    return movable | F.contains(runs, F.lit("DD"))
