"""From ranges to sequences, translations, hashes and rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.coords import written
from strandlake.functions.indels import deletion_metrics, insertion_metrics, reported_insertion
from strandlake.functions.iupac import genome_id, translate_exact, variant_hash
from strandlake.schema import CDS_STATES, STATES, names


def bases(nt: Column, s: Column) -> Column:
    return F.substr(nt, s["q_start"] + 1, s["q_end"] - s["q_start"])


def aligned(states: Column, nt: Column, lpad: Column, start: str = "c_start", end: str = "c_end") -> Column:
    """Padding, then matched bases, with gaps for deletions; insertions are left out."""
    parts = F.transform(states, lambda s: F.when(s["op"] == "M", bases(nt, s)).when(s["op"] != "I", F.repeat(F.lit("-"), s[end] - s[start])))
    return F.concat(F.repeat(F.lit("."), lpad), F.array_join(parts, ""))


def spliced(letters: Column, ins: Column) -> Column:
    """Inserted amino acids put after the aligned residue they follow, gaps and padding dropped."""
    state = "struct<at:int,out:string>"

    def add(a: Column, i: Column) -> Column:
        part = F.translate(F.substr(letters, a["at"] + 1, i["upstream_aa_pos"] - a["at"]), "-.", "")
        return F.struct(i["upstream_aa_pos"].alias("at"), F.concat(a["out"], part, i["inserted_aa"]).alias("out")).cast(state)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state)
    return F.aggregate(ins, start, add, lambda a: F.concat(a["out"], F.translate(F.substr(letters, a["at"] + 1), "-.", "")))


def materialize_products(rows: DataFrame) -> DataFrame:
    """rows: query_id, ctype, reference_id, product_name, nt, states, lpad, rpad, cds_len. Adds the columns of the
    product tables, arrays ins and del, the paddings, and kind: data, empty (no states) or deleted (one deletion).

    The first stop codon ends a product: what comes after is left out, and padded. Filtered insertions are in cds_seq
    but not in aa_seq."""
    states, nt = F.col("states"), F.col("nt")
    n = F.size(states)
    kind = F.when(n == 0, "empty").when((n == 1) & (F.try_element_at(states, F.lit(1))["op"] == "D"), "deleted").otherwise("data")
    out = rows.withColumns({"kind": kind, "__aln": aligned(states, nt, F.col("lpad"))}).withColumn("__aa", translate_exact(F.col("__aln")))
    out = out.withColumn("__at", F.instr("__aa", "*"))
    stopped, stop = F.col("__at") > 0, 3 * F.col("__at")
    rest = F.when(F.length("__aln") % 3 > 0, F.lit("~")).otherwise(F.lit(""))
    cut = F.transform(states, lambda s, i: F.struct(s["op"].alias("op"), s["q_start"].alias("q_start"), F.when(stopped & (s["op"] == "M") & (s["c_end"] > stop), s["q_end"] - (s["c_end"] - stop)).otherwise(s["q_end"]).alias("q_end"), s["c_start"].alias("c_start"), F.when(stopped & (s["op"] == "M"), F.least(s["c_end"], stop)).otherwise(s["c_end"]).alias("c_end"), ((i == 0) | (i == n - 1)).alias("edge")))
    out = out.withColumns(
        {
            "__kept": F.filter(cut, lambda s: ~stopped | (s["c_start"] < stop)),
            "cds_aln": F.when(stopped, F.substr("__aln", F.lit(1), stop)).otherwise(F.col("__aln")),
            "aa_aln": F.when(stopped, F.substr("__aa", F.lit(1), F.col("__at"))).otherwise(F.concat("__aa", rest)),
            "cds_rpad": F.when(stopped, F.col("cds_len") - stop).otherwise(F.col("rpad")),
        }
    )
    k = F.col("__kept")
    read = lambda text, between: F.array_join(F.transform(k, lambda s: F.when(s["op"] != "D", text(s))), between)
    whole = lambda s: F.when(s["op"] == "D", s["c_end"] - s["c_start"]).otherwise(s["q_end"] - s["q_start"]) % 3 == 0
    inserted = F.filter(k, lambda s: (s["op"] == "I") & reported_insertion(bases(nt, s)))
    out = out.withColumns(
        {
            "cds_seq": read(lambda s: bases(nt, s), ""),
            "has_insertion": F.exists(k, lambda s: s["op"] == "I"),
            "has_shift_indel": F.exists(k, lambda s: ((s["op"] == "I") | ((s["op"] == "D") & ~s["edge"])) & ~whole(s)),
            "query_coordinates": read(lambda s: written(s["q_start"], s["q_end"]), ";"),
            "cds_coordinates": read(lambda s: written(s["c_start"], F.when(s["op"] == "M", s["c_end"])), ";"),
            "ins": F.transform(inserted, lambda s: F.struct(*[v.alias(c) for c, v in insertion_metrics(s["c_start"], bases(nt, s)).items()])),
            "del": F.transform(F.filter(k, lambda s: s["op"] == "D"), lambda s: F.struct(*[v.alias(c) for c, v in deletion_metrics(s["c_start"], s["c_end"]).items()])),
            "aa_rpad": F.floor(F.col("cds_rpad") / 3).cast("int"),
        }
    )
    out = out.withColumn("aa_seq", spliced(F.col("aa_aln"), F.col("ins")))
    out = out.withColumns({"cds_id": genome_id(F.col("cds_seq")), "variant_hash": variant_hash(F.col("aa_seq"))})
    data, some = F.col("kind") == "data", F.col("kind") != "empty"
    only_data = {c: F.when(data, F.col(c)) for c in ("variant_hash", "aa_seq", "cds_id", "cds_seq", "query_coordinates", "cds_coordinates")}
    flags = {c: data & F.col(c) for c in ("has_insertion", "has_shift_indel")}
    return out.withColumns(only_data | flags | {c: F.when(some, F.col(c)) for c in ("aa_aln", "cds_aln")}).drop("__aln", "__aa", "__at", "__kept")


def padded(pad_aa: bool = True, pad_cds: bool = True) -> dict[str, Column]:
    """The aligned columns of materialised products that are filled up to the product's length."""
    out = {}
    if pad_aa:
        out["aa_aln"] = F.concat("aa_aln", F.repeat(F.lit("."), F.col("aa_rpad")))
    if pad_cds:
        out["cds_aln"] = F.concat("cds_aln", F.repeat(F.lit("."), F.col("cds_rpad")))
    return out


def product_rows(materialized: DataFrame, pad_aa: bool = True, pad_cds: bool = True) -> dict[str, DataFrame]:
    """The tables seq, ins and del. Products without any state have no row.

    Rows are exploded with a null for empty arrays, which is left out afterwards: else Spark would first filter by the
    size of the array, or by kind, and push that below all steps, each of which would be written out and computed many
    times, and below the dealing of rows to all cores."""
    keys = ["query_id", "ctype", "reference_id", "product_name"]
    of_data = F.when(F.col("kind") == "data", F.col("ins"))
    ins = materialized.select(*keys, F.explode_outer(of_data).alias("x")).filter("x IS NOT NULL").select(*keys, "x.*")
    gone = materialized.select(*keys, "variant_hash", "cds_id", F.explode_outer("del").alias("x")).filter("x IS NOT NULL").select(*keys, "variant_hash", "cds_id", "x.*")
    some = F.when(F.col("kind") != "empty", F.array(F.struct(*names("seq"))))
    seq = materialized.withColumns(padded(pad_aa, pad_cds)).select(F.explode_outer(some).alias("x")).filter("x IS NOT NULL").select("x.*")
    return {"seq": seq, "ins": ins.select(*names("ins")), "del": gone.select(*names("del"))}


def with_extension(states: Column, stop_end: Column, ref_len: Column) -> Column:
    """States of a genome and, where there is a stop extension, its insertion at the end."""
    one = F.struct(F.lit("I").alias("op"), F.element_at(states, -1)["q_end"].alias("q_start"), stop_end.alias("q_end"), ref_len.alias("r_start"), ref_len.alias("r_end"))
    return F.concat(states, F.when(stop_end.isNotNull(), F.array(one)).otherwise(F.array().cast(STATES)))


def genome_parts(every: Column, states: Column, nt: Column, ref_len: Column, pad: bool = True) -> tuple[dict[str, Column], Column, Column]:
    """Columns of gen_seq, and arrays of what gen_ins and gen_del have beside their keys. ``every`` are the states with
    their extension. Nothing is cut or filtered."""
    seq = F.array_join(F.transform(F.filter(every, lambda s: s["op"] != "D"), lambda s: bases(nt, s)), "")
    tail = F.repeat(F.lit("."), ref_len - F.element_at(states, -1)["r_end"]) if pad else F.lit("")
    aln = F.concat(aligned(states, nt, F.element_at(states, 1)["r_start"], "r_start", "r_end"), tail)
    own = {"genome_id": genome_id(seq), "genome_length": F.length(seq), "has_insertion": F.exists(every, lambda s: s["op"] == "I"), "genome_seq": seq, "genome_aln": aln}
    ins = F.transform(F.filter(every, lambda s: s["op"] == "I"), lambda s: F.struct(s["r_start"].alias("upstream_nt_pos"), bases(nt, s).alias("inserted_nt")))
    gone = F.transform(F.filter(every, lambda s: s["op"] == "D"), lambda s: F.struct((s["r_start"] + 1).alias("del_start"), s["r_end"].alias("del_end"), (s["r_end"] - s["r_start"]).alias("del_len")))
    return own, ins, gone


def genome_rows(rows: DataFrame, pad: bool = True) -> dict[str, DataFrame]:
    """The tables gen_seq, gen_ins and gen_del of rows: query_id, ctype, reference_id, nt, states (genome), ref_len,
    stop_end (end of a stop extension, or null)."""
    every = rows.withColumn("every", with_extension(F.col("states"), F.col("stop_end"), F.col("ref_len")))
    own, ins, gone = genome_parts(F.col("every"), F.col("states"), F.col("nt"), F.col("ref_len"), pad)
    keys = ["query_id", "ctype", "reference_id"]
    # as in product_rows
    inserted = every.select(*keys, F.inline_outer(ins)).filter("upstream_nt_pos IS NOT NULL")
    deleted = every.select(*keys, F.inline_outer(gone)).filter("del_start IS NOT NULL")
    return {"gen_seq": every.select(*keys, *[v.alias(k) for k, v in own.items()]), "gen_ins": inserted, "gen_del": deleted}


def with_stop_extension(states: Column, due: Column, q_end: Column, stop_end: Column, cds_len: Column) -> Column:
    """The insertion that a stop extension brings, at the end of a product."""
    one = F.struct(F.lit("I").alias("op"), q_end.alias("q_start"), stop_end.alias("q_end"), cds_len.alias("c_start"), cds_len.alias("c_end"))
    return F.when(due & stop_end.isNotNull() & (F.size(states) > 0), F.concat(states, F.array(one))).otherwise(states).cast(CDS_STATES)

