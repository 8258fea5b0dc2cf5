"""Hand-derived cases of the annotation plan."""

import hashlib

import pytest
from pyspark.sql import functions as F

from strandlake.plans.annotate import annotate, prepare
from strandlake.plans.module import Module
from strandlake.sources.config import ModuleConfig, Penalties, Reference, Spec
from strandlake.sources.tables import read_table, write_tables

REF = "ATGAAACCCGGGTTTTAA"
CONFIG = ModuleConfig("mini", "1", "-", "-", {"default": Penalties(5, 4, 10, 1)}, one_pass=True)


def module(specs=(Spec("R1", "T", "P", ((0, 18),), None),), ref=REF, config=CONFIG, **more):
    return Module(config, (Reference("R1", "T", 0, ref),), tuple(specs), more.get("weights", {}), more.get("rules", {}))


def run(spark, queries, mod):
    raw = spark.createDataFrame([(k, "T", v) for k, v in queries.items()], "id string, ctype string, seq string")
    return annotate(prepare(raw), mod)


CASES = {
    "identity": ("ATGAAACCCGGGTTTTAA", "ATGAAACCCGGGTTTTAA", "MKPGF*", "MKPGF*", "1..18", "1..18", False, False, "9251f0f9cb11a3751772141d69c8fd28ac67a0d9"),
    "early_stop": ("ATGTAACCCGGGTTTTAA", "ATGTAA............", "M*....", "M*", "1..6", "1..6", False, False, "e1cf8568bdddbedf105e3bd4c981eb25d54535c6"),
    "partial": ("AAACCCGGGTTTT", "...AAACCCGGGTTTT..", ".KPGF~", "KPGF~", "1..13", "4..16", False, False, "bca24b960b501c9334898bff60635ecc2ccec387"),
}


def test_golden_rows(spark):
    done = run(spark, {k: v[0] for k, v in CASES.items()}, module())
    got = {r.query_id: r for r in done.tables()["seq"].collect()}
    for name, (_, cds_aln, aa_aln, aa_seq, q, c, ins, shift, cds_id) in CASES.items():
        r = got[name]
        assert (r.cds_aln, r.aa_aln, r.aa_seq, r.query_coordinates, r.cds_coordinates, r.has_insertion, r.has_shift_indel, r.cds_id) == (cds_aln, aa_aln, aa_seq, q, c, ins, shift, cds_id)
        assert r.variant_hash == hashlib.md5(aa_seq.encode()).hexdigest()


def materialized(spark, nt, states, cds_len=18, lpad=0, rpad=0):
    from strandlake.operators.materialize import materialize_products, product_rows
    from strandlake.schema import CDS_STATES

    df = spark.createDataFrame([("q", "T", "R1", "P", nt, states, lpad, rpad, cds_len)], f"query_id string, ctype string, reference_id string, product_name string, nt string, states {CDS_STATES}, lpad int, rpad int, cds_len int")
    return {k: [r.asDict() for r in t.collect()] for k, t in product_rows(materialize_products(df)).items()}


def test_shifted_deletion(spark):
    t = materialized(spark, "ATGAAACGGTTTTAA", [("M", 0, 6, 0, 6), ("D", None, None, 6, 9), ("M", 6, 15, 9, 18)])
    (r,), (d,) = t["seq"], t["del"]
    assert (r["cds_aln"], r["aa_aln"], r["aa_seq"], r["query_coordinates"], r["cds_coordinates"]) == ("ATGAAA---CGGTTTTAA", "MK-RF*", "MKRF*", "1..6;7..15", "1..6;10..18")
    assert (d["del_aa_start"], d["del_aa_end"], d["del_aa_len"], d["in_frame"], d["del_cds_start"], d["del_cds_end"], d["del_cds_len"]) == (3, 3, 1, True, 7, 9, 3)
    assert not r["has_shift_indel"] and r["cds_id"] == "eb2654a9c6f60db4d5db99f058bcb631833304bf"


def test_filtered_insertion(spark):
    t = materialized(spark, "ATGAAAGGCCCGGGTTTTAA", [("M", 0, 6, 0, 6), ("I", 6, 8, 6, 6), ("M", 8, 20, 6, 18)])
    (r,) = t["seq"]
    assert (r["cds_aln"], r["aa_seq"], r["query_coordinates"], r["cds_coordinates"], r["has_insertion"], r["has_shift_indel"]) == ("ATGAAACCCGGGTTTTAA", "MKPGF*", "1..6;7..8;9..20", "1..6;6;7..18", True, True)
    assert t["ins"] == [] and r["cds_id"] == "53accf1e816713c572db2f943bd80c956de10b5c"


def test_insertions_splice_in_order_and_stop_after_the_first_stop(spark):
    t = materialized(spark, "ATGAAAGGGCCCTTTGGGTAAAAA", [("M", 0, 6, 0, 6), ("I", 6, 9, 6, 6), ("M", 9, 12, 6, 9), ("I", 12, 15, 9, 9), ("M", 15, 24, 9, 18)])
    (r,) = t["seq"]
    assert r["aa_seq"] == "MKGPFG*" and r["aa_aln"] == "MKPG*." and [i["inserted_aa"] for i in t["ins"]] == ["G", "F"]
    late = materialized(spark, "ATGTAAGGGCCC", [("M", 0, 6, 0, 6), ("I", 6, 9, 6, 6), ("M", 9, 12, 6, 9)], 9)
    assert late["ins"] == [] and not late["seq"][0]["has_insertion"]


def test_deleted_and_empty(spark):
    (r,) = materialized(spark, "A", [("D", None, None, 3, 12)], 18, 3, 6)["seq"]
    assert r["aa_aln"] == ".---.." and r["cds_aln"] == "..." + "-" * 9 + "......" and r["cds_id"] is None and r["query_coordinates"] is None
    assert materialized(spark, "A", [], 18, 0, 18)["seq"] == []


def test_terminal_indels_are_no_frame_shift(spark):
    (r,) = materialized(spark, "ATGAAAC", [("M", 0, 7, 0, 7), ("D", None, None, 7, 9)], 9)["seq"]
    assert not r["has_shift_indel"] and r["aa_aln"] == "MK~"


def test_overlapping_exons_gap_and_required_start(spark):
    ref = "CCATGAAACCCGGGTTTTAACC"
    specs = (
        Spec("R1", "T", "whole", ((2, 20),), "ATG"),
        Spec("R1", "T", "slip", ((2, 9), (8, 19)), None),
        Spec("R1", "T", "spliced", ((2, 8), (11, 20)), None),
        Spec("R1", "T", "wrong", ((2, 20),), "GTG"),
    )
    rows = {r.product_name: r for r in run(spark, {"q": ref}, module(specs, ref)).tables()["seq"].collect()}
    assert set(rows) == {"whole", "slip", "spliced"}
    assert rows["slip"].cds_seq == ref[2:9] + ref[8:19] and rows["slip"].query_coordinates == "3..9;9..19"
    assert rows["spliced"].cds_seq == ref[2:8] + ref[11:20] and rows["spliced"].aa_seq == "MKGF*"


def test_chew_repair_and_stop_extension(spark):
    from dataclasses import replace

    ref = "ATGAAACCCGGGTTTGCA"
    config = replace(CONFIG, chew_to_start=True, repairable_end_limit=9, try_stop_extension=True)
    mod = module((Spec("R1", "T", "P", ((0, 18),), None),), ref, config)
    t = run(spark, {"chew": "CC" + ref, "repair": "TTG" + ref[3:], "extend": ref + "GGGTAAC"}, mod).tables()
    rows = {r.query_id: r for r in t["seq"].collect()}
    assert rows["chew"].query_coordinates == "3..20"
    assert rows["repair"].cds_seq.endswith(ref[3:]) and len(rows["repair"].cds_seq) == 18
    assert rows["extend"].cds_seq == ref + "GGGTAA" and rows["extend"].aa_seq.endswith("AG*")
    genome = {r.query_id: r for r in t["gen_seq"].collect()}
    assert genome["extend"].genome_seq == ref + "GGGTAA" and genome["extend"].has_insertion
    assert [(r.query_id, r.upstream_nt_pos, r.inserted_nt) for r in t["gen_ins"].collect()] == [("extend", 18, "GGGTAA")]


def test_reports(spark):
    raw = spark.createDataFrame([("a", "T", REF), ("b", "X", REF), ("c", "T", "NNNN"), ("d", "T", "123")], "id string, ctype string, seq string")
    done = annotate(prepare(raw), module())
    assert [r.ctype for r in done.unimplemented.collect()] == ["X"]
    assert [(r.query_id, r.reference_id) for r in done.unaligned.collect()] == [("c", "R1")]
    with pytest.raises(Exception, match="no ctype"):
        prepare(spark.createDataFrame([("a", None, REF)], "id string, ctype string, seq string")).collect()


def test_counts_come_with_the_first_table(spark, tmp_path):
    from pyspark.sql import Observation

    raw = spark.createDataFrame([("a", "T", REF), ("b", "X", REF), ("c", "T", "NNNN"), ("d", "T", "123"), ("e", "T", REF)], "id string, ctype string, seq string").repartition(3)
    prepared, aligned = Observation("p"), Observation("a")
    done = annotate(prepare(raw, seen=prepared), module(), seen=aligned)
    write_tables(done.tables(), f"{tmp_path}/seen_")
    assert prepared.get == {"prepared": 5, "without_bases": 1} and aligned.get == {"pairs": 3, "unaligned": 1}
    done.kept.unpersist()


def test_command_line_classifies(spark, tmp_path, caplog):
    """Sequences without a type get it from the references; counts and reasons are told."""
    import random

    from strandlake import cli

    rng = random.Random(1)
    ref, other = ("".join(rng.choice("ACGT") for _ in range(300)) for _ in range(2))
    (tmp_path / "modules.toml").write_text('[[module]]\nname = "m"\nreferences = "r.fa"\ncds_spec = "s.tsv"\n[module.alignment.default]\nmatch = 5\nmismatch = 4\ngap_open = 10\ngap_extend = 1\n')
    (tmp_path / "r.fa").write_text(f">R|T\n{ref}\n")
    (tmp_path / "s.tsv").write_text("R\tT\tP\t1..300\n")
    flipped = ref.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    (tmp_path / "q.fa").write_text(f">plain|T\n{ref}\n>untold\n{flipped}\n>strange\n{other}\n")
    with caplog.at_level("INFO", logger="strandlake"):
        assert cli.main([str(tmp_path / "q.fa"), "--modules-dir", str(tmp_path), "--module", "m", "--output-prefix", f"{tmp_path}/o_", "--verbose"]) == 0
    rows = {r.query_id: r for r in read_table(spark, "gen_seq", f"{tmp_path}/o_gen_seq").collect()}
    assert set(rows) == {"plain", "untold"} and rows["untold"].genome_seq == ref
    assert "unrecognizable: strange" in caplog.text and "2 sequences, 0 without bases; 2 alignments tried" in caplog.text


def test_round_trip(spark, tmp_path):
    queries = {"full": REF, "gap": "ATGAAACCCTTTTAA" + "G" * 3, "quote\"d": "ATGAAAGGGCCCGGGTTTTAA", "tab\tbed": "AAACCCGGGTTTT"}
    tables = run(spark, queries, module()).tables()
    paths = write_tables(tables, f"{tmp_path}/out_")
    for t, df in tables.items():
        again = read_table(spark, t, paths[t]).drop("kind")
        assert sorted(map(str, again.collect())) == sorted(map(str, df.select(*again.columns).collect())), t


def test_rows_of_indels_come_from_one_copy_of_the_steps(spark, tmp_path):
    """No filter on the size of the arrays goes below the steps that make them, each of which it would repeat."""
    from strandlake.catalog.relations import product_indels

    spark.range(1, 20).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    rows = product_indels(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 6
    assert {r["what"] for r in rows.collect()} == {"ins", "del"}


def test_products_are_dealt_before_any_step(spark, tmp_path):
    """Leaving out empty products is no filter on their steps below the dealing of rows, where few tasks would do it."""
    from strandlake.catalog.relations import product_materialize

    spark.range(1, 20).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    rows = product_materialize(spark, str(tmp_path))
    _, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Repartition")
    assert "struct" not in below
    assert sorted(int(r["query_id"]) for r in rows.collect()) == list(range(1, 20))
