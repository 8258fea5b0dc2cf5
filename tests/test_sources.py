"""Readers, configuration rules, paths, functions for SQL, streaming and the command line."""

import pytest

from strandlake import cli
from strandlake.plans.module import ctypes_elsewhere, load
from strandlake.plans.annotate import prepare, unimplemented_by_module
from strandlake.schema import AnnotationError
from strandlake.sources import config
from strandlake.sources.queries import detect_format, read_queries
from strandlake.sources.tables import check_paths, read_table

REF = "ATGAAACCCGGGTTTTAA"
MODULES = """
[[module]]
name = "mini"
version = "1"
alternative_names = ["Small"]
references = "refs.fasta"
cds_spec = "spec.tsv"
weights = "weights.tsv"
alignment_method = "one-pass"
[module.experimental]
rewrite_rules = "rules.toml"
[module.rules]
repairable_end_limit = 9
[module.alignment]
default = { match = 5, mismatch = -4, gap_open = -10, gap_extend = 1 }
T2 = { match = 6, mismatch = 1, gap_open = 9, gap_extend = 1 }

[[module]]
name = "other"
version = "1"
references = "other.fasta"
cds_spec = "none.tsv"
[module.alignment]
default = { match = 1, mismatch = 1, gap_open = 8, gap_extend = 1 }
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "modules.toml").write_text(MODULES)
    own = tmp_path / "mini"
    own.mkdir()
    (own / "refs.fasta").write_text(f">R1|T|x\n{REF[:9].lower()}\n{REF[9:]}\n>R1 | T\n{REF[:-1]}G\n")
    (own / "spec.tsv").write_text("reference_id\tctype\tproduct_name\tcoords\trequired_beginning\n# a comment\n\nR1\tT\tP\t1..18\tAUG")
    (own / "weights.tsv").write_text("#R1|P\n1 aug 5\n2\tAAA\t7\n")
    (own / "rules.toml").write_text('[[genome.deletions]]\nrule = { ctype = "T", reference_id = "R1", from = "7..9", to = "4..6" }\n')
    (tmp_path / "other.fasta").write_text(">A|X\nACGT\n>broken\nAC\n")
    return tmp_path


def test_module(folder, spark):
    m = load(folder, "SMALL")
    assert m.groups() == {("R1", "T"): [REF, REF[:-1] + "G"]}
    assert m.specs[0].required_start == "ATG" and m.weights == {("R1", "P"): {(1, "ATG"): 5, (2, "AAA"): 7}}
    assert m.rules == {("R1", "T"): [config.Rule(6, 9, 3, 6)]}
    assert m.config.penalties("T") == config.Penalties(5, 4, 10, 1) and m.config.penalties("T2").match == 6
    elsewhere = ctypes_elsewhere(spark, folder, "mini")
    assert [tuple(r) for r in elsewhere.collect()] == [(1, "other", "X")]
    lost = spark.createDataFrame([("X",), ("Y",)], "ctype string")
    assert {(r.module, tuple(r.ctypes)) for r in unimplemented_by_module(lost, elsewhere).collect()} == {("other", ("X",)), (None, ("Y",))}
    with pytest.raises(AnnotationError, match="no such module"):
        load(folder, "nothing")


@pytest.mark.parametrize(
    "name,text,message",
    [
        ("refs.fasta", ">R1|T\nACG-T\n", "a gap"),
        ("refs.fasta", ">R1|T\nACGJ\n", "not a nucleotide"),
        ("refs.fasta", ">R1\nACG\n", "not a reference header"),
        ("refs.fasta", f">R1|T\n{REF}\n>R1|T\n{REF}A\n", "differ in length"),
        ("refs.fasta", f">R2|T\n{REF}\n", "without a reference"),
        ("spec.tsv", "R1\tT\tP\t1..17\t", "whole codons"),
        ("spec.tsv", "R1\tT\tP\t1..18\tATN", "not a start codon"),
        ("spec.tsv", "R1\tT\tP\t1..21\t", "beyond"),
        ("spec.tsv", "R1\tT\tP\t5..3", "not a range"),
        ("spec.tsv", "R1\tT\tP\t1..18\nR1\tT\tP\t1..18", "more than one"),
        ("spec.tsv", "R1\tT\tP\t1..6;7..18", "adjoining"),
        ("spec.tsv", "R1\tT\tP\t1..9;6..14", "share more"),
        ("spec.tsv", "R1\tT\tP\t7..12;1..6", "out of order"),
        ("spec.tsv", "reference_id\twrong\tx\ty\nR1\tT\tP\t1..18", "unexpected header"),
        ("weights.tsv", "1 ATG 5\n", "before the first section"),
        ("weights.tsv", "#R1|P\n", "empty section"),
        ("weights.tsv", "#R1|P\n1 ATG 5\n1 AUG 6\n", "repeated weight"),
        ("weights.tsv", "#R1|P\n0 ATG 5\n", "not a weight"),
        ("weights.tsv", "#R1|Q\n1 ATG 5\n", "without a coding region"),
        ("rules.toml", '[[genome.deletions]]\nrule = { ctype = "T", reference_id = "R1", from = "7..9", to = "4..7" }\n', "one length"),
        ("rules.toml", '[[genome.deletions]]\nrule = { ctype = "T", reference_id = "R1", from = "7..9", to = "4..6", x = 1 }\n', "unknown fields"),
    ],
)
def test_configuration_rules(folder, name, text, message):
    (folder / "mini" / name).write_text(text)
    with pytest.raises(AnnotationError, match=message):
        load(folder, "mini")


def test_module_list_rules(folder):
    path = folder / "modules.toml"
    path.write_text(MODULES.replace('name = "other"', 'name = "small"'))
    with pytest.raises(AnnotationError, match="repeated module name"):
        load(folder, "mini")
    path.write_text(MODULES.replace('cds_spec = "none.tsv"', 'cds_spec = "none.tsv"\nextra = 1'))
    with pytest.raises(AnnotationError, match="unknown fields"):
        load(folder, "mini")
    path.write_text(MODULES.replace("match = 6", "match = -128"))
    with pytest.raises(AnnotationError, match="between"):
        load(folder, "mini")


@pytest.mark.parametrize("header,key", [("A_HA|H3N2", ("A_HA", "H3N2")), ("A_HA|H3N2|more\tmore|more", ("A_HA", "H3N2")), ("no_pipe", None), ("A\tHA|H3N2", None), ("A_HA|H3\tN2", None)])
def test_reference_headers(header, key):
    if key:
        assert config.parse_key(header) == key
    else:
        with pytest.raises(AnnotationError):
            config.parse_key(header)


def test_query_files(spark, tmp_path):
    fasta, tsv, empty = tmp_path / "q.fasta", tmp_path / "q.tsv", tmp_path / "empty"
    fasta.write_text(">a | T |x\nACG\nT-acj\r\n>plain id\nAC\n>c|T\n\n")
    tsv.write_text("a\tACGT\n\nb\t T \tAC GT\tmore\n")
    empty.write_text("")
    assert (detect_format(spark, str(fasta)), detect_format(spark, str(tsv))) == ("fasta", "tsv")
    assert sorted(map(tuple, read_queries(spark, str(fasta)).fillna("-").collect())) == [("a", "T", "ACGT-acj"), ("c", "T", ""), ("plain id", "-", "AC")]
    assert sorted(map(tuple, read_queries(spark, str(tsv)).fillna("-").collect())) == [("a", "-", "ACGT"), ("b", "T", "AC GT")]
    with pytest.raises(AnnotationError, match="empty input"):
        detect_format(spark, str(empty))
    assert sorted((r.query_id, r.nt, r.ctype) for r in prepare(read_queries(spark, str(fasta)), "D").collect()) == [("a", "ACGTACN", "T"), ("plain id", "AC", "D")]
    for text in (">a|\nACG\n", "only\n", "a\t\tACG\n"):
        tsv.write_text(text)
        with pytest.raises(Exception, match="no ctype|two columns|empty ctype"):
            read_queries(spark, str(tsv)).collect()


def test_classifier(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame([("a", None, "aacg"), ("b", "T", "ACGT"), ("c", None, "ACGT")], "id string, ctype string, seq string")
    told = lambda rows: rows.withColumns({"classified": F.lit("C"), "strand": F.lit("-"), "status": F.when(F.col("id") == "c", "chimeric").otherwise("classified")})
    assert sorted(map(tuple, prepare(raw, None, told).collect())) == [("a", "CGTT", "C"), ("b", "ACGT", "T")]


def test_paths(tmp_path):
    check_paths("in", ["a", "b", "/dev/null", "/dev/null"])
    for outputs in (["in"], ["a", "./a"]):
        with pytest.raises(AnnotationError):
            check_paths("in", outputs)


def test_sql_functions(spark, folder):
    from strandlake.sql import register

    register(spark, load(folder, "mini"))
    assert spark.sql("SELECT nt_translate('AUGYTA---.-.AT-AC') AS a, nt_translate('') AS b").first() == ("ML-.~~", "")
    assert [tuple(r) for r in spark.sql(f"SELECT reference_id, cigar FROM nt_annotate('{REF}', 'T')").collect()] == [("R1", "18M")]
    row = spark.sql("SELECT nt_sanitize('ac-gt.u e*Z') AS a, revcomp('AACGRU') AS b, nt_align('AACGT', 'TTAACGTT', 5, 4, 10, 1) AS c").first()
    assert (row.a, row.b, row.c.cigar, row.c.r_start) == ("ACGTUNN", "AYCGTT", "5M", 2)


def test_ambiguous_codons(spark):
    from pyspark.sql import functions as F

    from strandlake.functions.iupac import amino

    want = {"ATG": "M", "AUG": "M", "CTN": "L", "YTA": "L", "TAR": "*", "RAC": "X", "KRC": "X", "MGR": "R", "---": "-", "...": ".", "..-": ".", "AT-": "~", "AT": "~", "NNN": "X"}
    got = {r.c: r.a for r in spark.createDataFrame([(c,) for c in want], "c string").select("c", amino(F.col("c")).alias("a")).collect()}
    assert got == want


def test_coordinates(spark):
    from pyspark.sql import functions as F

    from strandlake.functions.coords import format_ranges, parse_ranges

    df = spark.createDataFrame([("1..18;6;7..7",)], "t string")
    assert df.select(format_ranges(parse_ranges(F.col("t")))).first()[0] == "1..18;6;7..7"
    for bad in ("0..4", "5..4", "a", "1..", ""):
        with pytest.raises(Exception, match="not coordinates"):
            spark.createDataFrame([(bad,)], "t string").select(parse_ranges(F.col("t"))).collect()


def test_table_rules(spark, tmp_path):
    (tmp_path / "seq").write_text("q\tT\tR\tP\tx\t\\N\tM\tc\tfalse\tfalse\tA\tA\t1..1\t1..1\n")
    with pytest.raises(Exception, match="impossible nulls"):
        read_table(spark, "seq", str(tmp_path / "seq")).collect()
    (tmp_path / "del").write_text("q\tT\tR\tP\tx\t1\t1\t1\ttrue\t\\N\t1\t3\t3\n")
    with pytest.raises(Exception, match="one hash"):
        read_table(spark, "del", str(tmp_path / "del")).collect()


def test_command_line(spark, folder, tmp_path):
    data = tmp_path / "q.tsv"
    data.write_text(f"a\tT\t{REF}\nb\tX\t{REF}\n")
    prefix = str(tmp_path / "out_")
    assert cli.main([str(data), "--modules-dir", str(folder), "--module", "mini", "--output-prefix", prefix]) == 0
    rows = read_table(spark, "seq", prefix + "seq").collect()
    assert [(r.query_id, r.product_name, r.aa_seq, r.kind) for r in rows] == [("a", "P", "MKPGF*", "data")]
    assert read_table(spark, "gen_seq", prefix + "gen_seq").count() == 1
    with pytest.raises(SystemExit):
        cli.output_paths(cli.parser().parse_args(["in", "a", "b"]))
    assert len(cli.output_paths(cli.parser().parse_args(["in", "a", "b", "c", "d"]))) == 4


def test_stream(spark, folder, tmp_path):
    from strandlake.streaming.annotate import annotate_stream, read_lines

    (tmp_path / "arrivals").mkdir()
    (tmp_path / "arrivals" / "one.tsv").write_text(f"a\tT\t{REF}\nb\tT\t{REF[3:]}\n")
    query = annotate_stream(read_lines(spark, str(tmp_path / "arrivals")), load(folder, "mini"), str(tmp_path / "tables_"), str(tmp_path / "state"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "tables_seq")).count() == 1  # the other lacks the required start
    assert spark.read.parquet(str(tmp_path / "tables_gen_seq")).count() == 2
