"""Alignment, the two sequential steps and the whole plan, on mutated copies of a synthetic reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.catalog.base import long, nt_of, sql_aminos, sql_nt, table
from strandlake.operators.frames import ProductShape, fix_frames_udf, rewrite_udf
from strandlake.plans.annotate import aligned_states, annotate, prepare
from strandlake.plans.module import Module
from strandlake.plans.onepass import read_together, table_lines, write_together
from strandlake.schema import CDS_STATES, STATES
from strandlake.sources.config import ModuleConfig, Penalties, Reference, Rule, Spec
from strandlake.sources.scratch import new_folder

SQL: dict[str, str] = {}

#: A reference made up for these queries: 121 bases with a coding region, and an alternate with three changes.
REFERENCE = "CCTTATGGCAAGTCACGATCTGAACGTCCATTGGAGCTACCGTAAACCTGTGACTTCGGCATACAGGTTCAACGGATCCTGACATGCGAAGTCTCTTGGACCATTAGCAGTTGAACCTGTA"
ALTERNATE = REFERENCE[:40] + "T" + REFERENCE[41:70] + "A" + REFERENCE[71:90] + "C" + REFERENCE[91:]


def synthetic_module() -> Module:
    config = ModuleConfig("synthetic", "1", "-", "-", {"default": Penalties(14, 1, 40, 1)}, one_pass=True, repairable_end_limit=9)
    specs = (Spec("S1", "T", "whole", ((4, 118),), "ATG"), Spec("S1", "T", "spliced", ((4, 34), (49, 100)), None), Spec("S1", "T", "slip", ((4, 45), (44, 78)), None))
    refs = (Reference("S1", "T", 0, REFERENCE), Reference("S1", "T", 1, ALTERNATE))
    return Module(config, refs, specs, {("S1", "whole"): {(10, "ACG"): 7, (12, "CCA"): 3}}, {})


def mutated(spark: SparkSession, sf: str) -> DataFrame:
    """A copy for each customer: one base changed in the middle, up to six bases left out, up to four put in."""
    k = F.col("c_custkey").cast("int")
    at, gone = 20 + k % 30, (k % 3) * 3
    ref = F.lit(REFERENCE)
    head = F.concat(F.substr(ref, F.lit(1), at - 1), F.translate(F.substr(ref, at, F.lit(1)), "ACGT", "CGTA"), F.substr(ref, at + 1, 60 - at))
    seq = F.concat(head, F.substr(nt_of(k, "-i"), F.lit(1), k % 5), F.substr(ref, 61 + gone))
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.when(k % 50 == 0, "Z").otherwise("T").alias("ctype"), seq.alias("seq"))


_MUTATED = f"""
WITH m AS (SELECT c_custkey, 20 + c_custkey % 30 AS a, (c_custkey % 3) * 3 AS g, '{REFERENCE}' AS r FROM customer WHERE c_custkey % 50 <> 0),
s AS (SELECT CAST(c_custkey AS VARCHAR) AS query_id, substr(r, 1, CAST(a - 1 AS BIGINT)) || translate(substr(r, CAST(a AS BIGINT), 1), 'ACGT', 'CGTA') || substr(r, CAST(a + 1 AS BIGINT), CAST(60 - a AS BIGINT))
      || substr({sql_nt('c_custkey', '-i')}, 1, CAST(c_custkey % 5 AS BIGINT)) || substr(r, CAST(61 + g AS BIGINT)) AS nt FROM m) """


#: Places of the reference, in frame of the products that don't slip, with what is put in there (no stop codon) or how
#: much is left out; the bases around them differ, so no other place is as good.
NEXT = str.maketrans("ACGT", "CGTA")
PUT_IN = tuple((p, REFERENCE[p].translate(NEXT) + middle + REFERENCE[p - 1].translate(NEXT)) for p, middle in ((55, "C"), (61, "GCTC"), (67, "C"), (76, "CCAC")))
LEFT_OUT = tuple((p, g) for p in range(55, 77, 3) for g in (3, 6) if REFERENCE[p] != REFERENCE[p + g] and REFERENCE[p - 1] != REFERENCE[p + g - 1])


def placed(spark: SparkSession, sf: str) -> DataFrame:
    """A copy for each customer: one base changed, and for two of three bases put in or left out at one known place."""
    k = F.col("c_custkey").cast("int")
    at, ref = 20 + k % 30, F.lit(REFERENCE)
    head = F.concat(F.substr(ref, F.lit(1), at - 1), F.translate(F.substr(ref, at, F.lit(1)), "ACGT", "CGTA"))
    tail = [F.when(F.lit(False), "")]
    for kind, changes in ((1, [(p, x, 0) for p, x in PUT_IN]), (2, [(p, "", g) for p, g in LEFT_OUT])):
        for i, (p, x, g) in enumerate(changes):
            made = F.concat(F.substr(ref, at + 1, p - at), F.lit(x + REFERENCE[p + g :]))
            tail.append(tail.pop().when((k % 3 == kind) & ((k / 3).cast("int") % len(changes) == i), made))
    seq = F.concat(head, tail[0].otherwise(F.substr(ref, at + 1)))
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.lit("T").alias("ctype"), seq.alias("seq"))


def annotate_genomes(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan: genome rows. With both ends repaired a genome is its query."""
    done = annotate(prepare(mutated(spark, sf)), synthetic_module(), keep=False)
    return done.tables()["gen_seq"].select("query_id", "genome_id", long("genome_length").alias("genome_length"))


SQL["annotate_genomes"] = _MUTATED + "SELECT query_id, sha1(nt) AS genome_id, length(nt) AS genome_length FROM s"


def annotate_products(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan: product rows."""
    return annotate(prepare(mutated(spark, sf)), synthetic_module(), keep=False).tables()["seq"]


#: The copies with their change: where (p), what is put in (x) and how much left out (g), and each product's bases.
_PLACED = f"""
WITH k AS (SELECT c_custkey AS k, CAST(20 + c_custkey % 30 AS BIGINT) AS a, c_custkey % 3 AS kind, c_custkey // 3 AS i, '{REFERENCE}' AS r FROM customer),
c(kind, i, p, x, g) AS (VALUES {", ".join(f"(1, {i}, {p}, '{x}', 0)" for i, (p, x) in enumerate(PUT_IN))}, {", ".join(f"(2, {i}, {p}, '', {g})" for i, (p, g) in enumerate(LEFT_OUT))}),
m AS (SELECT k, a, CAST(coalesce(p, 0) AS BIGINT) AS p, coalesce(x, '') AS x, CAST(coalesce(g, 0) AS BIGINT) AS g, substr(r, 1, a - 1) || translate(substr(r, a, 1), 'ACGT', 'CGTA') || substr(r, a + 1) AS r
      FROM k LEFT JOIN c ON c.kind = k.kind AND c.i = k.i % CASE k.kind WHEN 1 THEN {len(PUT_IN)} ELSE {len(LEFT_OUT)} END),
o AS (SELECT CAST(k AS VARCHAR) AS query_id, k, p, x, g, CASE WHEN p = 0 THEN r ELSE substr(r, 1, p) || x || substr(r, p + g + 1) END AS nt FROM m),
s AS (SELECT *, 'whole' AS product_name, p - 4 AS site, substr(nt, 5, 114 + length(x) - g) AS cds FROM o UNION ALL SELECT *, 'spliced', p - 19, substr(nt, 5, 30) || substr(nt, 50, 51 + length(x) - g) FROM o),
t AS (SELECT *, {sql_aminos('cds')} AS aa FROM s),
u AS (SELECT *, CASE WHEN list_contains(aa, '*') THEN list_position(aa, '*') ELSE len(aa) END AS n FROM t),
q AS (SELECT *, array_to_string(aa[1:n], '') AS aa_seq, substr(cds, 1, 3 * n) AS cds_seq FROM u) """


def _tables(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the whole plan, without the product that slips."""
    return annotate(prepare(placed(spark, sf)), synthetic_module(), keep=False).tables()[name].filter("product_name <> 'slip'")


def annotate_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan, P14 and F10: bases and residues of each product with their names."""
    return _tables(spark, sf, "seq").select("query_id", "reference_id", "product_name", "variant_hash", "aa_seq", "cds_id", "cds_seq", "has_insertion", "has_shift_indel")


SQL["annotate_sequences"] = _PLACED + "SELECT query_id, 'S1' AS reference_id, product_name, md5(aa_seq) AS variant_hash, aa_seq, sha1(cds_seq) AS cds_id, cds_seq, x <> '' AND 3 * n > site AS has_insertion, false AS has_shift_indel FROM q"


def annotate_insertions(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan, P15 and F7: the insertions before a product's end."""
    numbers = [long(c).alias(c) for c in ("upstream_aa_pos", "upstream_nt_pos", "codon_shift")]
    return _tables(spark, sf, "ins").select("query_id", "ctype", "reference_id", "product_name", "inserted_nt", "inserted_aa", *numbers)


SQL["annotate_insertions"] = _PLACED + f"""SELECT query_id, 'T' AS ctype, 'S1' AS reference_id, product_name, x AS inserted_nt, array_to_string({sql_aminos('x')}, '') AS inserted_aa,
CAST(site // 3 AS BIGINT) AS upstream_aa_pos, CAST(site AS BIGINT) AS upstream_nt_pos, CAST(0 AS BIGINT) AS codon_shift FROM q WHERE x <> '' AND 3 * n > site"""


def annotate_deletions(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan, P16 and D11: the deletions before a product's end."""
    numbers = [long(c).alias(c) for c in ("del_aa_start", "del_aa_end", "del_aa_len", "del_cds_start", "del_cds_end", "del_cds_len")]
    return _tables(spark, sf, "del").select("query_id", "ctype", "reference_id", "product_name", "variant_hash", "cds_id", "in_frame", *numbers)


SQL["annotate_deletions"] = _PLACED + """SELECT query_id, 'T' AS ctype, 'S1' AS reference_id, product_name, md5(aa_seq) AS variant_hash, sha1(cds_seq) AS cds_id, true AS in_frame, CAST(site // 3 + 1 AS BIGINT) AS del_aa_start,
CAST((site + g) // 3 AS BIGINT) AS del_aa_end, CAST(g // 3 AS BIGINT) AS del_aa_len, CAST(site + 1 AS BIGINT) AS del_cds_start, CAST(site + g AS BIGINT) AS del_cds_end, CAST(g AS BIGINT) AS del_cds_len FROM q WHERE g > 0 AND 3 * n > site"""


def reread_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The six tables written in one pass and read again with their types, one row for each
    of theirs: its place and size, and what tells it."""
    folder = new_folder(spark, "tables")
    write_together(table_lines(prepare(placed(spark, sf)), synthetic_module()), folder)
    t, none = read_together(spark, folder), F.lit(0)
    shown = {
        "seq": (none, F.length("cds_seq"), F.concat_ws(" ", "kind", "variant_hash", "cds_id", "has_insertion", "has_shift_indel")),
        "ins": (F.col("upstream_nt_pos"), F.length("inserted_nt"), F.concat_ws(" ", "inserted_nt", "inserted_aa", "codon_shift")),
        "del": (F.col("del_cds_start"), F.col("del_cds_len"), F.concat_ws(" ", "variant_hash", "cds_id", "in_frame")),
        "gen_seq": (none, F.col("genome_length"), F.concat_ws(" ", "genome_id", "has_insertion", "genome_aln")),
        "gen_ins": (F.col("upstream_nt_pos"), F.length("inserted_nt"), F.col("inserted_nt")),
        "gen_del": (F.col("del_start"), F.col("del_len"), F.col("del_end").cast("string")),
    }
    out = None
    for name, (place, size, told) in shown.items():
        product = F.col("product_name") if "product_name" in t[name].columns else F.lit("")
        rows = t[name].select(F.lit(name).alias("result_table"), "query_id", "ctype", "reference_id", product.alias("product_name"), long(place).alias("place"), long(size).alias("size"), told.alias("told"))
        rows = rows.filter("product_name <> 'slip'")
        out = rows if out is None else out.unionByName(rows)
    return out


SQL["reread_tables"] = _PLACED + f""", w(result_table, query_id, product_name, place, size, told) AS (
SELECT 'seq', query_id, product_name, 0, length(cds_seq), 'data ' || md5(aa_seq) || ' ' || sha1(cds_seq) || ' ' || CASE WHEN x <> '' AND 3 * n > site THEN 'true' ELSE 'false' END || ' false' FROM q
UNION ALL SELECT 'ins', query_id, product_name, site, length(x), x || ' ' || array_to_string({sql_aminos('x')}, '') || ' 0' FROM q WHERE x <> '' AND 3 * n > site
UNION ALL SELECT 'del', query_id, product_name, site + 1, g, md5(aa_seq) || ' ' || sha1(cds_seq) || ' true' FROM q WHERE g > 0 AND 3 * n > site
UNION ALL SELECT 'gen_seq', query_id, '', 0, length(nt), sha1(nt) || ' ' || CASE WHEN x <> '' THEN 'true' ELSE 'false' END || ' ' || CASE WHEN x <> '' THEN substr(nt, 1, p) || substr(nt, p + length(x) + 1) WHEN g > 0 THEN substr(nt, 1, p) || repeat('-', g) || substr(nt, p + 1) ELSE nt END FROM o
UNION ALL SELECT 'gen_ins', query_id, '', p, length(x), x FROM o WHERE x <> ''
UNION ALL SELECT 'gen_del', query_id, '', p + 1, g, CAST(p + g AS VARCHAR) FROM o WHERE g > 0)
SELECT result_table, query_id, 'T' AS ctype, 'S1' AS reference_id, product_name, CAST(place AS BIGINT) AS place, CAST(size AS BIGINT) AS size, told FROM w"""


def _best(rows: DataFrame) -> DataFrame:
    return rows.select("query_id", long("ref_index").alias("ref_index"), long("score").alias("score"), "cigar", long("q_start").alias("q_start"), long("q_end").alias("q_end"), long("r_start").alias("r_start"), long("r_end").alias("r_end"))


def align_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best alignment of each query, and its two ends after repair."""
    return _best(aligned_states(prepare(placed(spark, sf)), synthetic_module()))


SQL["align_best"] = _PLACED + f"""SELECT query_id, CAST(0 AS BIGINT) AS ref_index, CAST(14 * ({len(REFERENCE) - 1} - g) - 1 - CASE WHEN p > 0 THEN 39 + length(x) + g ELSE 0 END AS BIGINT) AS score,
CASE WHEN p = 0 THEN '{len(REFERENCE)}M' WHEN g = 0 THEN p || 'M' || length(x) || 'I' || ({len(REFERENCE)} - p) || 'M' ELSE p || 'M' || g || 'D' || ({len(REFERENCE)} - p - g) || 'M' END AS cigar,
CAST(0 AS BIGINT) AS q_start, CAST(length(nt) AS BIGINT) AS q_end, CAST(0 AS BIGINT) AS r_start, CAST({len(REFERENCE)} AS BIGINT) AS r_end FROM o"""


def align_known(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy aligns end to end with the first reference; the score where the change is known to be
    the best alignment: one base changed, and bases only left out or only put in."""
    k = F.col("query_id").cast("int")
    one_kind = (k % 5 == 0) | (k % 3 == 0)
    shown = _best(aligned_states(prepare(mutated(spark, sf)), synthetic_module())).withColumn("score", F.when(one_kind, F.col("score")))
    return shown.select("query_id", "ref_index", "score", "q_start", "q_end", "r_start", "r_end")


SQL["align_known"] = _MUTATED + f""", t AS (SELECT *, CAST(query_id AS BIGINT) % 5 AS i, CAST(query_id AS BIGINT) % 3 * 3 AS g FROM s)
SELECT query_id, CAST(0 AS BIGINT) AS ref_index, CASE WHEN i = 0 OR g = 0 THEN CAST(14 * ({len(REFERENCE) - 1} - g) - 1 - CASE WHEN i + g > 0 THEN 40 + i + g - 1 ELSE 0 END AS BIGINT) END AS score,
       CAST(0 AS BIGINT) AS q_start, length(nt) AS q_end, CAST(0 AS BIGINT) AS r_start, CAST({len(REFERENCE)} AS BIGINT) AS r_end FROM t"""


def annotate_indels(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan: bases put in less those left out, from the rows of genomes; each by itself where only one is."""
    done = annotate(prepare(mutated(spark, sf)), synthetic_module(), keep=False)
    k = F.col("query_id").cast("int")
    out = F.length("genome_aln") - F.length(F.replace("genome_aln", F.lit("-"), F.lit("")))
    put = F.col("genome_length") - (F.length("genome_aln") - out)
    one_kind = (k % 5 == 0) | (k % 3 == 0)
    rows = done.tables()["gen_seq"]
    return rows.select("query_id", long(put - out).alias("net"), long(F.when(one_kind, put)).alias("put_in"), long(F.when(one_kind, out)).alias("left_out"))


SQL["annotate_indels"] = _MUTATED + """, t AS (SELECT query_id, CAST(query_id AS BIGINT) % 5 AS i, CAST(query_id AS BIGINT) % 3 * 3 AS g FROM s)
SELECT query_id, i - g AS net, CASE WHEN i = 0 OR g = 0 THEN i END AS put_in, CASE WHEN i = 0 OR g = 0 THEN g END AS left_out FROM t"""


def fix_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Deletions of a codon that begin within one move to a border of it. Without weights one of shift 1 goes left
    by one and one of shift 2 right by one."""
    k = F.col("o_orderkey").cast("int")
    at = 6 + k % 12
    none = F.lit(None).cast("int")
    parts = [("M", F.lit(0), at, F.lit(0), at), ("D", none, none, at, at + 3), ("M", at, F.lit(27), at + 3, F.lit(30))]
    states = F.array(*[F.struct(F.lit(op).alias("op"), *[x.alias(n) for x, n in zip(p, ("q_start", "q_end", "c_start", "c_end"), strict=True)]) for op, *p in parts]).cast(CDS_STATES)
    fixed = fix_frames_udf({("R", "T", "P"): ProductShape()})(states, nt_of(F.col("o_orderkey")), F.lit("R"), F.lit("T"), F.lit("P"))
    rows = table(spark, sf, "orders").select("o_orderkey", fixed.alias("s"))
    return rows.select("o_orderkey", long(F.element_at("s", 2)["c_start"]).alias("del_start"), long(F.element_at("s", 1)["q_end"]).alias("left_end"), long(F.element_at("s", 3)["c_start"]).alias("right_start"))


SQL["fix_frames"] = """
WITH s AS (SELECT o_orderkey, CAST(6 + o_orderkey % 12 AS BIGINT) AS a FROM orders), t AS (SELECT o_orderkey, CASE a % 3 WHEN 1 THEN a - 1 WHEN 2 THEN a + 1 ELSE a END AS m FROM s)
SELECT o_orderkey, m AS del_start, m AS left_end, m + 3 AS right_start FROM t"""


def rewrite_deletions(spark: SparkSession, sf: str) -> DataFrame:
    """Deletions at a rule's place go where it says, if the match there is longer than the way."""
    k = F.col("o_orderkey").cast("int")
    at = 6 + k % 12
    none = F.lit(None).cast("int")
    parts = [("M", F.lit(0), at, F.lit(0), at), ("D", none, none, at, at + 3), ("M", at, F.lit(27), at + 3, F.lit(30))]
    states = F.array(*[F.struct(F.lit(op).alias("op"), *[x.alias(n) for x, n in zip(p, ("q_start", "q_end", "r_start", "r_end"), strict=True)]) for op, *p in parts]).cast(STATES)
    rules = {("R", "T"): [Rule(7, 10, 0, 3), Rule(9, 12, 4, 7), Rule(14, 17, 20, 23)]}
    rows = table(spark, sf, "orders").select("o_orderkey", rewrite_udf(rules)(states, F.lit("R"), F.lit("T")).alias("s"))
    return rows.select("o_orderkey", long(F.element_at("s", 2)["r_start"]).alias("del_start"), long(F.element_at("s", 1)["q_end"]).alias("left_end"))


SQL["rewrite_deletions"] = """
WITH s AS (SELECT o_orderkey, CAST(6 + o_orderkey % 12 AS BIGINT) AS a FROM orders), t AS (SELECT o_orderkey, CASE a WHEN 9 THEN 4 WHEN 14 THEN 20 ELSE a END AS m FROM s)
SELECT o_orderkey, CAST(m AS BIGINT) AS del_start, CAST(m AS BIGINT) AS left_end FROM t"""
