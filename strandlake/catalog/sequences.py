"""Sanitising, translating and naming of sequences; rules on ends; formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.catalog.base import IUPAC16, long, nt_of, sql_amino, sql_aminos, sql_nt, table
from strandlake.functions import coords, iupac
from strandlake.operators import ends
from strandlake.sources import config, queries as readers
from strandlake.sources.sections import carried
from strandlake.sources.tables import formatted, kind_of

SQL: dict[str, str] = {}


def sanitize_seq(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw sequences; rows without nucleotides dropped."""
    made = table(spark, sf, "documents").select("doc_id", iupac.sanitize_seq(F.col("text")).alias("nt")).filter(F.length("nt") > 0)
    return made.select("doc_id", long(F.length("nt")).alias("n"), iupac.genome_id(F.col("nt")).alias("nt_sha1"))


SQL["sanitize_seq"] = """
WITH s AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'EFIJLOPQXZ', 'NNNNNNNNNN') AS nt FROM documents)
SELECT doc_id, length(nt) AS n, sha1(nt) AS nt_sha1 FROM s WHERE length(nt) > 0"""


def sanitize_id(spark: SparkSession, sf: str) -> DataFrame:
    """Tabs of an id."""
    name = F.concat(F.lit("q\t"), F.col("o_orderkey").cast("string"), F.lit("\t"), F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", iupac.sanitize_id(name).alias("query_id"))


SQL["sanitize_id"] = "SELECT o_orderkey, replace('q' || chr(9) || CAST(o_orderkey AS VARCHAR) || chr(9) || o_orderstatus, chr(9), ' ') AS query_id FROM orders"


def reverse_complement(spark: SparkSession, sf: str) -> DataFrame:
    """P4."""
    return table(spark, sf, "orders").select("o_orderkey", iupac.reverse_complement(nt_of(F.col("o_orderkey"), letters=IUPAC16)).alias("rc"))


SQL["reverse_complement"] = f"SELECT o_orderkey, translate(reverse({sql_nt('o_orderkey', letters=IUPAC16)}), 'ACGTURYSWKMBDHVN', 'TGCAAYRSWMKVHDBN') AS rc FROM orders"


def translate_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Whole codons."""
    return table(spark, sf, "orders").select("o_orderkey", iupac.translate_exact(nt_of(F.col("o_orderkey"))).alias("aa"))


SQL["translate_exact"] = f"WITH s AS (SELECT o_orderkey, {sql_nt('o_orderkey')} AS nt FROM orders) SELECT o_orderkey, list_aggregate({sql_aminos('nt')}, 'string_agg', '') AS aa FROM s"


def translate_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps, padding and one or two bases at the end."""
    k = F.col("o_orderkey")
    seq = F.concat(F.repeat(F.lit("."), (k % 5).cast("int")), F.substr(nt_of(k), F.lit(1), (20 + k % 7).cast("int")), F.repeat(F.lit("-"), (k % 4).cast("int")), F.lit("AC"))
    return table(spark, sf, "orders").select("o_orderkey", iupac.translate_partial(seq).alias("aa"))


SQL["translate_partial"] = f"""
WITH s AS (SELECT o_orderkey, repeat('.', CAST(o_orderkey % 5 AS BIGINT)) || substr({sql_nt('o_orderkey')}, 1, CAST(20 + o_orderkey % 7 AS BIGINT)) || repeat('-', CAST(o_orderkey % 4 AS BIGINT)) || 'AC' AS seq FROM orders)
SELECT o_orderkey, list_aggregate({sql_aminos('seq')}, 'string_agg', '') || CASE WHEN length(seq) % 3 > 0 THEN '~' ELSE '' END AS aa FROM s"""


def first_stop_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Amino acids up to the first stop, and where it is."""
    nt = nt_of(F.col("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(iupac.until_stop(iupac.amino_list(nt)), "").alias("aa"), long(iupac.next_stop(nt)).alias("stop_at"))


SQL["first_stop_prefix"] = f"""
WITH s AS (SELECT o_orderkey, {sql_nt('o_orderkey')} AS nt FROM orders), t AS (SELECT o_orderkey, list_aggregate({sql_aminos('nt')}, 'string_agg', '') AS aa FROM s)
SELECT o_orderkey, CASE WHEN instr(aa, '*') > 0 THEN substr(aa, 1, instr(aa, '*')) ELSE aa END AS aa,
       CASE WHEN instr(aa, '*') > 0 THEN CAST(3 * (instr(aa, '*') - 1) AS BIGINT) END AS stop_at FROM t"""


def first_last_codon(spark: SparkSession, sf: str) -> DataFrame:
    """T5, T6 and T9, on slices of up to five bases."""
    piece = F.substr(nt_of(F.col("l_orderkey"), letters=IUPAC16), F.lit(1), (F.col("l_linenumber") - 1).cast("int"))
    first, last = iupac.first_codon(piece), iupac.last_codon(piece)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", iupac.plain(first).alias("first_codon"), iupac.plain(last).alias("last_codon"), F.coalesce(iupac.is_stop(last), F.lit(False)).alias("stops")).distinct()


SQL["first_last_codon"] = f"""
WITH s AS (SELECT l_orderkey, l_linenumber, substr({sql_nt('l_orderkey', letters=IUPAC16)}, 1, CAST(l_linenumber - 1 AS BIGINT)) AS p FROM lineitem)
SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN length(p) >= 3 THEN replace(substr(p, 1, 3), 'U', 'T') END AS first_codon,
       CASE WHEN length(p) >= 3 THEN replace(right(p, 3), 'U', 'T') END AS last_codon,
       length(p) >= 3 AND (replace(right(p, 3), 'U', 'T') IN ('TAA', 'TAG', 'TGA') OR replace(right(p, 3), 'U', 'T') IN ('TAR', 'TRA')) AS stops FROM s"""


def sha1_md5_ids(spark: SparkSession, sf: str) -> DataFrame:
    """T11 and T12."""
    nt = nt_of(F.col("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", iupac.genome_id(nt).alias("cds_id"), iupac.variant_hash(iupac.translate_partial(nt)).alias("variant_hash"))


SQL["sha1_md5_ids"] = f"""
WITH s AS (SELECT o_orderkey, {sql_nt('o_orderkey')} AS nt FROM orders)
SELECT o_orderkey, sha1(nt) AS cds_id, md5(list_aggregate({sql_aminos('nt')}, 'string_agg', '') || '~') AS variant_hash FROM s"""


def ctype_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Given, classified, or the default; rows that can't be told are dropped."""
    o = table(spark, sf, "orders")
    given = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    told = F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("C_"), F.col("o_orderstatus")))
    status = F.when(F.col("o_orderkey") % 7 == 5, "chimeric").otherwise("classified")
    return o.filter(given.isNotNull() | (status == "classified")).select("o_orderkey", F.coalesce(given, told, F.lit("default")).alias("ctype"))


SQL["ctype_resolution"] = """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, CASE WHEN o_orderkey % 3 = 1 THEN 'C_' || o_orderstatus END, 'default') AS ctype
FROM orders WHERE (o_orderkey % 3 = 0 AND o_orderpriority IS NOT NULL) OR NOT (o_orderkey % 7 = 5)"""


def chew_offset(spark: SparkSession, sf: str) -> DataFrame:
    """P5 and O4."""
    nt = F.concat(nt_of(F.col("o_orderkey")), nt_of(F.col("o_orderkey"), "-1"), nt_of(F.col("o_orderkey"), "-2"))
    return table(spark, sf, "orders").select("o_orderkey", long(ends.chew_offset(nt, (40 + F.col("o_orderkey") % 60).cast("int"), F.lit(True))).alias("chewed"))


SQL["chew_offset"] = f"""
WITH s AS (SELECT o_orderkey, {sql_nt('o_orderkey')} || {sql_nt('o_orderkey', '-1')} || {sql_nt('o_orderkey', '-2')} AS nt, 40 + o_orderkey % 60 AS m FROM orders)
SELECT o_orderkey, CAST(CASE WHEN length(nt) > m AND instr(nt, 'ATG') > 0 AND length(nt) - instr(nt, 'ATG') + 1 >= m THEN instr(nt, 'ATG') - 1 ELSE 0 END AS BIGINT) AS chewed FROM s"""


def repair_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of an alignment from the columns of a line."""
    k, n = F.col("l_orderkey").cast("int"), F.col("l_linenumber").cast("int")
    q_start, r_start = k % 13, k % 17
    made = ends.repaired(q_start, q_start + 50 + n, r_start, r_start + 50 + n, F.lit(75), F.lit(80), F.lit(9))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[long(made[c]).alias(c) for c in ("q_start", "q_end", "r_start", "r_end")])


SQL["repair_ends"] = """
WITH s AS (SELECT l_orderkey, l_linenumber, l_orderkey % 13 AS qs, l_orderkey % 17 AS rs, l_orderkey % 13 + 50 + l_linenumber AS qe, l_orderkey % 17 + 50 + l_linenumber AS re FROM lineitem),
t AS (SELECT *, CASE WHEN rs <= 9 THEN least(qs, rs) ELSE 0 END AS a, CASE WHEN 80 - re <= 9 THEN least(75 - qe, 80 - re) ELSE 0 END AS b FROM s)
SELECT l_orderkey, l_linenumber, CAST(qs - a AS BIGINT) AS q_start, CAST(qe + b AS BIGINT) AS q_end, CAST(rs - a AS BIGINT) AS r_start, CAST(re + b AS BIGINT) AS r_end FROM t"""


def stop_extension(spark: SparkSession, sf: str) -> DataFrame:
    """Queries that go on after the end of the reference."""
    nt = F.concat(nt_of(F.col("o_orderkey")), nt_of(F.col("o_orderkey"), "-1"))
    end = (9 + 3 * (F.col("o_orderkey") % 15)).cast("int")
    made = ends.stop_extension(nt, F.lit(0), end, F.when(F.col("o_orderkey") % 4 == 0, 29).otherwise(30), F.lit(30), F.lit(True))
    return table(spark, sf, "orders").select("o_orderkey", long(made).alias("stop_end"))


SQL["stop_extension"] = f"""
WITH s AS (SELECT o_orderkey, {sql_nt('o_orderkey')} || {sql_nt('o_orderkey', '-1')} AS nt, CAST(9 + 3 * (o_orderkey % 15) AS BIGINT) AS e FROM orders),
t AS (SELECT *, list_aggregate({sql_aminos("substr(nt, e + 1)")}, 'string_agg', '') AS aa FROM s)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 AND length(nt) - e >= 3 AND substr(nt, e - 2, 3) NOT IN ('TAA', 'TAG', 'TGA') AND instr(aa, '*') > 0
       THEN CAST(e + 3 * instr(aa, '*') AS BIGINT) END AS stop_end FROM t"""


def tsv_parse(spark: SparkSession, sf: str) -> DataFrame:
    """S3 and F9 on generated lines of two, three and four columns, and blank ones."""
    k = F.col("o_orderkey")
    line = F.when(k % 5 == 0, F.lit("  ")).when(k % 5 == 1, F.concat_ws("\t", F.concat(F.lit(" id"), k), nt_of(k))).when(k % 5 == 2, F.concat_ws("\t", F.concat(F.lit("id"), k), F.lit(" T "), nt_of(k))).otherwise(F.concat_ws("\t", F.concat(F.lit("id"), k), F.col("o_orderstatus"), nt_of(k), F.lit("more")))
    return readers.parse_lines(table(spark, sf, "orders").select(line.alias("value")))


SQL["tsv_parse"] = f"""
SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 5 = 1 THEN NULL WHEN o_orderkey % 5 = 2 THEN 'T' ELSE o_orderstatus END AS ctype, {sql_nt('o_orderkey')} AS seq
FROM orders WHERE o_orderkey % 5 <> 0"""


def fasta_header_parse(spark: SparkSession, sf: str) -> DataFrame:
    """S2 and P19 on generated headers."""
    k = F.col("o_orderkey").cast("string")
    header = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" id "), k)).when(F.col("o_orderkey") % 3 == 1, F.concat(k, F.lit(" | "), F.col("o_orderstatus"))).otherwise(F.concat(k, F.lit("|T|x|y")))
    return readers.parse_fasta_header(table(spark, sf, "orders").select(header.alias("header"), nt_of(F.col("o_orderkey")).alias("seq")))


SQL["fasta_header_parse"] = f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN ' id ' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS id,
       CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus WHEN o_orderkey % 3 = 2 THEN 'T' END AS ctype, {sql_nt('o_orderkey')} AS seq FROM orders"""


def coord_format(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of an order as ranges and points."""
    s = F.col("l_linenumber").cast("int") * 10
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.struct(s.alias("start"), F.when(F.col("l_linenumber") % 3 > 0, s + F.col("l_quantity").cast("int")).alias("end"), "l_linenumber").alias("r"))
    return rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("r")).alias("r")).select("l_orderkey", coords.format_ranges(F.col("r")).alias("coordinates"))


SQL["coord_format"] = """
SELECT l_orderkey, string_agg(CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_linenumber * 10 + 1 AS VARCHAR) || '..' || CAST(l_linenumber * 10 + CAST(l_quantity AS INT) AS VARCHAR)
       ELSE CAST(l_linenumber * 10 AS VARCHAR) END, ';' ORDER BY l_linenumber, l_quantity) AS coordinates FROM lineitem GROUP BY l_orderkey"""


def coord_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Text to half-open ranges."""
    k = F.col("o_orderkey")
    text = F.concat((k % 90 + 1).cast("string"), F.lit(".."), (k % 90 + 9).cast("string"), F.lit(";"), (k % 90 + 9).cast("string"), F.lit(";"), (k % 90 + 20).cast("string"), F.lit(".."), (k % 90 + 20).cast("string"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.posexplode(coords.parse_ranges(text)).alias("pos", "r"))
    return rows.select("o_orderkey", long("pos").alias("pos"), long("r.start").alias("start"), long("r.end").alias("end"))


SQL["coord_parse"] = """
WITH s AS (SELECT o_orderkey, o_orderkey % 90 AS k FROM orders)
SELECT o_orderkey, CAST(0 AS BIGINT) AS pos, CAST(k AS BIGINT) AS start, CAST(k + 9 AS BIGINT) AS "end" FROM s
UNION ALL SELECT o_orderkey, 1, k + 9, NULL FROM s UNION ALL SELECT o_orderkey, 2, k + 19, k + 20 FROM s"""


def right_padding(spark: SparkSession, sf: str) -> DataFrame:
    """P9 and T10."""
    return table(spark, sf, "orders").select("o_orderkey", F.concat(nt_of(F.col("o_orderkey")), F.repeat(F.lit("."), (F.col("o_orderkey") % 9).cast("int"))).alias("aln"))


SQL["right_padding"] = f"SELECT o_orderkey, {sql_nt('o_orderkey')} || repeat('.', CAST(o_orderkey % 9 AS BIGINT)) AS aln FROM orders"


def null_marker_format(spark: SparkSession, sf: str) -> DataFrame:
    """K6: lines of the deletion table, with nulls and empty values as markers."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.cast("string").alias("query_id"), F.lit("T").alias("ctype"), F.lit("R").alias("reference_id"), F.lit("P").alias("product_name"), F.when(k % 2 == 0, F.md5(k.cast("string").cast("binary"))).alias("variant_hash"),
        *[F.lit(i).alias(c) for i, c in enumerate(("del_aa_start", "del_aa_end", "del_aa_len"))], (k % 3 == 0).alias("in_frame"), F.when(k % 2 == 0, F.lit("")).alias("cds_id"), *[F.lit(i).alias(c) for i, c in enumerate(("del_cds_start", "del_cds_end", "del_cds_len"))],
    )
    return formatted(rows, "del").withColumnRenamed("value", "line")


SQL["null_marker_format"] = r"""
SELECT concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), 'T', 'R', 'P', CASE WHEN o_orderkey % 2 = 0 THEN md5(CAST(o_orderkey AS VARCHAR)) ELSE '\N' END, '0', '1', '2',
       CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END, '\N', '0', '1', '2') AS line FROM orders"""


def seq_row_kind(spark: SparkSession, sf: str) -> DataFrame:
    """The kind of a product row by its nulls."""
    k = F.col("o_orderkey")
    own = ("variant_hash", "aa_seq", "cds_id", "cds_seq", "query_coordinates", "cds_coordinates")
    rows = table(spark, sf, "orders").select("o_orderkey", *[F.when(k % 4 == 0, "x").alias(c) for c in own], *[F.when(k % 4 < 2, "x").alias(c) for c in ("aa_aln", "cds_aln")])
    rows = rows.withColumn("aa_seq", F.when(k % 20 == 3, "odd").otherwise(F.col("aa_seq")))
    return rows.select("o_orderkey", kind_of().alias("kind"))


SQL["seq_row_kind"] = "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'data' WHEN o_orderkey % 4 = 1 THEN 'deleted' WHEN o_orderkey % 20 = 3 THEN NULL ELSE 'empty' END AS kind FROM orders"


def codon_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """T14, T15, T16 and F13."""
    codon = F.lower(F.substr(nt_of(F.col("o_orderkey"), letters="ACGTRYSWKMXZ-.NU"), F.lit(1), F.lit(3)))
    return table(spark, sf, "orders").select("o_orderkey", iupac.codon_normalised(codon).alias("codon"), iupac.required_start(codon).alias("start"), iupac.valid_dna(F.upper(codon)).alias("valid"))


SQL["codon_normalise"] = f"""
WITH s AS (SELECT o_orderkey, substr({sql_nt('o_orderkey', letters='ACGTRYSWKMXZ-.NU')}, 1, 3) AS c FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(c, '[ACGTURYSWKMBDHVN]{{3}}') THEN replace(c, 'U', 'T') END AS codon,
       CASE WHEN regexp_full_match(c, '[ACGTU]{{3}}') THEN replace(c, 'U', 'T') END AS start, regexp_full_match(c, '[ACGTURYSWKMBDHVN]+') AS valid FROM s"""


def codon_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every codon of the plain code that the suppliers' keys give, and its amino acid; ambiguous ones that one
    reading resolves are left to the unit tests."""
    codon = F.substr(nt_of(F.col("s_suppkey")), F.lit(1), F.lit(3))
    return table(spark, sf, "supplier").select(codon.alias("codon"), iupac.amino(codon).alias("aa")).distinct()


SQL["codon_table"] = f"WITH s AS (SELECT DISTINCT substr({sql_nt('s_suppkey')}, 1, 3) AS codon FROM supplier) SELECT codon, {sql_amino('codon')} AS aa FROM s"


def header_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Section headers carried down to the rows of their section, over blocks of a hundred orders."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    lines = rows.select("*", (F.col("l_orderkey") % 5).alias("file"), F.floor(F.col("l_orderkey") / 100).alias("block"), F.struct("l_orderkey", "l_linenumber").alias("at"))
    header = F.when((F.col("l_partkey") % 97 == 0) | ((F.col("file") == 1) & (F.col("l_partkey") % 3 == 0)), F.concat(F.lit("#"), F.col("l_partkey").cast("string")))
    return carried(lines, header).select("l_orderkey", "l_linenumber", "section")


SQL["header_forward_fill"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, last_value(CASE WHEN p % 97 = 0 OR (l_orderkey % 5 = 1 AND p % 3 = 0) THEN '#' || CAST(p AS VARCHAR) END IGNORE NULLS)
       OVER (PARTITION BY l_orderkey % 5 ORDER BY l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM r"""



def module_name_match(spark: SparkSession, sf: str) -> DataFrame:
    """The module that a name or alternative name stands for, ignoring case; null without one. Names are a
    small table, which rows are joined to."""
    made = [config.ModuleConfig(name, None, "-", "-", {}, alternative_names=others) for name, others in (("First", ("nation_0", "NATION_4")), ("Nation_7", ()), ("last", ("Nation_21",)))]
    every = {x.lower() for m in made for x in (m.name, *m.alternative_names)}
    known = spark.createDataFrame([(x, config.find_module(made, x.upper()).name) for x in sorted(every)], "name string, module string")
    return table(spark, sf, "nation").withColumn("name", F.lower("n_name")).join(known, "name", "left").select("n_nationkey", "module")


SQL["module_name_match"] = """
SELECT n_nationkey, CASE WHEN lower(n_name) IN ('first', 'nation_0', 'nation_4') THEN 'First' WHEN lower(n_name) = 'nation_7' THEN 'Nation_7' WHEN lower(n_name) IN ('last', 'nation_21') THEN 'last' END AS module FROM nation"""



def modulo_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the remainder of their index, counted."""
    task = long(F.pmod("o_orderkey", F.lit(10))).alias("task")
    return table(spark, sf, "orders").groupBy(task).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


SQL["modulo_partition"] = """
SELECT t.task, count(o_orderkey) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM (SELECT unnest(range(10)) AS task) t LEFT JOIN orders ON o_orderkey % 10 = t.task GROUP BY 1"""


def config_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A range for each line, parsed from its text; null where it isn't one."""
    text = F.concat_ws("..", F.col("l_linenumber") - 1, F.col("l_partkey") % 9).alias("text")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text)
    r = F.get(coords.try_parse_ranges(F.col("text")), 0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "text", long(r["start"]).alias("start"), long(r["end"]).alias("end"))


SQL["config_ranges"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber - 1 AS a, l_partkey % 9 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, a || '..' || b AS text, CASE WHEN 1 <= a AND a <= b THEN CAST(a - 1 AS BIGINT) END AS start, CASE WHEN 1 <= a AND a <= b THEN CAST(b AS BIGINT) END AS "end" FROM r"""
