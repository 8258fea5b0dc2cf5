"""Joins, aggregations, windows and range algebra on relations derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.catalog.base import dealt, long, nt_of, sql_aminos, sql_nt, table
from strandlake.functions.indels import deletion_metrics, eligible_for_shift, insertion_metrics, reported_insertion
from strandlake.functions.ranges import Range, point_in_codons
from strandlake.operators import states as st
from strandlake.operators.frames import USUAL_CODONS
from strandlake.operators.intervals import interval_join, nearest_regions
from strandlake.operators.materialize import genome_rows, materialize_products, product_rows, spliced
from strandlake.plans import tables
from strandlake.plans.annotate import unimplemented_by_module as by_module
from strandlake.schema import CDS_STATES, EXON
from strandlake.sources.config import ModuleConfig, Penalties

SQL: dict[str, str] = {}


def _two_ranges(spark: SparkSession, sf: str) -> tuple[DataFrame, Range, Range, Column]:
    """Distinct pairs of small ranges from the columns of lines."""
    a, b, n = (F.col("l_orderkey") % 12).cast("int"), (F.col("l_partkey") % 12).cast("int"), F.col("l_linenumber").cast("int")
    rows = table(spark, sf, "lineitem").select(a.alias("a0"), (a + 1 + n % 4).alias("a1"), b.alias("b0"), (b + 1 + n % 3).alias("b1")).distinct()
    return rows, Range(F.col("a0"), F.col("a1")), Range(F.col("b0"), F.col("b1")), F.col("b0")


_TWO = "WITH r AS (SELECT DISTINCT l_orderkey % 12 AS a0, l_orderkey % 12 + 1 + l_linenumber % 4 AS a1, l_partkey % 12 AS b0, l_partkey % 12 + 1 + l_linenumber % 3 AS b1 FROM lineitem) "


def _keys(*more: Column) -> list[Column]:
    return [*(long(c).alias(c) for c in ("a0", "a1", "b0", "b1")), *more]


_SQL_KEYS = "CAST(a0 AS BIGINT) AS a0, CAST(a1 AS BIGINT) AS a1, CAST(b0 AS BIGINT) AS b0, CAST(b1 AS BIGINT) AS b1"


def range_intersect(spark: SparkSession, sf: str) -> DataFrame:
    """R1 to R7, R14 and U3."""
    rows, a, b, _ = _two_ranges(spark, sf)
    both, ordered, moved = a.intersect(b), a.intersect_ordered(b), a.moved(5).shrunk(1, 0)
    left, right = a.trimmed_to(b)
    return rows.select(*_keys(long(both.start).alias("i0"), long(both.end).alias("i1"), long(ordered.start).alias("o0"), long(ordered.end).alias("o1"), a.overlaps(b).alias("overlaps"), a.is_superset_of(b).alias("superset"), long(moved.start).alias("m0"), long(moved.size()).alias("m_len"), long(left).alias("trim_left"), long(right).alias("trim_right")))


SQL["range_intersect"] = _TWO + f"""SELECT {_SQL_KEYS}, CASE WHEN greatest(a0, b0) < least(a1, b1) THEN CAST(greatest(a0, b0) AS BIGINT) END AS i0, CASE WHEN greatest(a0, b0) < least(a1, b1) THEN CAST(least(a1, b1) AS BIGINT) END AS i1,
CASE WHEN b0 < a1 THEN CAST(b0 AS BIGINT) END AS o0, CASE WHEN b0 < a1 THEN CAST(a1 AS BIGINT) END AS o1, a1 > b0 AND b1 > a0 AS overlaps, a0 <= b0 AND b1 <= a1 AS superset,
CAST(a0 + 6 AS BIGINT) AS m0, CAST(a1 - a0 - 1 AS BIGINT) AS m_len, CAST(b0 - a0 AS BIGINT) AS trim_left, CAST(a1 - b1 AS BIGINT) AS trim_right FROM r"""


def range_cmp(spark: SparkSession, sf: str) -> DataFrame:
    """R4, R8, R9, R10 and R13."""
    rows, a, b, p = _two_ranges(spark, sf)
    aa, shift = point_in_codons(p)
    return rows.select(*_keys(long(a.strict_cmp(b)).alias("strict"), long(a.relaxed_cmp(b)).alias("relaxed"), long(a.cmp_point(p)).alias("to_point"), a.contains_point(p).alias("inside"), long(aa).alias("aa_idx"), long(shift).alias("codon_shift")))


SQL["range_cmp"] = _TWO + f"""SELECT {_SQL_KEYS}, CAST(CASE WHEN a0 = b0 AND a1 = b1 THEN 0 WHEN a1 <= b0 THEN -1 WHEN b1 <= a0 THEN 1 END AS BIGINT) AS strict,
CAST(CASE WHEN (a0 > b0 AND a1 >= b1) OR (a0 >= b0 AND a1 > b1) THEN 1 WHEN (a0 < b0 AND a1 <= b1) OR (a0 <= b0 AND a1 < b1) THEN -1 WHEN a0 = b0 AND a1 = b1 THEN 0 END AS BIGINT) AS relaxed,
CAST(CASE WHEN b0 <= a0 THEN 1 WHEN a1 <= b0 THEN -1 END AS BIGINT) AS to_point, a0 < b0 AND b0 < a1 AS inside, CAST(b0 // 3 AS BIGINT) AS aa_idx, CAST(b0 % 3 AS BIGINT) AS codon_shift FROM r"""


def _alignments(spark: SparkSession, sf: str) -> DataFrame:
    """A CIGAR for each order from its lines: the linenumber gives the operation, the quantity its length."""
    op = F.element_at(F.array(*[F.lit(x) for x in "MIMDMXM"]), F.col("l_linenumber").cast("int"))
    part = F.struct("l_linenumber", F.concat((F.col("l_quantity").cast("int") % 9 + 1).cast("string"), op).alias("x"))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    return rows.groupBy("l_orderkey").agg(F.concat(F.lit("2S"), F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda s: s["x"]), "")).alias("cigar"))


_CIGAR = """WITH g AS (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
o AS (SELECT l_orderkey, l_linenumber AS pos, CAST(CAST(q AS INT) % 9 + 1 AS BIGINT) AS n, CASE l_linenumber WHEN 2 THEN 'I' WHEN 4 THEN 'D' ELSE 'M' END AS op FROM g),
w AS (SELECT *, op <> coalesce(lag(op) OVER (PARTITION BY l_orderkey ORDER BY pos), '-') AS fresh FROM o),
i AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY l_orderkey ORDER BY pos) AS island FROM w),
m AS (SELECT l_orderkey, island, min(op) AS op, sum(n) AS n FROM i GROUP BY 1, 2),
c AS (SELECT *, 2 + coalesce(sum(CASE WHEN op <> 'D' THEN n END) OVER b, 0) AS q0, 5 + coalesce(sum(CASE WHEN op <> 'I' THEN n END) OVER b, 0) AS r0 FROM m
      WINDOW b AS (PARTITION BY l_orderkey ORDER BY island ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT l_orderkey, CAST(island - 1 AS BIGINT) AS pos, op, CAST(n AS BIGINT) AS n, CASE WHEN op <> 'D' THEN CAST(q0 AS BIGINT) END AS q_start, CASE WHEN op <> 'D' THEN CAST(q0 + n AS BIGINT) END AS q_end,
      CAST(r0 AS BIGINT) AS r_start, CAST(r0 + CASE WHEN op = 'I' THEN 0 ELSE n END AS BIGINT) AS r_end FROM c) """


def cigar_to_states(spark: SparkSession, sf: str) -> DataFrame:
    """P11 and W1."""
    rows = _alignments(spark, sf).select("l_orderkey", F.posexplode(st.states_of(F.col("cigar"), F.lit(2), F.lit(5))).alias("pos", "s"))
    return rows.select("l_orderkey", long("pos").alias("pos"), "s.op", *[long(f"s.{c}").alias(c) for c in ("q_start", "q_end", "r_start", "r_end")])


SQL["cigar_to_states"] = _CIGAR + "SELECT l_orderkey, pos, op, q_start, q_end, r_start, r_end FROM s"


def states_to_cigar(spark: SparkSession, sf: str) -> DataFrame:
    """States back to operations with clips, for a query three bases longer."""
    rows = _alignments(spark, sf).withColumn("states", st.states_of(F.col("cigar"), F.lit(2), F.lit(5)))
    rows = rows.filter(F.exists("states", lambda s: s["op"] != "D"))
    ends = F.element_at(F.filter("states", lambda s: s["op"] != "D"), -1)["q_end"]
    return rows.select("l_orderkey", st.written_cigar(F.col("states"), ends + 3).alias("cigar"))


SQL["states_to_cigar"] = _CIGAR + "SELECT l_orderkey, '2S' || string_agg(CAST(n AS VARCHAR) || op, '' ORDER BY pos) || '3S' AS cigar FROM s GROUP BY l_orderkey HAVING bool_or(op <> 'D')"


def exon_intersect(spark: SparkSession, sf: str) -> DataFrame:
    """States with three exons, two of which share a base."""
    exons = F.from_json(F.lit('[{"ref_start":6,"ref_end":14,"cds_start":0,"cds_end":8},{"ref_start":13,"ref_end":21,"cds_start":8,"cds_end":16},{"ref_start":24,"ref_end":29,"cds_start":16,"cds_end":21}]'), f"array<{EXON}>")
    rows = _alignments(spark, sf).select("l_orderkey", F.posexplode(st.in_exons(st.states_of(F.col("cigar"), F.lit(2), F.lit(5)), exons)).alias("pos", "s"))
    return rows.select("l_orderkey", long("pos").alias("pos"), "s.op", *[long(f"s.{c}").alias(c) for c in ("q_start", "q_end", "c_start", "c_end")])


SQL["exon_intersect"] = _CIGAR + """, e(k, e0, e1, c0) AS (VALUES (1, 6, 14, 0), (2, 13, 21, 8), (3, 24, 29, 16)),
x AS (SELECT *, greatest(r_start, e0) AS lo, least(r_end, e1) AS hi FROM s JOIN e ON CASE WHEN op = 'I' THEN e0 < r_start AND r_start < e1 ELSE r_end > e0 AND e1 > r_start END)
SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY k, pos) - 1 AS pos, op, CASE WHEN op = 'I' THEN q_start ELSE q_start + lo - r_start END AS q_start, CASE WHEN op = 'I' THEN q_end ELSE q_end - (r_end - hi) END AS q_end,
       CAST(CASE WHEN op = 'I' THEN r_start - e0 + c0 ELSE lo - e0 + c0 END AS BIGINT) AS c_start, CAST(CASE WHEN op = 'I' THEN r_start - e0 + c0 ELSE hi - e0 + c0 END AS BIGINT) AS c_end FROM x"""


def condense_deletions(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of adjacent deletions become one."""
    n = F.col("l_quantity").cast("int") % 5 + 1
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"), F.min("l_partkey").alias("l_partkey"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("n", n).withColumn("c_end", F.sum("n").over(w).cast("int")).withColumn("op", F.when(F.col("l_partkey") % 3 > 0, "D").otherwise("M"))
    one = F.struct("l_linenumber", F.struct("op", F.when(F.col("op") == "M", F.col("l_linenumber").cast("int")).alias("q_start"), F.when(F.col("op") == "M", F.col("l_linenumber").cast("int") + F.col("n")).alias("q_end"), (F.col("c_end") - F.col("n")).alias("c_start"), "c_end").alias("s"))
    made = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["s"]).cast(CDS_STATES).alias("s"))
    out = made.select("l_orderkey", F.posexplode(st.condensed(F.col("s"))).alias("pos", "s"))
    return out.select("l_orderkey", long("pos").alias("pos"), "s.op", long("s.c_start").alias("c_start"), long("s.c_end").alias("c_end"))


SQL["condense_deletions"] = """
WITH g AS (SELECT l_orderkey, l_linenumber, CAST(min(l_quantity) AS INT) % 5 + 1 AS n, CASE WHEN min(l_partkey) % 3 > 0 THEN 'D' ELSE 'M' END AS op FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER w AS c1, op = 'D' AND coalesce(lag(op) OVER w, 'M') = 'D' AS joined FROM g WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
i AS (SELECT *, sum((NOT joined)::INT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS island FROM r)
SELECT l_orderkey, CAST(island - 1 AS BIGINT) AS pos, min(op) AS op, CAST(min(c1 - n) AS BIGINT) AS c_start, CAST(max(c1) AS BIGINT) AS c_end FROM i GROUP BY l_orderkey, island"""


def deletion_table(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of deletions."""
    s = (F.col("l_orderkey") % 300).cast("int")
    e = s + F.col("l_quantity").cast("int")
    made = {k: long(v) if k != "in_frame" else v for k, v in deletion_metrics(s, e).items()}
    return table(spark, sf, "lineitem").select(long(s).alias("s"), long(e).alias("e"), *[v.alias(k) for k, v in made.items()]).distinct()


SQL["deletion_table"] = """
WITH r AS (SELECT DISTINCT CAST(l_orderkey % 300 AS BIGINT) AS s, CAST(l_orderkey % 300 + CAST(l_quantity AS INT) AS BIGINT) AS e FROM lineitem)
SELECT s, e, s // 3 + 1 AS del_aa_start, CAST(ceil(e / 3.0) AS BIGINT) AS del_aa_end, CAST(ceil((e - s) / 3.0) AS BIGINT) AS del_aa_len, s % 3 = 0 AND (e - s) % 3 = 0 AS in_frame, s + 1 AS del_cds_start, e AS del_cds_end, e - s AS del_cds_len FROM r"""


def insertion_table(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of insertions that have a row, and whether they may move."""
    right, piece = (F.col("o_orderkey") % 900).cast("int"), F.substr(nt_of(F.col("o_orderkey"), letters="ACGTNNNNNNNNNNNN"), F.lit(1), (F.col("o_orderkey") % 8).cast("int"))
    rows = table(spark, sf, "orders").filter(reported_insertion(piece))
    made = insertion_metrics(right, piece)
    return rows.select("o_orderkey", long(made["upstream_aa_pos"]).alias("upstream_aa_pos"), made["inserted_nt"].alias("inserted_nt"), long(made["upstream_nt_pos"]).alias("upstream_nt_pos"), long(made["codon_shift"]).alias("codon_shift"), eligible_for_shift(right, F.length(piece)).alias("eligible"))


SQL["insertion_table"] = f"""
WITH r AS (SELECT o_orderkey, o_orderkey % 900 AS p, substr({sql_nt('o_orderkey', letters='ACGTNNNNNNNNNNNN')}, 1, CAST(o_orderkey % 8 AS BIGINT)) AS i FROM orders)
SELECT o_orderkey, CAST(p // 3 AS BIGINT) AS upstream_aa_pos, i AS inserted_nt, CAST(p AS BIGINT) AS upstream_nt_pos, CAST(p % 3 AS BIGINT) AS codon_shift, p % 3 <> 0 AND length(i) % 3 = 0 AS eligible
FROM r WHERE length(i) >= 3 AND NOT regexp_full_match(i, 'N+')"""


def required_start_filter(spark: SparkSession, sf: str) -> DataFrame:
    """F5 and D9."""
    k = F.col("o_orderkey")
    first = F.struct(F.when(k % 5 == 0, "D").when(k % 5 == 1, "I").otherwise("M").alias("op"), (k % 7).cast("int").alias("q_start"), (k % 7 + 9).cast("int").alias("q_end"), F.when(k % 11 == 0, 3).otherwise(0).alias("c_start"), F.lit(9).alias("c_end"))
    required = F.when(k % 4 > 0, F.element_at(F.array(F.lit("ATG"), F.lit("GTG"), F.lit("CTG")), (k % 3 + 1).cast("int")))
    nt = F.concat(F.lit("AUGTGCTG"), nt_of(k))
    return table(spark, sf, "orders").filter(st.has_required_start(F.array(first), nt, required)).select("o_orderkey")


SQL["required_start_filter"] = f"""
SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0 OR (o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0
AND replace(substr('AUGTGCTG' || {sql_nt('o_orderkey')}, CAST(o_orderkey % 7 + 1 AS BIGINT), 3), 'U', 'T') = CASE o_orderkey % 3 WHEN 0 THEN 'ATG' WHEN 1 THEN 'GTG' ELSE 'CTG' END)"""


def cds_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Running coding offsets of the exons of a product, and which are at its ends."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("int").alias("n"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    every = Window.partitionBy("l_orderkey")
    end = F.sum("n").over(w)
    edge = (F.row_number().over(w) == 1) | (F.row_number().over(w) == F.count("*").over(every))
    return rows.select("l_orderkey", "l_linenumber", long(end - F.col("n")).alias("cds_start"), long(end).alias("cds_end"), edge.alias("edge"))


SQL["cds_offsets"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, CAST(min(l_quantity) AS INT) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, CAST(sum(n) OVER w - n AS BIGINT) AS cds_start, CAST(sum(n) OVER w AS BIGINT) AS cds_end,
       row_number() OVER w = 1 OR row_number() OVER w = count(*) OVER (PARTITION BY l_orderkey) AS edge FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)"""


def _exon_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The ranges of an order's lines, in order, as exons of a product."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("int").alias("n"))
    s = (F.col("l_linenumber") * 20).cast("int")
    ranges = F.array_sort(F.collect_list(F.struct(s.alias("start"), (s + F.greatest(F.lit(1), F.col("n") % 24)).alias("end"))))
    return rows.groupBy("l_orderkey").agg(ranges.alias("ranges"))


_EXONS_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber * 20 AS s, l_linenumber * 20 + greatest(1, CAST(min(l_quantity) AS INT) % 24) AS e FROM lineitem GROUP BY l_orderkey, l_linenumber),
b AS (SELECT *, lag(s) OVER w AS ps, lag(e, 1) OVER w AS p, lag(e, 2) OVER w AS pp, e - s AS n, sum(e - s) OVER (PARTITION BY l_orderkey ORDER BY s) AS c FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY s)) """


def exon_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Running coding offsets of each exon, as a module's tables compute them."""
    out = _exon_ranges(spark, sf).select("l_orderkey", F.inline(tables.exons(F.col("ranges"))))
    return out.select("l_orderkey", *[long(c).alias(c) for c in ("ref_start", "ref_end", "cds_start", "cds_end")])


SQL["exon_offsets"] = _EXONS_SQL + "SELECT l_orderkey, CAST(s AS BIGINT) AS ref_start, CAST(e AS BIGINT) AS ref_end, CAST(c - n AS BIGINT) AS cds_start, CAST(c AS BIGINT) AS cds_end FROM b"


def exon_check(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with a product's exons; empty if nothing is."""
    problem = tables.exon_problem(F.col("ranges"), F.lit(150))
    return _exon_ranges(spark, sf).select("l_orderkey", F.coalesce(problem, F.lit("")).alias("problem"))


SQL["exon_check"] = _EXONS_SQL + """, w AS (SELECT *, CASE WHEN s <= ps OR e <= p THEN 'exons out of order or within each other' WHEN p = s THEN 'adjoining exons are one' WHEN p - s > 2 THEN 'exons share more than 2 bases' END AS pair FROM b)
SELECT l_orderkey, CASE WHEN sum(n) % 3 <> 0 THEN sum(n) || ' bases are no whole codons' WHEN max(e) > 150 THEN 'beyond the end of the reference (150)' WHEN count(pair) > 0 THEN arg_min(pair, s) FILTER (WHERE pair IS NOT NULL)
WHEN bool_or(coalesce(pp > s, false)) THEN 'three exons share bases' ELSE '' END AS problem FROM w GROUP BY 1"""



def exon_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours and next neighbours of exons: order, adjacency, shared bases, gaps."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("int").alias("n"))
    s = (F.col("l_linenumber") * 20).cast("int")
    rows = rows.select("l_orderkey", "l_linenumber", s.alias("s"), (s + F.col("n") % 25).alias("e"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    before, before2 = F.lag("e", 1).over(w), F.lag("e", 2).over(w)
    verdict = F.when(F.col("e") <= F.col("s"), "empty").when(before2 > F.col("s"), "three").when(before == F.col("s"), "adjoining").when(before - F.col("s") > 2, "shared").when(before > F.col("s"), "overlap").when(before < F.col("s"), "gap").otherwise("first")
    return rows.select("l_orderkey", "l_linenumber", verdict.alias("verdict"))


SQL["exon_validation"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_linenumber * 20 AS s, l_linenumber * 20 + CAST(min(l_quantity) AS INT) % 25 AS e FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, lag(e, 1) OVER w AS p, lag(e, 2) OVER w AS pp FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT l_orderkey, l_linenumber, CASE WHEN e <= s THEN 'empty' WHEN pp > s THEN 'three' WHEN p = s THEN 'adjoining' WHEN p - s > 2 THEN 'shared' WHEN p > s THEN 'overlap' WHEN p < s THEN 'gap' ELSE 'first' END AS verdict FROM b"""


def flanking_states(spark: SparkSession, sf: str) -> DataFrame:
    """Two neighbours on each side."""
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("op"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    return rows.select("l_orderkey", "l_linenumber", *[(F.lag if k < 0 else F.lead)("op", abs(k)).over(w).alias(c) for k, c in ((-2, "left2"), (-1, "left1"), (1, "right1"), (2, "right2"))])


SQL["flanking_states"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS op FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, lag(op, 2) OVER w AS left2, lag(op, 1) OVER w AS left1, lead(op, 1) OVER w AS right1, lead(op, 2) OVER w AS right2 FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)"""


def argmax_reference(spark: SparkSession, sf: str) -> DataFrame:
    """A1 and O3: the best line of each order, the first one winning ties."""
    best = F.max_by(F.struct("l_linenumber", "l_quantity"), F.struct("l_quantity", -F.col("l_linenumber")))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", long("b.l_linenumber").alias("file_order"), long("b.l_quantity").alias("score"))


SQL["argmax_reference"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS file_order, CAST(l_quantity AS BIGINT) AS score FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) = 1"""


def _groups(spark: SparkSession) -> DataFrame:
    """A small configuration: which priorities are implemented, by which references."""
    rows = [("1-URGENT", "R1", 120), ("1-URGENT", "R2", 90), ("2-HIGH", "R1", 60), ("5-LOW", "R3", 30)]
    return spark.createDataFrame(rows, "ctype string, reference_id string, ref_len long")


_GROUPS = "g(ctype, reference_id, ref_len) AS (VALUES ('1-URGENT', 'R1', 120), ('1-URGENT', 'R2', 90), ('2-HIGH', 'R1', 60), ('5-LOW', 'R3', 30)) "


def implemented_join(spark: SparkSession, sf: str) -> DataFrame:
    """Queries with every reference group of their ctype."""
    queries = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("ctype"))
    return tables.implemented(queries, _groups(spark)).select("o_orderkey", "ctype", "reference_id", "ref_len")


SQL["implemented_join"] = "WITH " + _GROUPS + "SELECT o_orderkey, ctype, reference_id, CAST(ref_len AS BIGINT) AS ref_len FROM orders JOIN g ON o_orderpriority = ctype"


def unimplemented_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    """Ctypes that no group has."""
    return tables.unimplemented(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("ctype")), _groups(spark))


SQL["unimplemented_antijoin"] = "WITH " + _GROUPS + "SELECT DISTINCT o_orderpriority AS ctype FROM orders WHERE o_orderpriority NOT IN (SELECT ctype FROM g)"


def unimplemented_by_module(spark: SparkSession, sf: str) -> DataFrame:
    """Which other module has them; the first one wins."""
    elsewhere = spark.createDataFrame([(0, "m1", "3-MEDIUM"), (1, "m2", "3-MEDIUM"), (1, "m2", "9-NONE")], "module_order int, module string, ctype string")
    return by_module(unimplemented_antijoin(spark, sf), elsewhere).select("module", F.array_join("ctypes", ",").alias("ctypes"))


SQL["unimplemented_by_module"] = "WITH " + _GROUPS + """, u AS (SELECT DISTINCT o_orderpriority AS ctype FROM orders WHERE o_orderpriority NOT IN (SELECT ctype FROM g)),
e(o, module, ctype) AS (VALUES (0, 'm1', '3-MEDIUM'), (1, 'm2', '3-MEDIUM'), (1, 'm2', '9-NONE')), f AS (SELECT ctype, arg_min(module, o) AS module FROM e GROUP BY ctype)
SELECT module, string_agg(ctype, ',' ORDER BY ctype) AS ctypes FROM u LEFT JOIN f USING (ctype) GROUP BY module"""


def _module_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References of the nations (some with an alternate of another length), a product of a nation for each supplier
    (some of nations without a reference), weights of the customers (some of products that aren't there)."""
    k, s, c = F.col("n_nationkey"), F.col("s_suppkey"), F.col("c_custkey")
    alternates = F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))).alias("file_order")
    refs = table(spark, sf, "nation").select(k.cast("string").alias("reference_id"), F.col("n_regionkey").cast("string").alias("ctype"), alternates)
    seq = F.concat(nt_of(F.col("reference_id")), F.when((F.col("file_order") == 2) & (F.col("reference_id").cast("int") % 4 == 0), "A").otherwise(""))
    own = F.col("s_nationkey")
    one = F.struct((s % 20).cast("int").alias("start"), (s % 20 + 3 + s % 4 * 3).cast("int").alias("end"))
    regions = table(spark, sf, "nation").select(k.alias("s_nationkey"), F.col("n_regionkey").cast("string").alias("ctype"))
    specs = table(spark, sf, "supplier").join(regions, "s_nationkey").select(
        F.when(s % 11 == 0, F.concat(F.lit("x"), own.cast("string"))).otherwise(own.cast("string")).alias("reference_id"), "ctype",
        F.concat(F.lit("p"), (s % 7).cast("string")).alias("product_name"), F.array(one).alias("ranges"), F.lit(None).cast("string").alias("required_start"),
    )
    codon = F.substr(nt_of(c), F.lit(1), F.lit(3)).alias("codon")
    weights = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("reference_id"), F.concat(F.lit("p"), (c % 9).cast("string")).alias("product_name"), (c % 5 + 1).cast("int").alias("position"), codon)
    weights = weights.groupBy("reference_id", "product_name", "position", "codon").agg(F.count("*").alias("count"))
    return refs.withColumn("seq", seq), specs, weights


_MODULE = f"""WITH refs AS (SELECT reference_id, ctype, file_order, {sql_nt('reference_id')} || CASE WHEN file_order = 2 AND CAST(reference_id AS INT) % 4 = 0 THEN 'A' ELSE '' END AS seq
  FROM (SELECT CAST(n_nationkey AS VARCHAR) AS reference_id, CAST(n_regionkey AS VARCHAR) AS ctype, unnest(range(0, n_nationkey % 3 + 1)) AS file_order FROM nation)),
specs AS (SELECT CASE WHEN s_suppkey % 11 = 0 THEN 'x' ELSE '' END || s_nationkey AS reference_id, CAST(n_regionkey AS VARCHAR) AS ctype, 'p' || s_suppkey % 7 AS product_name, s_suppkey % 20 AS r0, s_suppkey % 20 + 3 + s_suppkey % 4 * 3 AS r1
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
weights AS (SELECT CAST(c_nationkey AS VARCHAR) AS reference_id, 'p' || c_custkey % 9 AS product_name, c_custkey % 5 + 1 AS position, substr({sql_nt('c_custkey')}, 1, 3) AS codon, count(*) AS n FROM customer GROUP BY ALL) """


def products_with_config(spark: SparkSession, sf: str) -> DataFrame:
    """Groups with their products, these with their weights; missing ones leave nothing there."""
    refs, specs, weights = _module_tables(spark, sf)
    rows = tables.groups(refs).join(tables.products(specs, weights).hint("merge"), ["reference_id", "ctype"], "left")
    size = F.element_at("exons", -1)["cds_end"]
    entries = F.array_join(F.array_sort(F.transform(F.map_entries("weights"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return rows.select("reference_id", "ctype", long(F.size("seqs")).alias("n_seqs"), long("ref_len").alias("ref_len"), F.coalesce("product_name", F.lit("")).alias("product_name"), long(F.coalesce(size, F.lit(0))).alias("cds_len"), F.coalesce(entries, F.lit("")).alias("weights"))


SQL["products_with_config"] = _MODULE + """, g AS (SELECT reference_id, ctype, count(*) AS n_seqs, max(length(seq)) AS ref_len FROM refs GROUP BY ALL),
w AS (SELECT reference_id, product_name, string_agg(position || ':' || codon || '=' || n, ',' ORDER BY position || ':' || codon || '=' || n) AS weights FROM weights GROUP BY ALL)
SELECT g.reference_id, g.ctype, n_seqs, CAST(ref_len AS BIGINT) AS ref_len, coalesce(s.product_name, '') AS product_name, CAST(coalesce(r1 - r0, 0) AS BIGINT) AS cds_len, coalesce(weights, '') AS weights
FROM g LEFT JOIN specs s USING (reference_id, ctype) LEFT JOIN w ON w.reference_id = s.reference_id AND w.product_name = s.product_name"""


def module_problems(spark: SparkSession, sf: str) -> DataFrame:
    """J6, U2, A10, A11, A12, F12 as one plan: every broken rule of a module's tables."""
    return tables.module_problems(*_module_tables(spark, sf)).select("message")


SQL["module_problems"] = _MODULE + """, l AS (SELECT reference_id, ctype, min(length(seq)) AS ref_len FROM refs GROUP BY ALL)
SELECT reference_id || '|' || product_name || ' has more than one specification' AS message FROM specs GROUP BY reference_id, product_name HAVING count(*) > 1
UNION ALL SELECT 'references of one group differ in length: [(''' || reference_id || ''', ''' || ctype || ''')]' FROM refs GROUP BY reference_id, ctype HAVING min(length(seq)) < max(length(seq))
UNION ALL SELECT DISTINCT 'coding regions without a reference: [(''' || reference_id || ''', ''' || ctype || ''')]' FROM specs WHERE (reference_id, ctype) NOT IN (SELECT (reference_id, ctype) FROM refs)
UNION ALL SELECT DISTINCT 'weights without a coding region: [(''' || reference_id || ''', ''' || product_name || ''')]' FROM weights WHERE (reference_id, product_name) NOT IN (SELECT (reference_id, product_name) FROM specs)
UNION ALL SELECT reference_id || '|' || product_name || ': beyond the end of the reference (' || ref_len || ')' FROM specs JOIN l USING (reference_id, ctype) WHERE r1 > ref_len"""


def leftover_spec_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    """Weights that no coding region uses."""
    _, specs, weights = _module_tables(spark, sf)
    return tables.without(weights, specs, ["reference_id", "product_name"])


SQL["leftover_spec_antijoin"] = _MODULE + "SELECT DISTINCT reference_id, product_name FROM weights WHERE (reference_id, product_name) NOT IN (SELECT (reference_id, product_name) FROM specs)"



def params_with_default(spark: SparkSession, sf: str) -> DataFrame:
    """Penalties of a ctype, else the default's, told once for each ctype."""
    module = ModuleConfig("m", None, "-", "-", {"default": Penalties(14, 1, 40, 1), "1-URGENT": Penalties(10, 1, 50, 1)})
    known = spark.createDataFrame([(c, module.penalties(c).match, module.penalties(c).gap_open) for c in module.alignment], "o_orderpriority string, m int, g int")
    rest = module.penalties("")
    rows = table(spark, sf, "orders").join(known, "o_orderpriority", "left")
    return rows.select("o_orderkey", long(F.coalesce("m", F.lit(rest.match))).alias("match"), long(F.coalesce("g", F.lit(rest.gap_open))).alias("gap_open"))


SQL["params_with_default"] = "SELECT o_orderkey, CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 14 END AS BIGINT) AS \"match\", CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 50 ELSE 40 END AS BIGINT) AS gap_open FROM orders"



def weights_lookup_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The weight of a codon at a position, else how usual the codon is."""
    usual = F.array(*map(F.lit, USUAL_CODONS))
    codon = F.substr(nt_of(F.col("l_orderkey")), F.lit(1), F.lit(3))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", codon.alias("codon")).distinct()
    weights = table(spark, sf, "part").select((F.col("p_partkey") % 7 + 1).cast("int").alias("l_linenumber"), F.substr(nt_of(F.col("p_partkey")), F.lit(1), F.lit(3)).alias("codon"), long("p_size").alias("n")).groupBy("l_linenumber", "codon").agg(F.max("n").alias("n"))
    out = lines.join(weights, ["l_linenumber", "codon"], "left")
    return out.select("l_orderkey", "l_linenumber", F.coalesce("n", 10 * F.array_position(usual, F.col("codon"))).alias("weight"))


_USUAL_SQL = "[" + ", ".join(f"'{c}'" for c in USUAL_CODONS) + "]"
SQL["weights_lookup_fallback"] = f"""
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, substr({sql_nt('l_orderkey')}, 1, 3) AS codon FROM lineitem),
w AS (SELECT p_partkey % 7 + 1 AS l_linenumber, substr({sql_nt('p_partkey')}, 1, 3) AS codon, max(CAST(p_size AS BIGINT)) AS n FROM part GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, CAST(coalesce(w.n, 10 * list_position({_USUAL_SQL}, l.codon)) AS BIGINT) AS weight FROM l LEFT JOIN w ON w.l_linenumber = l.l_linenumber AND w.codon = l.codon"""


def dup_spec_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated keys of the lines, and groups of uneven length."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("reference_id"), F.col("l_suppkey").cast("string").alias("ctype"), F.repeat(F.lit("A"), F.col("l_quantity").cast("int")).alias("seq"))
    again = tables.repeated(lines, ["reference_id", "ctype"])
    out = again.join(tables.uneven(lines).select("reference_id", "ctype", F.lit(True).alias("u")), ["reference_id", "ctype"], "left")
    return out.select(long("reference_id").alias("l_orderkey"), long("ctype").alias("l_suppkey"), "n", F.coalesce("u", F.lit(False)).alias("uneven"))


SQL["dup_spec_keys"] = "SELECT l_orderkey, l_suppkey, count(*) AS n, min(l_quantity) <> max(l_quantity) AS uneven FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"



def rewrite_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Deletions at exactly a rule's place."""
    dels = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 40).alias("s"), (F.col("l_orderkey") % 40 + F.col("l_linenumber")).alias("e")).distinct()
    rules = spark.createDataFrame([(7, 10, 4, 7), (12, 13, 9, 10), (30, 36, 33, 39)], "s long, e long, to_start long, to_end long")
    return dels.join(rules, ["s", "e"]).select("l_orderkey", "l_linenumber", "to_start", "to_end")


SQL["rewrite_candidates"] = """
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey % 40 AS s, l_orderkey % 40 + l_linenumber AS e FROM lineitem), r(s, e, to_start, to_end) AS (VALUES (7, 10, 4, 7), (12, 13, 9, 10), (30, 36, 33, 39))
SELECT l_orderkey, l_linenumber, CAST(to_start AS BIGINT) AS to_start, CAST(to_end AS BIGINT) AS to_end FROM d JOIN r ON d.s = r.s AND d.e = r.e"""


def nearest_region(spark: SparkSession, sf: str) -> DataFrame:
    """How far the nearest regions on each side of an indel are; regions of the suppliers of a nation, a line's
    indel in one of them."""
    k = F.col("s_suppkey")
    regions = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("part"), (k * 37 % 1000).alias("r0"), (k * 37 % 1000 + 1 + k % 5).alias("r1"))
    s = F.col("l_partkey") % 1100
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 25).alias("part"), s.alias("i0"), (s + F.col("l_linenumber")).alias("i1"))
    near = nearest_regions(rows, regions, ["part"], ("i0", "i1"), ("r0", "r1"))
    return near.select("l_orderkey", "l_linenumber", long("i0").alias("i0"), long(F.col("i0") - F.col("left_end")).alias("to_left"), long(F.col("right_start") - F.col("i1")).alias("to_right"))


SQL["nearest_region"] = """
WITH r AS (SELECT s_nationkey AS part, s_suppkey * 37 % 1000 AS r0, s_suppkey * 37 % 1000 + 1 + s_suppkey % 5 AS r1 FROM supplier),
i AS (SELECT l_orderkey, l_linenumber, l_suppkey % 25 AS part, l_partkey % 1100 AS i0, l_partkey % 1100 + l_linenumber AS i1 FROM lineitem),
d AS (SELECT DISTINCT part, i0, i1 FROM i),
n AS (SELECT d.part, i0, i1, min(CASE WHEN r1 <= i0 THEN i0 - r1 END) AS to_left, min(CASE WHEN r0 >= i1 THEN r0 - i1 END) AS to_right FROM d LEFT JOIN r ON r.part = d.part GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CAST(i0 AS BIGINT) AS i0, CAST(to_left AS BIGINT) AS to_left, CAST(to_right AS BIGINT) AS to_right FROM i JOIN n USING (part, i0, i1)"""


def states_features(spark: SparkSession, sf: str) -> DataFrame:
    """J8 as a relation: the states of every order, each on its own stretch of one long line, with the ranges of all
    parts on it; what is shared, and insertions only where they are within."""
    at = F.col("l_orderkey")
    states = _alignments(spark, sf).select("l_orderkey", F.posexplode(st.states_of(F.col("cigar"), F.lit(2), F.lit(5))).alias("pos", "s"))
    rows = states.select("l_orderkey", "pos", "s.op", (at + F.col("s.r_start")).alias("r0"), (at + F.col("s.r_end")).alias("r1"))
    # an insertion meets what lies on both sides of its place
    point = F.col("op") == "I"
    rows = rows.withColumns({"from": F.when(point, F.col("r0") - 1).otherwise(F.col("r0")), "to": F.when(point, F.col("r0") + 1).otherwise(F.col("r1"))})
    first = F.col("p_partkey") * 30
    features = table(spark, sf, "part").select("p_partkey", first.alias("f0"), (first + F.col("p_size") * F.when(F.col("p_partkey") % 100 == 0, 40).otherwise(1)).alias("f1"))
    pairs = interval_join(rows, features, [], ("from", "to"), ("f0", "f1")).filter(~point | ((F.col("f0") < F.col("r0")) & (F.col("r0") < F.col("f1"))))
    shared = [F.when(point, F.col("r0")).otherwise(x) - F.col("f0") for x in (F.greatest("r0", "f0"), F.least("r1", "f1"))]
    return pairs.select("l_orderkey", long("pos").alias("pos"), "op", "p_partkey", long(shared[0]).alias("c_start"), long(shared[1]).alias("c_end"))


SQL["states_features"] = _CIGAR + """, x AS (SELECT l_orderkey, pos, op, l_orderkey + r_start AS r0, l_orderkey + r_end AS r1 FROM s),
f AS (SELECT p_partkey, p_partkey * 30 AS f0, p_partkey * 30 + p_size * CASE WHEN p_partkey % 100 = 0 THEN 40 ELSE 1 END AS f1 FROM part)
SELECT l_orderkey, pos, op, p_partkey, CAST(CASE WHEN op = 'I' THEN r0 ELSE greatest(r0, f0) END - f0 AS BIGINT) AS c_start, CAST(CASE WHEN op = 'I' THEN r0 ELSE least(r1, f1) END - f0 AS BIGINT) AS c_end
FROM x JOIN f ON CASE WHEN op = 'I' THEN f0 < r0 AND r0 < f1 ELSE r0 < f1 AND f0 < r1 END"""


def insertion_splice(spark: SparkSession, sf: str) -> DataFrame:
    """Inserted residues between aligned ones."""
    k = F.col("o_orderkey")
    letters = F.translate(F.md5(k.cast("string").cast("binary")), "0123456789abcdef", "ACDEFGHIKLMNPQ-.")
    one = lambda at, aa: F.struct(at.cast("int").alias("upstream_aa_pos"), aa.alias("inserted_aa"))
    return table(spark, sf, "orders").select("o_orderkey", spliced(letters, F.array(one(k % 10, F.lit("XY")), one(k % 10 + 5, F.lit("~")))).alias("aa_seq"))


SQL["insertion_splice"] = """
WITH s AS (SELECT o_orderkey, translate(md5(CAST(o_orderkey AS VARCHAR)), '0123456789abcdef', 'ACDEFGHIKLMNPQ-.') AS a, CAST(o_orderkey % 10 AS BIGINT) AS p FROM orders)
SELECT o_orderkey, replace(replace(substr(a, 1, p), '-', ''), '.', '') || 'XY' || replace(replace(substr(a, p + 1, 5), '-', ''), '.', '') || '~' || replace(replace(substr(a, p + 6), '-', ''), '.', '') AS aa_seq FROM s"""


def _product(spark: SparkSession, sf: str) -> DataFrame:
    """A product of 60 bases for each order: match, insertion, match, deletion, match."""
    k = F.col("o_orderkey").cast("int")
    rows = dealt(table(spark, sf, "orders").select("o_orderkey")).select("o_orderkey", F.concat(nt_of(F.col("o_orderkey")), nt_of(F.col("o_orderkey"), "-1"), nt_of(F.col("o_orderkey"), "-2")).alias("nt"), (6 + 3 * (k % 5)).alias("a"), (1 + k % 4).alias("i"), (9 + k % 3).alias("b"), (3 + k % 4).alias("d"))
    a, i, b, d, none = F.col("a"), F.col("i"), F.col("b"), F.col("d"), F.lit(None).cast("int")
    parts = [("M", F.lit(0), a, F.lit(0), a), ("I", a, a + i, a, a), ("M", a + i, a + i + b, a, a + b), ("D", none, none, a + b, a + b + d), ("M", a + i + b, 60 - d + i, a + b + d, F.lit(60))]
    made = F.array(*[F.struct(F.lit(op).alias("op"), *[x.alias(n) for x, n in zip(p, ("q_start", "q_end", "c_start", "c_end"), strict=True)]) for op, *p in parts]).cast(CDS_STATES)
    return rows.select(F.col("o_orderkey").cast("string").alias("query_id"), F.lit("T").alias("ctype"), F.lit("R").alias("reference_id"), F.lit("P").alias("product_name"), "nt", made.alias("states"), F.lit(0).alias("lpad"), F.lit(0).alias("rpad"), F.lit(60).alias("cds_len"))


def product_materialize(spark: SparkSession, sf: str) -> DataFrame:
    """Aligned and plain sequences, hashes, flags and coordinates of products."""
    return product_rows(materialize_products(_product(spark, sf)))["seq"].drop("ctype", "reference_id", "product_name")


_PRODUCT = f"""
WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS query_id, {sql_nt('o_orderkey')} || {sql_nt('o_orderkey', '-1')} || {sql_nt('o_orderkey', '-2')} AS nt,
           6 + 3 * (o_orderkey % 5) AS a, 1 + o_orderkey % 4 AS i, 9 + o_orderkey % 3 AS b, 3 + o_orderkey % 4 AS d FROM orders),
q AS (SELECT *, substr(nt, 1, CAST(a AS BIGINT)) || substr(nt, CAST(a + i + 1 AS BIGINT), CAST(b AS BIGINT)) || repeat('-', CAST(d AS BIGINT)) || substr(nt, CAST(a + i + b + 1 AS BIGINT), CAST(60 - a - b - d AS BIGINT)) AS aln FROM p),
t AS (SELECT *, list_aggregate({sql_aminos('aln')}, 'string_agg', '') AS aa FROM q),
u AS (SELECT *, CASE WHEN instr(aa, '*') > 0 THEN 3 * instr(aa, '*') ELSE 60 END AS stop FROM t),
v AS (SELECT *, substr(aa, 1, CAST(stop // 3 AS BIGINT)) AS own, substr(nt, CAST(a + 1 AS BIGINT), CAST(i AS BIGINT)) AS ins, a < stop AS has_ins, a + b < stop AS has_del, a + b + d < stop AS has_last FROM u),
w AS (SELECT *, substr(nt, 1, CAST(stop - CASE WHEN stop > a + b THEN d ELSE 0 END + CASE WHEN has_ins THEN i ELSE 0 END AS BIGINT)) AS cds_seq,
      CASE WHEN has_ins AND i >= 3 THEN replace(substr(own, 1, CAST(a // 3 AS BIGINT)), '-', '') || list_aggregate({sql_aminos('ins')}, 'string_agg', '') || CASE WHEN i % 3 > 0 THEN '~' ELSE '' END || replace(substr(own, CAST(a // 3 + 1 AS BIGINT)), '-', '')
      ELSE replace(own, '-', '') END AS aa_seq FROM v) """
SQL["product_materialize"] = _PRODUCT + """
SELECT query_id, md5(aa_seq) AS variant_hash, aa_seq, own || repeat('.', CAST((60 - stop) // 3 AS BIGINT)) AS aa_aln, sha1(cds_seq) AS cds_id, has_ins AS has_insertion, (has_ins AND i % 3 > 0) OR (has_del AND d % 3 > 0) AS has_shift_indel,
       cds_seq, substr(aln, 1, CAST(stop AS BIGINT)) || repeat('.', CAST(60 - stop AS BIGINT)) AS cds_aln,
       concat_ws(';', '1..' || least(a, stop), CASE WHEN has_ins THEN (a + 1) || '..' || (a + i) END, CASE WHEN has_ins THEN (a + i + 1) || '..' || (a + i + least(b, stop - a)) END, CASE WHEN has_last THEN (a + i + b + 1) || '..' || (stop - d + i) END) AS query_coordinates,
       concat_ws(';', '1..' || least(a, stop), CASE WHEN has_ins THEN CAST(a AS VARCHAR) END, CASE WHEN has_ins THEN (a + 1) || '..' || (a + least(b, stop - a)) END, CASE WHEN has_last THEN (a + b + d + 1) || '..' || stop END) AS cds_coordinates FROM w"""


def product_indels(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the insertion and deletion tables."""
    t = product_rows(materialize_products(_product(spark, sf)))
    ins = t["ins"].select("query_id", F.lit("ins").alias("what"), long("upstream_aa_pos").alias("aa_pos"), long("upstream_nt_pos").alias("nt_pos"), F.col("inserted_aa").alias("detail"))
    gone = t["del"].select("query_id", F.lit("del").alias("what"), long("del_aa_start").alias("aa_pos"), long("del_cds_start").alias("nt_pos"), F.concat_ws(",", F.col("del_aa_end").cast("string"), F.col("del_cds_len").cast("string"), F.col("in_frame").cast("string"), "variant_hash").alias("detail"))
    return ins.unionByName(gone)


SQL["product_indels"] = _PRODUCT + f"""
SELECT query_id, 'ins' AS what, CAST(a // 3 AS BIGINT) AS aa_pos, CAST(a AS BIGINT) AS nt_pos, list_aggregate({sql_aminos('ins')}, 'string_agg', '') || CASE WHEN i % 3 > 0 THEN '~' ELSE '' END AS detail FROM w WHERE has_ins AND i >= 3
UNION ALL SELECT query_id, 'del', CAST((a + b) // 3 + 1 AS BIGINT), CAST(a + b + 1 AS BIGINT), concat_ws(',', CAST(CAST(ceil((a + b + d) / 3.0) AS BIGINT) AS VARCHAR), CAST(d AS VARCHAR), CASE WHEN (a + b) % 3 = 0 AND d % 3 = 0 THEN 'true' ELSE 'false' END, md5(aa_seq)) FROM w WHERE has_del"""


def genome_materialize(spark: SparkSession, sf: str) -> DataFrame:
    """Genome rows; nothing is cut at stop codons."""
    rows = _product(spark, sf).withColumn("states", F.transform("states", lambda s: F.struct(s["op"].alias("op"), s["q_start"].alias("q_start"), s["q_end"].alias("q_end"), (s["c_start"] + 4).alias("r_start"), (s["c_end"] + 4).alias("r_end"))))
    t = genome_rows(rows.withColumns({"ref_len": F.lit(70), "stop_end": F.lit(None).cast("int")}))
    joined = t["gen_seq"].join(t["gen_ins"].drop("ctype", "reference_id"), "query_id").join(t["gen_del"].drop("ctype", "reference_id"), "query_id")
    return joined.select("query_id", "genome_id", long("genome_length").alias("genome_length"), "has_insertion", "genome_aln", long("upstream_nt_pos").alias("upstream_nt_pos"), "inserted_nt", *[long(c).alias(c) for c in ("del_start", "del_end", "del_len")])


SQL["genome_materialize"] = _PRODUCT + """
SELECT query_id, sha1(substr(nt, 1, CAST(60 - d + i AS BIGINT))) AS genome_id, CAST(60 - d + i AS BIGINT) AS genome_length, true AS has_insertion, '....' || aln || '......' AS genome_aln, CAST(a + 4 AS BIGINT) AS upstream_nt_pos, ins AS inserted_nt,
       CAST(a + b + 5 AS BIGINT) AS del_start, CAST(a + b + d + 4 AS BIGINT) AS del_end, CAST(d AS BIGINT) AS del_len FROM w"""
