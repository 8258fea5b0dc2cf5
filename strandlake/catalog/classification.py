"""Types told by k-mers: references made of the nations' keys, and a customer's copy of one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.catalog.base import dealt, long, nt_of, sql_nt, table
from strandlake.functions.iupac import reverse_complement
from strandlake.operators.classify import KmerIndex, Thresholds, classifier
from strandlake.sources.config import Reference

SQL: dict[str, str] = {}

K, PIECES = 13, "abcdefgh"


def _reference_of(key: Column) -> Column:
    """256 bases; the last two nations have the same."""
    own = F.when(key == 24, 23).otherwise(key)
    return F.concat(*[nt_of(own, f"-{p}") for p in PIECES])


def _copies(spark: SparkSession, sf: str) -> DataFrame:
    """Of ten customers one has a chimera of two nations, one a doubled copy, one bases of its own; the others have a
    copy with a base changed and one unknown, every second one of the other strand."""
    k, own = F.col("c_custkey"), F.col("c_nationkey")
    rows = dealt(table(spark, sf, "customer").select("c_custkey", "c_nationkey"))
    ref, other = _reference_of(own), _reference_of((own + 1) % 25)
    alone = F.concat(*[nt_of(k, f"-own-{p}") for p in PIECES])
    copied = F.concat(F.substr(ref, F.lit(1), F.lit(60)), F.lit("N"), F.substr(ref, F.lit(62), F.lit(38)), F.translate(F.substr(ref, F.lit(100), F.lit(1)), "ACGT", "CGTA"), F.substr(ref, F.lit(101)))
    made = F.when(k % 10 == 0, F.concat(F.substr(ref, F.lit(1), F.lit(128)), F.substr(other, F.lit(129)))).when(k % 10 == 1, F.concat(ref, ref)).when(k % 10 == 2, alone).otherwise(copied)
    return rows.select("c_custkey", F.when(k % 2 == 0, made).otherwise(reverse_complement(made)).alias("seq"))


def classify_kmer(spark: SparkSession, sf: str) -> DataFrame:
    """Type, strand and status of each copy. The references are 25 at any scale."""
    names = table(spark, sf, "nation").select("n_name", _reference_of(F.col("n_nationkey")).alias("seq")).collect()
    index = KmerIndex.of([Reference(r["n_name"], r["n_name"], i, r["seq"]) for i, r in enumerate(names)], K)
    told = classifier(index, Thresholds())(_copies(spark, sf))
    return told.select("c_custkey", F.coalesce("classified", F.lit("-")).alias("classified"), F.coalesce("strand", F.lit("-")).alias("strand"), "status", long("hits").alias("hits"), long("kmers").alias("kmers"), F.array_join("taxa", ",").alias("taxa"))


def _sql_reference(key: str) -> str:
    own = f"(CASE WHEN {key} = 24 THEN 23 ELSE {key} END)"
    return "(" + " || ".join(sql_nt(own, f"-{p}") for p in PIECES) + ")"


_ALONE = " || ".join(sql_nt("c_custkey", f"-own-{p}") for p in PIECES)
SQL["classify_kmer"] = f"""
WITH r AS (SELECT n_name AS ctype, {_sql_reference('n_nationkey')} AS seq FROM nation),
x AS (SELECT DISTINCT ctype, substr(seq, i, {K}) AS kmer FROM (SELECT *, unnest(range(1, 256 - {K} + 2)) AS i FROM r)),
c AS (SELECT c_custkey, {_sql_reference('c_nationkey')} AS own, {_sql_reference('((c_nationkey + 1) % 25)')} AS other, {_ALONE} AS alone FROM customer),
m AS (SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN substr(own, 1, 128) || substr(other, 129) WHEN 1 THEN own || own WHEN 2 THEN alone
      ELSE substr(own, 1, 60) || 'N' || substr(own, 62, 38) || translate(substr(own, 100, 1), 'ACGT', 'CGTA') || substr(own, 101) END AS s FROM c),
q AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN s ELSE translate(reverse(s), 'ACGT', 'TGCA') END AS s FROM m),
p AS (SELECT c_custkey, (i - 1) * 4 // (length(s) - {K} + 1) AS seg, substr(s, i, {K}) AS w FROM (SELECT *, unnest(range(1, length(s) - {K} + 2)) AS i FROM q)),
g AS (SELECT * FROM p WHERE regexp_full_match(w, '[ACGT]+')),
b AS (SELECT c_custkey, seg, '+' AS strand, w AS kmer FROM g UNION ALL SELECT c_custkey, seg, '-', translate(reverse(w), 'ACGT', 'TGCA') FROM g),
h AS (SELECT c_custkey, seg, strand, ctype, count(*) AS n FROM b JOIN x USING (kmer) GROUP BY ALL),
t AS (SELECT c_custkey, strand, ctype, sum(n) AS n FROM h GROUP BY ALL),
best AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY n DESC, ctype, strand) = 1),
lead AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY c_custkey, seg ORDER BY n DESC, ctype, strand) = 1),
v AS (SELECT c_custkey, seg, count(*) AS n FROM g GROUP BY ALL), vs AS (SELECT c_custkey, sum(n) AS n FROM v GROUP BY 1),
o AS (SELECT l.c_custkey, list(DISTINCT l.ctype) AS others FROM lead l JOIN v USING (c_custkey, seg) JOIN best ON best.c_custkey = l.c_custkey
      LEFT JOIN h ON h.c_custkey = l.c_custkey AND h.seg = l.seg AND h.ctype = best.ctype AND h.strand = best.strand
      WHERE (l.ctype <> best.ctype OR l.strand <> best.strand) AND 100 * l.n >= 20 * v.n AND l.n >= 2 * coalesce(h.n, 0) GROUP BY 1),
n AS (SELECT t.c_custkey, list(DISTINCT t.ctype) AS near FROM t JOIN best USING (c_custkey) WHERE 100 * t.n >= 90 * best.n GROUP BY 1),
d AS (SELECT q.c_custkey, length(q.s) AS len, best.ctype, best.strand, coalesce(best.n, 0) AS hits, vs.n AS kmers, others, near,
      CASE WHEN best.n IS NULL OR 100 * best.n < 5 * vs.n THEN 'unrecognizable' WHEN others IS NOT NULL THEN 'chimeric' WHEN len(near) > 1 THEN 'unresolvable'
           WHEN 100 * length(q.s) > 125 * 256 THEN 'unusually long' ELSE 'classified' END AS status
      FROM q LEFT JOIN best USING (c_custkey) LEFT JOIN vs USING (c_custkey) LEFT JOIN o USING (c_custkey) LEFT JOIN n USING (c_custkey))
SELECT c_custkey, CASE WHEN status IN ('classified', 'unusually long') THEN ctype ELSE '-' END AS classified, CASE WHEN status IN ('classified', 'unusually long') THEN strand ELSE '-' END AS strand,
       status, CAST(hits AS BIGINT) AS hits, CAST(kmers AS BIGINT) AS kmers,
       CASE status WHEN 'unrecognizable' THEN '' WHEN 'chimeric' THEN array_to_string(list_sort(list_distinct(list_append(others, ctype))), ',') WHEN 'unresolvable' THEN array_to_string(list_sort(near), ',') ELSE ctype END AS taxa FROM d"""
