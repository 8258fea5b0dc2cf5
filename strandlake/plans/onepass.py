"""All six tables from one pass over the queries, without keeping the aligned rows.

Each aligned row meets the products of its group and, once, an entry for the genome itself; each of these gives the
lines of its tables, told apart by a column. They are one stream, so the alignment runs once, nothing is persisted,
and a lost executor costs the partitions it was at. The sink makes a folder ``table=...`` for each table, and the six
come to be together, when the job is committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandlake.operators.materialize import genome_parts, padded, with_extension
from strandlake.plans.annotate import aligned_states, products_of
from strandlake.plans.module import Module
from strandlake.schema import GENOME_KEYS, PRODUCT_KEYS, TABLES
from strandlake.sources.tables import parsed, write_line

LINES = "array<struct<table:string,value:string>>"


def _keys(keys: str) -> dict[str, Column]:
    return {k: F.col(k) for k in (x.split()[0] for x in keys.split(", "))}


def _line(table: str, cells: dict[str, Column]) -> Column:
    return F.struct(F.lit(table).alias("table"), write_line(cells, table).alias("value"))


def _product_lines(module: Module) -> Column:
    keys, own = _keys(PRODUCT_KEYS), {c.split()[0]: F.col(c.split()[0]) for c in TABLES["seq"].split(", ")}
    of = {c: F.col(c) for c in ("variant_hash", "cds_id")}

    def rest(table: str, x: Column) -> dict[str, Column]:
        return {c: x[c] for c in (y.split()[0] for y in TABLES[table].split(", ")) if c not in keys and c not in of}

    seq = F.array(_line("seq", own | padded(module.config.right_pad_aa, module.config.right_pad_cds)))
    ins = F.transform("ins", lambda x: _line("ins", keys | rest("ins", x)))
    gone = F.transform("del", lambda x: _line("del", keys | of | rest("del", x)))
    none = F.array().cast(LINES)
    return F.concat(F.when(F.col("kind") != "empty", F.concat(seq, gone)).otherwise(none), F.when(F.col("kind") == "data", ins).otherwise(none))


def _genome_lines(module: Module) -> Column:
    keys = _keys(GENOME_KEYS)
    columns, ins, gone = genome_parts(F.col("every"), F.col("genome"), F.col("nt"), F.col("ref_len"), module.config.right_pad_gen)
    seq = F.array(_line("gen_seq", keys | columns))
    fields = lambda table, x: {c.split()[0]: x[c.split()[0]] for c in TABLES[table].split(", ") if c.split()[0] not in keys}
    return F.concat(seq, F.transform(ins, lambda x: _line("gen_ins", keys | fields("gen_ins", x))), F.transform(gone, lambda x: _line("gen_del", keys | fields("gen_del", x))))


def table_lines(queries: DataFrame, module: Module, seen: Observation | None = None) -> DataFrame:
    """table, value: the lines of all tables of queries (query_id, nt, ctype), as ``sources.tables`` writes them.
    Repeated queries give repeated lines; no queries, or none that aligns, no lines. ``seen`` gets ``pairs`` and
    ``unaligned`` as in ``annotate``."""
    aligned = aligned_states(queries, module)
    if seen is not None:
        aligned = aligned.observe(seen, F.count("*").alias("pairs"), F.count_if(F.col("score").isNull()).alias("unaligned"))
    rows = products_of(aligned.filter(F.col("score").isNotNull()), module, genomes=True)
    rows = rows.withColumn("every", with_extension(F.col("genome"), F.col("stop_end"), F.col("ref_len")))
    lines = F.when(F.col("product_name").isNull(), _genome_lines(module)).otherwise(_product_lines(module))
    return rows.select(F.inline(lines))


def write_together(lines: DataFrame, folder: str, mode: str = "error") -> None:
    """The tables as tab-delimited text in ``folder/table=...``."""
    lines.write.mode(mode).partitionBy("table").text(folder)


def read_together(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables of such a folder with their types; a table without rows has no folder and is empty here."""
    lines = spark.read.text(folder)
    if "table" not in lines.columns:  # no table has a row
        lines = lines.withColumn("table", F.lit(""))
    return {t: parsed(lines.filter(F.col("table") == t).select("value"), t) for t in TABLES}
