"""The six result tables as files: tab-delimited text without header, \\N for null, or any Spark format."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.schema import TABLES, AnnotationError, names

NULL = "\\N"
PRODUCT_TABLES, GENOME_TABLES = ("seq", "ins", "del"), ("gen_seq", "gen_ins", "gen_del")


def null_text(value: Column, kind: str) -> Column:
    """Null and empty values are \\N."""
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(NULL)).otherwise(text) if kind == "string" else F.coalesce(text, F.lit(NULL))


def write_line(cells: dict[str, Column], table: str) -> Column:
    """The line of a row, given each of its table's columns."""
    return F.concat_ws("\t", *[null_text(cells[c], kind) for c, kind in (x.split() for x in TABLES[table].split(", "))])


def formatted(df: DataFrame, table: str) -> DataFrame:
    """One text column: the line of each row."""
    return df.select(write_line({c: F.col(c) for c in names(table)}, table).alias("value"))


def write_table(df: DataFrame, table: str, path: str, fmt: str = "tsv", mode: str = "error") -> None:
    if fmt == "tsv":
        formatted(df, table).write.mode(mode).text(path)
    else:
        df.select(*names(table)).write.mode(mode).format(fmt).save(path)


def write_tables(tables: dict[str, DataFrame], prefix: str, fmt: str = "tsv", mode: str = "error", part: str = "") -> dict[str, str]:
    """Each table into a folder ``{prefix}{table}{part}``."""
    paths = {t: f"{prefix}{t}{part}" for t in tables}
    for t, df in tables.items():
        write_table(df, t, paths[t], fmt, mode)
    return paths


def read_table(spark: SparkSession, table: str, path: str, fmt: str = "tsv") -> DataFrame:
    """A table with its types; product sequences get their kind, and an impossible set of nulls is an error."""
    schema = T._parse_datatype_string(TABLES[table])
    if fmt == "tsv":
        df = spark.read.csv(path, schema=schema, sep="\t", nullValue=NULL, quote="", mode="FAILFAST")
    else:
        df = spark.read.format(fmt).schema(schema).load(path)
    return checked(df.select(*names(table)), table)  # without the numbers of a stream's batches


def parsed(lines: DataFrame, table: str) -> DataFrame:
    """As ``read_table``, of lines (value)."""
    row = F.from_csv("value", F.lit(TABLES[table]), {"sep": "\t", "nullValue": NULL, "quote": "", "mode": "FAILFAST"})
    return checked(lines.select(row.alias("r")).select("r.*"), table)


def checked(df: DataFrame, table: str) -> DataFrame:
    return with_kind(df) if table == "seq" else checked_deletions(df) if table == "del" else df


def kind_of() -> Column:
    """data: no nulls; deleted: only the two alignments beside the keys; empty: only the keys; else null."""
    own = ["variant_hash", "aa_seq", "cds_id", "cds_seq", "query_coordinates", "cds_coordinates"]
    full = [F.col(c).isNotNull() for c in own]
    aln = [F.col(c).isNotNull() for c in ("aa_aln", "cds_aln")]
    every = lambda cs: F.array_min(F.array(*cs))
    some = lambda cs: F.array_max(F.array(*cs))
    return F.when(every(full) & every(aln), "data").when(~some(full) & every(aln), "deleted").when(~some(full) & ~some(aln), "empty")


def with_kind(df: DataFrame) -> DataFrame:
    bad = F.raise_error(F.concat(F.lit("impossible nulls in the row of "), F.col("query_id"))).cast("string")
    return df.withColumn("kind", F.coalesce(kind_of(), bad))


def checked_deletions(df: DataFrame) -> DataFrame:
    """variant_hash and cds_id are null together or not at all."""
    bad = F.col("variant_hash").isNull() != F.col("cds_id").isNull()
    return df.withColumn("variant_hash", F.when(bad, F.raise_error(F.lit("one hash of two")).cast("string")).otherwise(F.col("variant_hash")))


def check_paths(data: str, outputs: list[str]) -> None:
    """Outputs differ from the input and from each other; devices may repeat."""
    seen = {str(Path(data).resolve()): "the input"}
    for p in outputs:
        if p.startswith("/dev/"):
            continue
        full = str(Path(p).resolve())
        if full in seen:
            raise AnnotationError(f"{p} is {seen[full]}, too")
        seen[full] = "another output"
