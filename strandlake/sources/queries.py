"""Query sequences from FASTA and tab-delimited files, as id, ctype, seq."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.schema import AnnotationError

BLANK = r"^\s*$"


def _fail(bad, message, value):
    return F.when(bad, F.raise_error(message).cast("string")).otherwise(value)


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """header, seq of each record; a sequence may span lines. The reader splits at record starts, so files of many
    records are read in parallel."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    record = F.regexp_replace("value", "^>", "")
    header = F.regexp_replace(F.substring_index(record, "\n", 1), "\r$", "")
    body = F.when(F.instr(record, "\n") > 0, F.substr(record, F.instr(record, "\n") + 1)).otherwise(F.lit(""))
    return raw.filter(~F.col("value").rlike(BLANK)).select(header.alias("header"), F.regexp_replace(body, r"[\r\n]", "").alias("seq"))


def parse_fasta_header(records: DataFrame) -> DataFrame:
    """``id|ctype[|...]``: the parts are trimmed and the ctype must not be empty; without | all is the id."""
    parts = F.split("header", r"\|")
    named = F.instr("header", "|") > 0
    ctype = F.trim(F.try_element_at(parts, F.lit(2)))
    checked = _fail(named & (F.coalesce(ctype, F.lit("")) == ""), F.concat(F.lit("no ctype in header: "), F.col("header")), ctype)
    return records.select(F.when(named, F.trim(parts[0])).otherwise(F.col("header")).alias("id"), F.when(named, checked).alias("ctype"), "seq")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    return parse_fasta_header(fasta_records(spark, path))


def parse_lines(lines: DataFrame) -> DataFrame:
    """``id, seq`` or ``id, ctype, seq`` by tabs; fields are trimmed, blank lines skipped, further columns ignored."""
    parts = F.split("value", "\t")
    field = [F.trim(F.try_element_at(parts, F.lit(k))) for k in (1, 2, 3)]
    n = F.size(parts)
    seq = _fail(n < 2, F.concat(F.lit("a line needs two columns or more: "), F.col("value")), F.when(n >= 3, field[2]).otherwise(field[1]))
    ctype = _fail((n >= 3) & (field[1] == ""), F.concat(F.lit("empty ctype: "), F.col("value")), F.when(n >= 3, field[1]))
    return lines.filter(~F.col("value").rlike(BLANK)).select(field[0].alias("id"), ctype.alias("ctype"), seq.alias("seq"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


def detect_format(spark: SparkSession, path: str) -> str:
    """``fasta`` if the first byte is >, else ``tsv``; an empty input is an error."""
    first = spark.read.option("wholetext", False).text(path).limit(1).collect()
    if not first:
        raise AnnotationError(f"empty input: {path}")
    return "fasta" if first[0]["value"].startswith(">") else "tsv"


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    return (read_fasta if detect_format(spark, path) == "fasta" else read_tsv)(spark, path)
