"""Text files of sections: a header line, then the section's rows. Files of any size, read by Spark in blocks.

A block's rows know the headers before them in the block; the last header of each block is carried over to the blocks
after it, one row for each block, so no task reads a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.functions.iupac import CODES
from strandlake.plans.tables import held, repeated, without

WEIGHTS = "reference_id string, product_name string, position int, codon string, count long"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, with the file, the block's first byte, and a number that ascends within a block."""
    raw = spark.read.text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def carried(lines: DataFrame, header: Column, name: str = "section", file: str = "file", block: str = "block", at: str = "at") -> DataFrame:
    """``lines`` with the last header (not null where a line is one) at or before each line of its file; null before
    the first. ``at`` orders the lines of a block."""
    marked = lines.withColumn(name, header)
    within = Window.partitionBy(file, block).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    last = marked.groupBy(file, block).agg(F.max_by(name, F.when(F.col(name).isNotNull(), F.col(at))).alias("last__"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    earlier = last.select(file, block, F.last("last__", ignorenulls=True).over(before).alias("earlier__"))
    out = marked.withColumn(name, F.last(name, ignorenulls=True).over(within)).join(earlier, [file, block])
    return out.select(*lines.columns, F.coalesce(name, "earlier__").alias(name))


def _fail(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), value)).cast("string")


def parse_weights(lines: DataFrame) -> DataFrame:
    """WEIGHTS of lines (value, file, block, at): headers ``#reference_id|product``, rows ``position codon count``.

    Codons become upper-case with T for U. Blank lines count for nothing. Reading fails where a row stands before any
    header or isn't a weight, and where a section or a weight is repeated or a section empty. A file without any row
    gives none, whatever its headers.
    """
    full = lines.filter(F.trim("value") != "")
    is_header = F.col("value").startswith("#")
    parts = F.split(F.substr("value", F.lit(2)), r"\|")
    key = [F.btrim(F.get(parts, i), F.lit(" \r\n")) for i in (0, 1)]
    fine = (F.size(parts) >= 2) & (key[0] != "") & (key[1] != "") & (F.instr(key[0], "\t") == 0) & (F.instr(key[1], "\t") == 0)
    # a name for each header, so that a repeated one isn't taken for the same section
    header = F.when(is_header, F.struct(F.when(fine, key[0]).otherwise(_fail("not a reference header: ", F.substr("value", F.lit(2)))).alias("reference_id"), key[1].alias("product_name"), "file", "block", "at"))
    told = carried(full, header)
    cells = F.split(F.btrim("value"), r"\s+")
    codon = F.translate(F.upper(F.get(cells, 1)), "U", "T")
    fine = (F.size(cells) == 3) & codon.rlike("^[" + "".join(CODES) + "]{3}$") & F.get(cells, 0).rlike("^[0-9]+$") & F.get(cells, 2).rlike("^[0-9]+$") & (F.try_to_number(F.get(cells, 0), F.lit("9" * 18)) >= 1)
    lost = F.col("section").isNull()
    checked = F.when(lost, F.raise_error(F.lit("weights before the first section")).cast("string")).when(~fine, _fail("not a weight: ", F.col("value"))).otherwise(codon)
    rows = told.filter(~is_header).select("section", F.get(cells, 0).alias("p"), checked.alias("codon"), F.get(cells, 2).alias("n"))
    rows = rows.select("section.reference_id", "section.product_name", F.col("p").try_cast("int").alias("position"), "codon", F.col("n").try_cast("long").alias("count"), "section")
    sections = told.filter(is_header).select("section.reference_id", "section.product_name", "section")
    name = F.concat(F.lit("('"), F.concat_ws("', '", "reference_id", "product_name"), F.lit("')"))
    problems = repeated(sections, ["reference_id", "product_name"]).select(F.concat(F.lit("repeated section: "), name).alias("message"), F.lit(0).alias("place"))
    empty = without(sections, rows, ["reference_id", "product_name"]).select(F.concat(F.lit("empty section: "), name).alias("message"), F.lit(1).alias("place"))
    twice = repeated(rows, ["reference_id", "product_name", "position", "codon"])
    twice = twice.select(F.concat(F.lit("repeated weight: "), name, F.lit(" "), F.concat_ws(" ", "position", "codon")).alias("message"), F.lit(2).alias("place"))
    return held(rows.drop("section"), problems.unionByName(empty).unionByName(twice))


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    return parse_weights(text_lines(spark, path))
