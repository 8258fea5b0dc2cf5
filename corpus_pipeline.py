"""Cleaning a corpus, stage by stage: each stage reads the table that the one before it wrote.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of documents.

Null texts, ids and other fields pass every stage without an error; what becomes of such rows is said there. Stages
treat repeated rows alike unless said otherwise, make no rows of an empty table, and carry all further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import jaccard, langid, linededup, packing, secrets
from strandlake.llm.queries import byte_bpe
from strandlake.llm.runtime import Scratch, temporary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, as no language can be told. Where none could be learned, all that have a text
    with a letter stay. Null and empty texts go. Equal texts have equal fates."""
    model = langid.fit(docs)
    if not model.groups:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return langid.keep_identified(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that has nothing left but was not empty goes, too. Null texts become
    empty ones. Of equal lines the smallest doc_id keeps its own; rows of one doc_id are one document."""
    out = linededup.dedup_lines(docs).filter(~((F.col("n_dropped") > 0) & (F.col("text") == "")))
    return with_length(out).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id. Documents of one or two words are
    a set of one shingle, those without words stay; rows without doc_id come after all others."""
    return jaccard.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, null texts as they are."""
    return with_length(secrets.redact(docs)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of each row's token ids, the row's end included, so a null or empty text gives one piece."""
    return packing.digest(packing.pack(docs, byte_bpe()))


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: The language model, the components and the ids can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of what all stages keep of documents. When a stage's table is written, those that it was made from
    are deleted; the last one stays, as the result reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    before = None
    for name, stage in STAGES[:-1]:
        with temporary(spark):
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
