"""Annotation of queries as they arrive. Every step is per row, so micro-batches give the tables of one batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandlake.plans.annotate import annotate, prepare
from strandlake.plans.module import Module
from strandlake.sources.queries import parse_lines
from strandlake.sources.tables import write_tables


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-delimited query files that appear in a folder."""
    return parse_lines(spark.readStream.text(folder))


def annotate_stream(raw: DataFrame, module: Module, prefix: str, checkpoint: str, default_ctype: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """The six tables of each micro-batch go to ``{prefix}{table}/batch_id={number}``. A batch that is tried again
    writes over what it left, so no row comes twice."""

    def each(batch: DataFrame, number: int) -> None:
        done = annotate(prepare(batch, default_ctype), module)
        try:
            write_tables(done.tables(), prefix, fmt, "overwrite", f"/batch_id={number}")
        finally:
            done.kept.unpersist()

    return raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
