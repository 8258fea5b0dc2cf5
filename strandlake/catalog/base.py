"""Relations derived from the tables, the same in both engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
HEX, NT = "0123456789abcdef", "ACGTACGTACGTACGT"
#: Some codes of more than one base among the sixteen digits.
IUPAC16 = "ACGTRYSWKMACGTNU"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows in even shares for all cores, where what follows costs far more than moving them."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def nt_of(key: Column, salt: str = "", letters: str = NT) -> Column:
    """32 bases for a key."""
    return F.translate(F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary")), HEX, letters)


def sql_nt(key: str, salt: str = "", letters: str = NT) -> str:
    return f"translate(md5(CAST({key} AS VARCHAR) || '{salt}'), '{HEX}', '{letters}')"


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


#: Codons in DuckDB: a list of (codon, amino acid) built from the code's own order.
SQL_AMINO = (
    "CASE WHEN regexp_full_match(replace({c}, 'U', 'T'), '[TCAG]{{3}}') THEN substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', "
    "16 * (instr('TCAG', substr(replace({c}, 'U', 'T'), 1, 1)) - 1) + 4 * (instr('TCAG', substr(replace({c}, 'U', 'T'), 2, 1)) - 1) + instr('TCAG', substr(replace({c}, 'U', 'T'), 3, 1)), 1) "
    "WHEN {c} = '---' THEN '-' WHEN regexp_full_match({c}, '[-.]{{3}}') THEN '.' WHEN length({c}) < 3 OR regexp_matches({c}, '[-.]') THEN '~' ELSE 'X' END"
)


def sql_amino(codon: str) -> str:
    return SQL_AMINO.format(c=codon)


def sql_aminos(seq: str) -> str:
    """A list of the amino acids of the whole codons."""
    return f"list_transform(range(0, CAST(length({seq}) // 3 AS BIGINT)), lambda i: {sql_amino(f'substr({seq}, CAST(3 * i + 1 AS BIGINT), 3)')})"
