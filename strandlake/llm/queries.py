"""The queries of this subpackage and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import bpe, fingerprints, jaccard, langid, linededup, manifest, mtree, neighbours, packing, pii, quality, secrets, trie

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_jaccard_grouped_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op2_secret_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_pack_powers_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), byte_bpe()))


def op4_language_id_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op5_pii_information_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(table(spark, sf_dir, "documents")))


def op6_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), byte_bpe(), keep_ids=False).drop("ids")


def op7_quality_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_improbable_feature_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_next(table(spark, sf_dir, "documents"))


def op10_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(trie.turns(table(spark, sf_dir, "conversations"))))


def op12_merkle_preimage_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of seven or so claims one character more than it has."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return manifest.verify(table(spark, sf_dir, "documents"), tampered, more, ["doc_id", "source", "lang", "n_chars", "text"], "lang")


def op13_mtree_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup_runs": linededup.ORACLE, "op11_conversation_prefix_trie": trie.ORACLE, "op12_merkle_preimage_paths": manifest.ORACLE, "op13_mtree_inner_products": mtree.ORACLE}
