"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cubeguard.llm import conversation_repair, cover_search, exact_dedup, html_extract, language_id, minhash_dedup, mixing, packing, periodic_runs, pii, secrets, suffix_dedup, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(_table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op5_cover_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_search.top_k(_table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_table(spark, sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_packing, op3_exact_dedup, op4_html_extract, op5_cover_search, op6_pii, op7_secrets, op8_mixing,
                                   op9_language_id, op10_minhash_dedup, op11_suffix_dedup, op12_periodic_runs, op13_conversation_repair)}

ORACLES = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op5_cover_search": cover_search.ORACLE,
}
