"""The queries of this subpackage, each over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import compression, decontaminate, html, licenses, neardup, packing, pii, quality, tokens, urls
from .kit import small_batches

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_metrics(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_license_scan, op2_minhash_near_dedup, op3_token_output, op4_quality_rules, op5_decontamination, op6_packing, op7_personal_data, op8_quality_classifier, op9_html_extraction, op10_url_filters)}
ORACLE_SQL: dict[str, str] = {"op1_license_scan": licenses.ORACLE, "op4_quality_rules": quality.ORACLE, "op5_decontamination": decontaminate.ORACLE, "op10_url_filters": urls.ORACLE}
