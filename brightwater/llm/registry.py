"""The queries of this package, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import oracle
from .decontamination import find_leaks
from .exact_dedup import exact_dedup
from .html_extract import html_extract
from .language_id import language_id
from .license_scan import license_scan
from .mixing import mix_sources
from .ngram_join import ngram_join
from .packing import pack_documents
from .pii import replace_pii
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .ranked_search import ranked_search
from .spelling import spelling_variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_pii(table(spark, sf_dir, "documents"), key="brightwater")
    return out.select("doc_id", "text", "n_entities", F.array_join("entity_kinds", ",").alias("entity_kinds"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), host=F.col("source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("matches")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    ship_package(spark)
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k == "pipeline" or k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
