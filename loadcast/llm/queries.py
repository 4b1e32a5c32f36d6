"""The registered queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.codes import vector_codes
from loadcast.llm.decontam import contamination
from loadcast.llm.jaccard import jaccard_components
from loadcast.llm.language import language
from loadcast.llm.lines import line_dedup
from loadcast.llm.mixing import mix
from loadcast.llm.phrases import remove_repeats
from loadcast.llm.pii import personal_data
from loadcast.llm.quality import quality
from loadcast.llm.secrets import secrets
from loadcast.llm.simhash import simhash_components
from loadcast.llm.toxicity import toxicity
from loadcast.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the trusted target."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality(table(spark, sf_dir, "documents"), trusted)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on ten sources or more go; the text that is left is given by its digest."""
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length("kept_text").cast("long").alias("kept_chars"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_personal_data": op7_personal_data,
    "op8_line_dedup": op8_line_dedup,
    "op9_pfair_mixing": op9_pfair_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_simhash_dedup": op13_simhash_dedup,
}
