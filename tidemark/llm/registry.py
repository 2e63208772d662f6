"""The queries of the training-data operators and, where SQL can say the same, that SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    jaccard_join,
    license_scan,
    line_dedup,
    oracles,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(documents(spark, sf_dir), "doc_id", "text", [1.0] * 40)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many lines go, which, the digest of the text that stays, and its longest repeated run."""
    found = line_dedup.runs_of_texts(documents(spark, sf_dir), of_kept=F.md5)
    return found.select("doc_id", "n_removed", F.array_join("removed_lines", ",").alias("removed_lines"), F.col("kept").alias("kept_md5"), "longest_run")


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 poor, 1 good but toxic, 2 good; kept from grade 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return quality_classifier.rate(documents(spark, sf_dir), labels, grade, floor=1)


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), n=3, percent=90)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_rendezvous_sharding, op2_substring_dedup, op3_toxicity, op4_line_dedup, op5_ordinal_quality, op6_vector_packing,
            op7_benchmark_decontamination, op8_license_scan, op9_jaccard_join, op10_quality_rules,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracles.all_sql()
