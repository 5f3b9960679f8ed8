"""One query for each operator over its whole table, with the columns its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow.llm import (
    clustering,
    decontamination,
    fill_in_middle,
    language,
    licenses,
    line_dedup,
    packing,
    personal_data,
    quality,
    secrets,
    sharding,
    simhash,
    token_counts,
)
from retailflow.llm.common import documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(documents(spark, sf_dir), benchmark)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.train_on_documents(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("blocks")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir)).drop("lines_removed")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    base = secrets.joined(F.col("spans"), ["assign", "access", "hex"])
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(base, 256).alias("base_sha256"),
        secrets.joined(F.col("spans"), list(secrets.KINDS)).alias("spans"),
        "n_live",
        "n_example",
    )


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    numbers = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(numbers, 256).alias("centroid_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, sf_dir))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(documents(spark, sf_dir))
    base = personal_data.KINDS[: personal_data.ADDED]
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in base],
        F.sha2(personal_data.joined(F.col("spans"), base), 256).alias("base_sha256"),
        personal_data.joined(F.col("spans")).alias("spans"),
        "n_identifier",
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_sharding": op7_sharding,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_clustering": op11_clustering,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_personal_data": op13_personal_data,
}
