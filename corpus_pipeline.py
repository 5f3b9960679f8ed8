"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last
returns the pieces of packed sequences. ``run`` writes every stage's rows to the shared folder
and reads them back, so a lost executor repeats tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailflow import files
from retailflow.llm import decontamination, language, line_dedup, packing, simhash
from retailflow.session import scratch_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language; those without a letter or a clear language go."""
    return language.keep_identified(docs, language.train_on_documents(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; emptied documents go."""
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of ``benchmark``."""
    return decontamination.drop_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences, with their tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: Trained models, SimHash components, tilings and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``; a stage's rows are deleted once the next one's are
    written, so two copies of the corpus are there at a time."""
    rows, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
        if before:
            files.delete(spark, before)
        before = path
    return rows
