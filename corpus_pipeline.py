"""A training corpus from ``documents``: quality rules, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents; the last returns the pieces of the documents with their
sequence and offset.

A document without doc_id can't be named by another table: near-duplicate
removal lets it pass. Rows that are equal in doc_id and text are one
document there. Texts that are null fail the quality rules. Empty tables
pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm import mixing, packing, quality, secret_scan, superminhash
from salesmart.llm.tokens import tokenizer_path
from salesmart.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents with their failing lines removed."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, by five-word shingles at 0.8."""
    named = docs.where("doc_id IS NOT NULL")
    kept = superminhash.near_duplicates(named.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    first = Window.partitionBy("doc_id", "__text").orderBy("__text")
    stays = (named.join(kept, named["doc_id"] == kept["__id"], "left_semi").withColumn("__text", F.xxhash64("text"))
             .withColumn("__rank", F.row_number().over(first)).where("__rank = 1").select(*_columns(docs)))
    return stays.unionByName(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their secrets replaced."""
    return secret_scan.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none to two times."""
    return mixing.take(docs, scratch_dir(spark, "pipeline-mixing"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"), 1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Near-duplicate groups and packing can't be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
