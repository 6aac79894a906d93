"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays,
contaminated documents go, secrets are masked, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it to the shared
folder and gives what it reads back to the next one. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.common import staged, table
from pageloom.llm.decontamination import decontaminate
from pageloom.llm.neardup import drop_near_duplicates
from pageloom.llm.packing import pack_documents
from pageloom.llm.secret_scan import redact
from pageloom.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model learns from the labelled rows of the
    input that are not held out."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id stays of each group."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any hit word go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked and n_chars follows the text."""
    masked = redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind)
    return masked.withColumn("n_chars", length).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Learned scores and token ids are beyond SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
