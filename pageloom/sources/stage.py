"""Intermediate tables: written once to the shared folder, read many times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Of tables that the library writes for itself: pages hold raw text and the text made of it,
# which this makes much smaller than Spark's default does.
CODEC = "zstd"


def work_dir(spark: SparkSession) -> str:
    """A fresh folder that all executors share: below the one the cluster names in
    `spark.checkpoint.dir`, or below the warehouse where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/pageloom-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write `df` as a table and read it back. This cuts the lineage: a lost executor
    costs a re-read, and each reader scans only the columns it uses."""
    path = f"{folder or work_dir(df.sparkSession)}/{name}"
    df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)
