"""Reading tables, writing intermediate ones, and small column helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that Spark hands to Python at once. Texts may be long, so a batch is small.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below the one that the cluster names
    in spark.checkpoint.dir, or below the warehouse where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, *sort: str) -> DataFrame:
    """`df` written to the shared folder and read back: its lineage is cut there, so a lost
    executor costs a read, and what it decides at random is decided once."""
    path = shared_folder(df.sparkSession)
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def python_ready(spark: SparkSession) -> None:
    """Before Python runs in tasks: Spark sends this package to the executors, and an Arrow
    batch has BATCH_ROWS rows at most (or fewer, if the session says so)."""
    if int(spark.conf.get(ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "package.zip"  # the driver's own; Spark serves it
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(spark.sparkContext.applicationId)


def text_key(text: Column) -> Column:
    """Equal for equal texts only; null counts as the empty text."""
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "utf-8"), 256)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
