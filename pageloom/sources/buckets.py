"""Tables stored by the hash of a key, so that what joins or merges on it moves nothing.

A table that is written once and joined or merged often pays for its exchange when it is
written. Buckets hold whole keys: a key that owns more rows than a bucket should have is kept
out of them (`operators/joins.py`), because no layout by hash divides it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .stage import work_dir

# Rows of a bucket, on average, and buckets at least.
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS = 8


def buckets_for(rows: int) -> int:
    """A power of two, so that tables of different sizes still divide each other's buckets."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """`df` written to the shared folder in `buckets` files, by `key` and sorted by it, and
    read back as a table that says so. The table is registered in the session's catalog."""
    spark = df.sparkSession
    name = f"pageloom_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", f"{work_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)
