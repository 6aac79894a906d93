"""Tables stored by the hash of a key."""

import pytest
from pyspark.sql import functions as F

from pageloom import config as C
from pageloom.operators.joins import resolve_bucketed
from pageloom.operators.merge import merge_properties
from pageloom.sources.buckets import bucketed, buckets_for


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_number_of_buckets():
    assert [buckets_for(n) for n in (0, 1, 16_000_000, 16_000_001, 64_000_001)] == [8, 8, 8, 16, 64]


@pytest.mark.parametrize("hot", [10**6, 50])
def test_links_are_resolved_without_an_exchange(spark, hot):
    links = spark.range(3000).select(
        F.concat(F.lit("s"), "id").alias("src"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 70)).alias("dst")
    )
    known = spark.range(0, 70, 2).select(F.concat(F.lit("d"), "id").alias("vertex_id")).unionByName(spark.sql("select 'hot' vertex_id"))
    got = resolve_bucketed(links, known, C.ImportConfig(hot_key_rows=hot))
    want = links.join(known.withColumnRenamed("vertex_id", "dst"), "dst", "left_semi").select("src", "dst")
    got = got.select("src", "dst")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = plan_of(got)
    assert "SortMergeJoin" in plan
    if hot == 10**6:
        assert "Exchange" not in plan
    else:
        assert "Exchange hashpartitioning(dst" not in plan


def test_a_merge_by_vertex_exchanges_nothing(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("v"), F.col("id") % 40).alias("vertex_id"), F.lit("N").alias("name"), F.lit("").alias("key"),
        *[F.col("id").cast("string").alias(c) for c in ("value", "value_ts", "value_bin", "metadata", "indexed", "visibility")],
        F.lit(True).alias("own"), F.lit(None).cast("timestamp").alias("published_ts"), F.col("id").cast("string").alias("content_md5"),
        F.lit("t").alias("title"), F.lit("f").alias("file"),
    )
    merged = merge_properties(bucketed(rows, "vertex_id", 8))
    assert "Exchange" not in plan_of(merged)
    assert merged.exceptAll(merge_properties(rows)).isEmpty() and merged.count() == 40
