"""Where redirects lead, through chains of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..sources.stage import stage, work_dir
from .graph import all_links
from .joins import small_or_shuffled


def redirects_of(current: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """src, dst: where each vertex redirects to. `current` has one page per vertex."""
    return all_links(current, cfg=cfg).where(F.col("kind") == C.KIND_REDIRECT).select("src", "dst")


def follow_redirects(redirects: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, folder: str | None = None) -> DataFrame:
    """src, target, hops, in_cycle for redirects (src once, dst): the first vertex on the way
    that does not redirect, and how many redirects lead there; null where the way never ends.

    Pointer jumping: a redirect that leads to another takes over where that one leads by now,
    so ways double in length each round, and rounds grow with the logarithm of the longest.
    On a way that ends, what is nearest to its end of all that is open ends in the next round;
    so where a round ends none, all that is open runs into a cycle. Only ids travel. A vertex
    that very many redirect to is looked up once and joined back, by a broadcast if what is
    looked up is small, else by a shuffle whose skewed partitions are split.
    """
    folder = folder or work_dir(redirects.sparkSession)
    first = redirects.select("src", F.col("dst").alias("to"), F.lit(1).cast("long").alias("hops"))
    sources = redirects.select(F.col("src").alias("to"), F.lit(True).alias("_onward"))
    ended = _looked_up(first, sources, cfg).select("src", "to", "hops", F.col("_onward").isNull().alias("ended"))
    ways = stage(ended, "ways_0", folder)
    n_open, round_ = ways.where("NOT ended").count(), 0
    while n_open:
        round_ += 1
        onward = ways.select(F.col("src").alias("to"), F.col("to").alias("_to"), F.col("hops").alias("_hops"), F.col("ended").alias("_ended"))
        jumped = _looked_up(ways.where("NOT ended").drop("ended"), onward, cfg)
        jumped = jumped.select("src", F.col("_to").alias("to"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_ended").alias("ended"))
        ways = stage(ways.where("ended").unionByName(jumped), f"ways_{round_}", folder)
        before, n_open = n_open, ways.where("NOT ended").count()
        if n_open == before:
            break
    known = F.col("ended")
    return ways.select("src", F.when(known, F.col("to")).alias("target"), F.when(known, F.col("hops")).alias("hops"), (~known).alias("in_cycle"))


def _looked_up(rows: DataFrame, values: DataFrame, cfg: C.ImportConfig) -> DataFrame:
    """`rows` left-joined with `values` (one row per `to`), which are looked up once per `to`."""
    found = values.join(rows.select("to").distinct(), "to", "left_semi")
    return rows.join(small_or_shuffled(found, cfg), "to", "left")


def through_redirects(links: DataFrame, followed: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """`links` with `final_dst`: where their target leads; itself if that is no redirect or
    runs into a cycle."""
    ends = followed.where("target IS NOT NULL").select(F.col("src").alias("dst"), F.col("target").alias("final_dst"))
    wanted = ends.join(links.select("dst").distinct(), "dst", "left_semi")
    joined = links.join(small_or_shuffled(wanted, cfg), "dst", "left")
    return joined.withColumn("final_dst", F.coalesce("final_dst", "dst")).select(*links.columns, "final_dst")
