"""Joins whose shape depends on the data: size-checked broadcasts and hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..sources.buckets import bucketed, buckets_for
from ..sources.stage import stage


def is_small(df: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> bool:
    """True when sums prove that `df` has at most `cfg.broadcast_rows` rows and
    `cfg.broadcast_bytes` bytes of text."""
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = sum((F.coalesce(t, F.lit(0)).cast("long") for t in texts), F.lit(0).cast("long"))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= cfg.broadcast_rows and (total or 0) <= cfg.broadcast_bytes


def small_or_shuffled(df: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Broadcast `df` only if it was counted and is small; else the join shuffles and
    adaptive execution splits its skewed partitions."""
    return F.broadcast(df) if is_small(df, cfg) else df


# Classes of targets by hash.
_CLASSES = 1 << 16


def _salt(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def resolve_links(
    links: DataFrame, vertices: DataFrame, how: str = "left_semi", cfg: C.ImportConfig = C.DEFAULT_CONFIG
) -> DataFrame:
    """Links whose target has (`left_semi`) or lacks (`left_anti`) a page.

    `vertices` is one row per vertex with `is_stub`. Targets are counted once and written. Those
    of a class by hash that owns more than `cfg.hot_key_rows` links are spread over
    `cfg.salt_buckets` tasks, and only their ids are repeated per bucket: every target that owns
    so many is among them, and classes are few enough to be known everywhere, so links shuffle
    once at most, and not where the targets that are wanted are few.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError("how must be left_semi or left_anti")
    counts = links.groupBy("dst").agg(F.count(F.lit(1)).alias("_n"))
    known = vertices.where(~F.col("is_stub")).select(F.col("vertex_id").alias("dst"))
    # One row per distinct target: whether it is known and how many links it owns.
    flags = counts.join(known.withColumn("_known", F.lit(True)), "dst", "left")
    flags = stage(flags.select("dst", F.coalesce("_known", F.lit(False)).alias("_known"), "_n"), "targets")
    class_ = _salt(["dst"], _CLASSES).alias("_class")
    owned = flags.groupBy(class_).agg(F.sum("_n").alias("_n"))
    hot = F.broadcast(owned.where(F.col("_n") > cfg.hot_key_rows).select("_class", F.lit(True).alias("_hot")))  # _CLASSES rows at most
    wanted = flags.where(F.col("_known") if how == "left_semi" else ~F.col("_known")).select("dst", class_).join(hot, "_class", "left")
    last = F.when(F.col("_hot"), cfg.salt_buckets - 1).otherwise(0)
    wanted = wanted.select("dst", F.explode(F.sequence(F.lit(0), last)).alias("_bucket"))
    salt = F.when(F.col("_hot"), _salt(["src", "start", "end", "seq"], cfg.salt_buckets)).otherwise(0)
    spread = links.select("*", class_).join(hot, "_class", "left").withColumn("_bucket", salt)
    found = spread.join(small_or_shuffled(wanted, cfg), ["dst", "_bucket"], "left_semi")
    return found.select("dst", *[c for c in links.columns if c != "dst"])


def resolve_bucketed(links: DataFrame, known: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Links whose target is in `known` (vertex_id, each once), both stored in buckets of the
    target, so that the join itself exchanges nothing; for links that are resolved again and
    again, against other pages. A target that owns more than `cfg.hot_key_rows` links stays
    out of the buckets: there are at most links / hot_key_rows of them, which are broadcast.
    """
    total = Observation()
    counts = links.groupBy("dst").agg(F.count(F.lit(1)).alias("_n")).observe(total, F.sum("_n").alias("n"))
    hot = stage(counts.where(F.col("_n") > cfg.hot_key_rows).select("dst"), "hot")
    target = known.select(F.col("vertex_id").alias("dst"))
    buckets = buckets_for(total.get.get("n") or 0)
    none_hot = hot.isEmpty()
    cool = links if none_hot else links.join(F.broadcast(hot), "dst", "left_anti")
    stored = bucketed(cool, "dst", buckets)
    # Merge join: both sides come sorted, and neither is collected.
    found = stored.join(bucketed(target, "dst", buckets).hint("merge"), "dst", "left_semi")
    if none_hot:
        return found
    known_hot = target.join(F.broadcast(hot), "dst", "left_semi")
    return found.unionByName(links.join(F.broadcast(known_hot), "dst", "left_semi").select(*found.columns))


def stubs_only(vertices: DataFrame) -> DataFrame:
    """Vertices that are linked to but have no page."""
    return vertices.where("is_stub")


def check_edge_types(
    edges: DataFrame,
    vertices: DataFrame,
    relationships: DataFrame,
    cfg: C.ImportConfig = C.DEFAULT_CONFIG,
) -> DataFrame:
    """Edges that break the domain or range of their relationship.

    An edge is fine when its source has the domain concept, its target the range
    concept, and its label is a declared relationship. The ontology is a handful of
    rows; end points are checked once per distinct (label, vertex), not once per edge,
    so a vertex with very many edges costs one row. Wrong end points are written; where
    they are few, edges do not shuffle. Edges may repeat; each is reported as often.
    """
    rules = small_or_shuffled(
        relationships.select(
            F.col("iri").alias("label"),
            F.col("domain_iri").alias("_domain"),
            F.col("range_iri").alias("_range"),
        ),
        cfg,
    )
    both = [F.struct(F.col(end).alias("vertex_id"), F.lit(end == "src").alias("_src")) for end in ("src", "dst")]
    ends = edges.select("label", F.inline(F.array(*both))).groupBy("label", "vertex_id")
    ends = ends.agg(F.max("_src").alias("_src"), F.max(~F.col("_src")).alias("_dst"))
    typed = ends.join(rules, "label", "left").join(vertices.select("vertex_id", "concept_type"), "vertex_id", "left")

    def is_wrong(used: str, needed: str) -> Column:
        bad = F.col(needed).isNull() | F.col("concept_type").isNull() | (F.col(needed) != F.col("concept_type"))
        return (F.col(used) & bad).alias(used)

    wrong = typed.select("vertex_id", "label", is_wrong("_src", "_domain"), is_wrong("_dst", "_range"))
    wrong = stage(wrong.where("_src OR _dst"), "wrong")

    def with_wrong(end: str, violation: str) -> DataFrame:
        ids = wrong.where(f"_{end}").select(F.col("vertex_id").alias(end), "label")
        found = edges.join(small_or_shuffled(ids, cfg), [end, "label"], "left_semi")
        return found.select(*edges.columns, F.lit(violation).alias("violation"))

    return with_wrong("src", "domain").unionByName(with_wrong("dst", "range"))
