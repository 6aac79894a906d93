"""Merging of rows that share a key, with one fixed order instead of "last write wins".

A page row beats a row that was only derived from a link; among pages of the same
title the later one wins, then the content digest (see `RANK_COLUMNS`). All merges
combine on the map side first, so a key that holds a large share of the rows
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import vertex_id
from ..functions.strings import strip_fragment
from ..sources.stage import stage
from .graph import (
    RANK_COLUMNS,
    link_ends,
    page_properties,
    stub_properties,
    stub_titles,
)


def current_pages(pages: DataFrame) -> DataFrame:
    """The winning page of each vertex. The rank filter limits each group before the
    shuffle as well, so a title with very many copies does not gather in one task."""
    order = [F.col(c).desc_nulls_last() for c in RANK_COLUMNS]
    w = Window.partitionBy("vertex_id").orderBy(*order)
    return (
        pages.withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_vertices(vertices: DataFrame) -> DataFrame:
    """One row per vertex; it is a stub only if no page of its own was seen."""
    return vertices.groupBy("vertex_id", "concept_type").agg(F.min("is_stub").alias("is_stub"))


def merge_edges(pairs: DataFrame) -> DataFrame:
    """One row per (src, dst), before ids and labels are attached."""
    return pairs.select("src", "dst").distinct()


def edge_id_collisions(edges: DataFrame) -> DataFrame:
    """Edge ids that stand for more than one (src, dst): ids are joined with `_`,
    which titles may contain."""
    return (
        edges.groupBy("edge_id")
        .agg(F.count(F.lit(1)).alias("n_edges"), F.min("src").alias("first_src"), F.max("src").alias("last_src"))
        .where(F.col("n_edges") > 1)
    )


def merge_mentions(links: DataFrame) -> DataFrame:
    """One link per (src, start, end): the one of the winning page, and in it the last.

    Needs `RANK_COLUMNS` next to each link.
    """
    return (
        links.groupBy("src", "start", "end")
        .agg(
            F.max_by(
                F.struct("target", "dst"),
                F.struct(*RANK_COLUMNS, "seq"),
            ).alias("_link")
        )
        .select("src", "start", "end", "_link.target", "_link.dst")
    )


def hot_vertices(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, folder: str | None = None) -> DataFrame | None:
    """Vertices that own more than `cfg.hot_key_rows` of the (stored) pages, written; None where
    there are none. There are at most pages / hot_key_rows of them."""
    counts = pages.groupBy("vertex_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(counts.where(F.col("_n") > cfg.hot_key_rows).select("vertex_id"), "hot", folder)
    return None if hot.isEmpty() else hot


def last_links(links: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """As `merge_mentions`, with the rank of the page that the link is of, which a later merge
    needs. A row has its rank once, and what follows from the target is made again."""
    best = links.groupBy("src", "start", "end").agg(F.max(F.struct(*RANK_COLUMNS, "seq", "target")).alias("_l"))
    dst = vertex_id(F.col("_l.target"), cfg).alias("dst")
    return best.select("src", "start", "end", "_l.target", dst, *[f"_l.{c}" for c in (*RANK_COLUMNS, "seq")])


def merge_page_links(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, hot: DataFrame | None = None) -> DataFrame:
    """`last_links` of all links of pages. A page travels as one row, with its rank once, to
    where its vertex is, and its links are merged there. The pages of `hot_vertices` stay out of
    that: their links combine before they travel."""
    link = lambda k: F.struct(strip_fragment(k["target"]).alias("target"), k["start"].alias("start"), k["end"].alias("end"))
    narrow = pages.select(F.col("vertex_id").alias("src"), *RANK_COLUMNS, F.transform("links", link).alias("links"))

    def merged(rows: DataFrame) -> DataFrame:
        links = rows.select("src", *RANK_COLUMNS, F.posexplode("links").alias("pos", "l"))
        return last_links(links.select("src", *RANK_COLUMNS, (F.col("pos") + 1).alias("seq"), "l.target", "l.start", "l.end"), cfg)

    if hot is None:
        return merged(narrow.repartition("src"))
    ids = F.broadcast(hot.select(F.col("vertex_id").alias("src")))
    return merged(narrow.join(ids, "src", "left_anti").repartition("src")).unionByName(merged(narrow.join(ids, "src", "left_semi")))


def merge_targets(targets: DataFrame) -> DataFrame:
    """Spellings of a target that differ only in outer white space are one vertex and
    one title key; the greatest spelling stays."""
    return targets.groupBy("vertex_id").agg(F.max("target").alias("target"))


def merge_properties(properties: DataFrame) -> DataFrame:
    """General merge of property rows: (vertex_id, name, key) is the identity.

    Needs `own` (true for rows of the page itself) and `RANK_COLUMNS`; rows that come from links carry nulls there.
    """
    payload = ["value", "value_ts", "value_bin", "metadata", "indexed", "visibility"]
    order = ["own", *RANK_COLUMNS, "value"]
    return (
        properties.groupBy("vertex_id", "name", "key")
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_p"))
        .select("vertex_id", "name", "key", *[f"_p.{c}" for c in payload])
    )


def graph_vertices(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """`merge_vertices` of the pages and of all that they link to, in one pass over the pages
    and one shuffle of ids."""
    own = F.array(F.struct("vertex_id", F.lit(False).alias("is_stub")))
    stubs = F.transform(link_ends(cfg), lambda v: F.struct(v.alias("vertex_id"), F.lit(True).alias("is_stub")))
    ids = pages.select(F.inline(F.concat(own, F.coalesce(stubs, F.array())))).where(F.col("vertex_id").isNotNull())
    merged = ids.groupBy("vertex_id").agg(F.min("is_stub").alias("is_stub"))
    return merged.select("vertex_id", F.lit(cfg.page_concept_iri).alias("concept_type"), "is_stub")


def graph_properties(
    current: DataFrame, targets: DataFrame, vertices: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG
) -> DataFrame:
    """All narrow properties. The three parts have disjoint keys, so nothing wide has
    to be merged: pages are already one per vertex, and a linked vertex with a page
    of its own has the constant properties from that page."""
    own = page_properties(current, cfg)
    constants = stub_properties(vertices.where("is_stub"), cfg)
    titles = stub_titles(merge_targets(targets), cfg)
    return own.unionByName(constants).unionByName(titles)


def title_candidates(properties: DataFrame) -> DataFrame:
    """Every title of a vertex with its confidence."""
    return properties.where(F.col("name") == C.TITLE).select(
        "vertex_id",
        "key",
        F.col("value").alias("title"),
        F.element_at("metadata", "confidence").cast("double").alias("confidence"),
    )


def best_title(candidates: DataFrame) -> DataFrame:
    """Highest confidence first, then the greatest spelling."""
    return candidates.groupBy("vertex_id").agg(
        F.max_by("title", F.struct("confidence", "title")).alias("title"),
        F.max("confidence").alias("confidence"),
    )
