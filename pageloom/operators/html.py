"""HTML pages as a second source of links: anchors give the same link structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.entities import decode_entities
from ..functions.ids import vertex_id
from .markup import (
    LINE,
    MARK,
    NEWLINE_RULES,
    apply_rules,
    closers,
    drop_illegal,
    hide_closed,
    links_of_marked,
)

_HIDDEN = r"(?is)<(?:!--.*?-->|(script|style)\b[^>]*+>.*?</\1\s*>)"
# Groups: 1 the target with its quotes, if it has any; 2 the body.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++)"""
_ANCHOR = (
    rf"""(?is)<a(?:[\s/]++(?!href\s*+=)[^\s=<>"'/]++(?:\s*+=\s*+{_VALUE})?+)*+"""
    rf"""[\s/]++href\s*+=\s*+({_VALUE})(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>(.*?)</a\s*>"""
)
_QUOTED = r"""(?s)\A(["'])(.*)\1\z"""
_TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"


def _hide(c: Column) -> Column:
    return hide_closed(c, _HIDDEN, closers(("script", "style")))


def _open_elements(c: Column) -> Column:
    c = F.regexp_replace(c, r"<(?i:br)\s*+/?>", LINE)
    return F.regexp_replace(c, r"<[!/]?[a-zA-Z][^<>]*+>", "")


def _target(quoted: Column) -> Column:
    """What an attribute says: without its quotes, trimmed, references decoded."""
    return decode_entities(F.trim(F.regexp_replace(quoted, _QUOTED, "$2")))


def resolve_target(target: Column, url: Column) -> Column:
    """A relative target, seen from the page at `url`. Dot segments stay as they are."""
    site = F.regexp_extract(url, r"\A([a-zA-Z][\w+.-]*+://[^/?#]*+)", 1)
    folder = F.regexp_extract(url, r"\A([^?#]*/)", 1)
    scheme = F.regexp_extract(url, r"\A([a-zA-Z][\w+.-]*+:)", 1)
    return (
        F.when(F.rlike(target, F.lit(r"\A[a-zA-Z][\w+.-]*+:")) | (site == ""), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when(F.rlike(target, F.lit(r"\A[?#]|\A\z")), F.concat(F.regexp_extract(url, r"\A([^?#]*+)", 1), target))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(site) + 1, folder).otherwise(F.concat(site, F.lit("/"))), target))
    )


def html_pages(html: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, resolve: bool = False) -> DataFrame:
    """(url, html) rows -> the page table of the graph builders.

    Comments, scripts and styles are hidden, `br` is a new line, other elements keep
    their body, references are decoded; each anchor is a link with offsets. Targets may
    be quoted in either way or not at all; with `resolve` they are seen from the page's url,
    so that they can meet the vertices of other pages.
    """
    df = html.withColumn("_markup", F.col("html"))
    df = apply_rules(df, "_markup", (("illegal", drop_illegal), ("hidden", _hide)))
    df = df.withColumn("_targets", F.transform(F.regexp_extract_all("_markup", F.lit(_ANCHOR), F.lit(1)), _target))
    if resolve:
        df = df.withColumn("_targets", F.transform("_targets", lambda t: resolve_target(t, F.col("url"))))
    df = df.withColumn("_markup", F.regexp_replace("_markup", _ANCHOR, f"{MARK}$2{MARK}"))
    df = apply_rules(
        df,
        "_markup",
        (("elements", _open_elements), *NEWLINE_RULES, ("entities", decode_entities)),
    )
    df = links_of_marked(df, "_markup", "_targets").drop("_markup", "_targets")
    df = df.select("url", "html", F.inline_outer(F.array(F.struct("text", "links"))))
    df = df.withColumn("title", F.regexp_extract("html", _TITLE, 1))
    df = df.withColumn("title", decode_entities(F.col("title")))
    return df.select(
        F.col("html").alias("raw"),
        F.element_at(F.split("url", "/"), -1).alias("file"),
        "title",
        F.col("html").alias("wikitext"),
        F.lit(None).cast("timestamp").alias("published_ts"),
        F.col("url").alias("source_url"),
        vertex_id(F.col("url"), cfg).alias("vertex_id"),
        F.lit(C.STATUS_OK).alias("status"),
        F.md5("html").alias("content_md5"),
        "text",
        "links",
    )
