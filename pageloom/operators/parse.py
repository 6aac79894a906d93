"""Page XML -> page fields, outcome and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import vertex_id
from ..functions.strings import empty_if_null, iso_timestamp
from ..functions.xmltext import (
    has_sections,
    is_one_page,
    is_plain_page,
    own_text,
    plain_fields,
    plain_text,
    plain_time,
    plain_title,
    text_bodies,
    without_sections,
)
from ..schemas import CORRUPT, PAGE_XML
from .markup import convert_markup, empty_redirect, keep_apart

# A title with one of these is not a page title.
_BAD_TITLE = r"[\[\]{}<>|]"


def parse_pages(raw_pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Read title, wikitext and timestamp out of `raw` page XML.

    Title: the first one. Wikitext: all revisions' texts in order. Timestamp: the
    first one. What is missing becomes "" (or null for the timestamp). A record that
    is not one well-formed `page` element keeps only its raw text and the status XML_ERROR.
    Plain pages are cut by one search, which says what the reader would; it reads the others.
    """
    xml = F.from_xml("raw", PAGE_XML, {"ignoreSurroundingSpaces": "false"})
    raw, fields = F.col("raw"), F.col("_fields")
    plain, other = F.col("_plain"), ~F.col("_plain")
    # One projection, in which what both ask for is computed once: in a branch it would be again.
    pages = raw_pages.select("*", plain_fields(raw).alias("_fields"), F.coalesce(is_plain_page(raw), F.lit(False)).alias("_plain"))
    read = F.struct(xml.alias("page"), is_one_page(raw).alias("whole"), has_sections(raw).alias("mixed"))
    pages = keep_apart(pages, _read=F.when(other, read))
    broken = other & (F.col(f"_read.page.{CORRUPT}").isNotNull() | ~F.col("_read.whole"))
    only_texts = F.array_join(F.col("_read.page.revision.text._VALUE"), "")
    bodies = F.transform(text_bodies(without_sections(raw)), own_text)
    text = F.when(plain, plain_text(fields)).when(broken, F.lit("")).when(F.col("_read.mixed"), F.array_join(bodies, "")).otherwise(only_texts)
    title = F.when(plain, plain_title(fields)).when(broken, F.lit("")).otherwise(empty_if_null(F.get("_read.page.title", F.lit(0))))
    times = F.filter("_read.page.revision.timestamp", lambda t: t.isNotNull())
    pages = (
        pages.withColumn("title", title)
        .withColumn("wikitext", empty_if_null(text))
        .withColumn("published_ts", iso_timestamp(F.when(plain, plain_time(fields)).otherwise(F.get(times, F.lit(0)))))
        .withColumn("source_url", F.concat(F.lit(cfg.source_url_base), F.col("title")))
        .withColumn("vertex_id", vertex_id(F.col("title"), cfg))
    )
    status = (
        F.when(broken, F.lit(C.STATUS_XML))
        .when(F.rlike("title", F.lit(_BAD_TITLE)), F.lit(C.STATUS_MARKUP))
        .when(empty_redirect(F.col("wikitext")), F.lit(C.STATUS_MARKUP))
        .otherwise(F.lit(C.STATUS_OK))
    )
    return pages.withColumn("status", status).drop("_fields", "_plain", "_read")


def passed_pages(raw_pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """The fields of the pages that pass, for those who ask for neither texts nor links. A link
    is found by its target, so none lacks one, and `check_links` sets no page of a dump aside:
    what passes is known when pages are parsed."""
    return good_pages(parse_pages(raw_pages, cfg))


def check_links(pages: DataFrame) -> DataFrame:
    """A page with a link that has no target is set aside as a whole."""
    missing = F.exists("links", lambda k: k["target"].isNull())
    return pages.withColumn(
        "status",
        F.when((F.col("status") == C.STATUS_OK) & missing, F.lit(C.STATUS_OTHER)).otherwise(
            F.col("status")
        ),
    )


def build_pages(
    raw_pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, rules: dict | None = None, texts: bool = True
) -> DataFrame:
    """Parse, convert and check: the table every graph builder starts from. Without `texts`
    links are those of `convert_markup` without their places."""
    pages = check_links(convert_markup(parse_pages(raw_pages, cfg), rules, cfg, texts))
    return pages.withColumn("content_md5", F.md5("raw"))


def good_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("status") == C.STATUS_OK)


def quarantine(pages: DataFrame, *carry: str) -> DataFrame:
    """Pages that were set aside, with where they came from and why.

    `carry` names page columns that are wanted besides.
    """
    reason = F.create_map(
        F.lit(C.STATUS_XML), F.lit("page is not well-formed XML"),
        F.lit(C.STATUS_MARKUP), F.lit("illegal title or redirect without target"),
        F.lit(C.STATUS_OTHER), F.lit("link without target"),
    )
    return pages.where(F.col("status") != C.STATUS_OK).select(
        "file",
        "file_path",
        "file_block_start",
        F.xxhash64("raw").alias("raw_hash"),
        "status",
        F.element_at(reason, F.col("status")).alias("reason"),
        "raw",
        *carry,
    )


def import_counters(pages: DataFrame) -> DataFrame:
    """Pages processed, XML errors and markup errors, as one row."""
    return pages.agg(*counter_columns())


def counter_columns() -> list[Column]:
    return [
        F.count_if(F.col("status") == C.STATUS_OK).alias("pages_processed"),
        F.count_if(F.col("status") == C.STATUS_XML).alias("xml_parse_errors"),
        F.count_if(F.col("status") == C.STATUS_MARKUP).alias("wiki_text_parse_errors"),
        F.count_if(F.col("status") == C.STATUS_OTHER).alias("other_errors"),
    ]
