"""Pages and links -> graph rows: vertices, properties, edges, mentions, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import edge_id, title_key, vertex_id
from ..functions.strings import strip_fragment


# What decides between pages of the same title: the later one, then a digest of the
# content, so that the choice is the same on every run.
RANK_COLUMNS = ("published_ts", "content_md5", "title", "file")


def all_links(pages: DataFrame, *carry: Column | str, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """One row per link occurrence, in the order of the links in the page.

    `carry` names page columns that are wanted next to each link.
    """
    rows = pages.select(F.col("vertex_id").alias("src"), *carry, F.posexplode_outer("links").alias("pos", "link"))
    target = strip_fragment(F.col("link.target"))
    return (
        rows.where(F.col("link").isNotNull())
        .withColumn("target", target)
        .select(
            "src",
            *[c for c in rows.columns if c not in ("src", "pos", "link")],
            (F.col("pos") + 1).alias("seq"),
            F.col("link.kind").alias("kind"),
            F.col("link.target").alias("raw_target"),
            "target",
            F.col("link.surface").alias("surface"),
            F.col("link.start").alias("start"),
            F.col("link.end").alias("end"),
            vertex_id(F.col("target"), cfg).alias("dst"),
        )
    )


def link_pairs(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """(src, target) with repetitions inside a page already dropped in its row."""
    targets = F.array_distinct(F.transform("links", lambda k: strip_fragment(k["target"])))
    rows = pages.select(F.col("vertex_id").alias("src"), F.explode_outer(targets).alias("target"))
    return rows.where(F.col("target").isNotNull()).withColumn("dst", vertex_id(F.col("target"), cfg))


def link_ends(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> Column:
    """The vertices that a page links to, each once."""
    return F.array_distinct(F.transform("links", lambda k: vertex_id(strip_fragment(k["target"]), cfg)))


def page_edges(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """(src, dst), each once per page."""
    rows = pages.select(F.col("vertex_id").alias("src"), F.explode_outer(link_ends(cfg)).alias("dst"))
    return rows.where(F.col("dst").isNotNull())


def distinct_targets(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Every link target once; all that is known about stubs follows from it."""
    return (
        link_pairs(pages, cfg)
        .select("target")
        .distinct()
        .withColumn("vertex_id", vertex_id(F.col("target"), cfg))
    )


def page_vertices(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    return pages.select(
        "vertex_id",
        F.lit(cfg.page_concept_iri).alias("concept_type"),
        F.lit(False).alias("is_stub"),
    )


def stub_vertices(targets: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    return targets.select(
        "vertex_id",
        F.lit(cfg.page_concept_iri).alias("concept_type"),
        F.lit(True).alias("is_stub"),
    )


def _property(
    name: str,
    value: Column,
    cfg: C.ImportConfig,
    *,
    key: Column | str | None = None,
    value_ts: Column | None = None,
    value_bin: Column | None = None,
    metadata: dict[str, str] | None = None,
    indexed: bool = True,
) -> Column:
    pairs = [F.lit(x) for kv in (metadata or {}).items() for x in kv]
    return F.struct(
        F.lit(name).alias("name"),
        (key if isinstance(key, Column) else F.lit(key or "")).alias("key"),
        value.cast("string").alias("value"),
        (value_ts if value_ts is not None else F.lit(None)).cast("timestamp").alias("value_ts"),
        (value_bin if value_bin is not None else F.lit(None)).cast("binary").alias("value_bin"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("metadata"),
        F.lit(indexed).alias("indexed"),
        F.lit(cfg.visibility).alias("visibility"),
    )


def _explode_properties(
    rows: DataFrame, properties: list[Column], carry: tuple[str, ...] = ()
) -> DataFrame:
    out = rows.select("vertex_id", *[F.col(c).alias(f"_{c}") for c in carry], F.inline(F.array(*properties)))
    return out.withColumnsRenamed({f"_{c}": c for c in carry})


def page_title_struct(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> Column:
    metadata = {"confidence": str(cfg.own_title_confidence)}
    return _property(C.TITLE, F.col("title"), cfg, key=cfg.multi_value_key, metadata=metadata)


def page_file_struct(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> Column:
    return _property(C.FILE_NAME, F.col("file"), cfg)


def page_property_structs(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> list[Column]:
    """The narrow properties of a page vertex; its date may be null."""
    mvk = cfg.multi_value_key
    published = F.col("published_ts")
    return [
        _property(C.CONCEPT_TYPE, F.lit(cfg.page_concept_iri), cfg),
        page_title_struct(cfg),
        _property(C.MIME_TYPE, F.lit(cfg.mime_type), cfg),
        page_file_struct(cfg),
        _property(C.SOURCE, F.lit(cfg.source), cfg, key=mvk),
        _property(C.SOURCE_URL, F.col("source_url"), cfg, key=mvk),
        _property(
            C.PUBLISHED_DATE,
            F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss"),
            cfg,
            value_ts=published,
        ),
    ]


def page_properties(
    pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The narrow properties of a page vertex; its raw bytes and text are `page_data`.

    `carry` names page columns that are wanted next to each property.
    """
    return _dated(_explode_properties(pages, page_property_structs(cfg), carry))


def page_titles(pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Of `page_properties` the titles alone."""
    return _explode_properties(pages, [page_title_struct(cfg)])


def page_files(
    pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Of `page_properties` the file names alone."""
    return _explode_properties(pages, [page_file_struct(cfg)], carry)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("name") != C.PUBLISHED_DATE) | F.col("value_ts").isNotNull())


def seen_vertices(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """A narrow row for each page and each link target: what `seen_properties` are made of."""
    nothing = [F.lit(None).cast(pages.schema[c].dataType).alias(c) for c in (*RANK_COLUMNS, "source_url")]
    own = pages.select("vertex_id", *RANK_COLUMNS, "source_url", F.lit(None).cast("string").alias("target"))
    return own.unionByName(targets.select("vertex_id", *nothing, "target"))


def seen_properties(seen: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """All property rows of `seen_vertices`, with `own` and `RANK_COLUMNS`, ready to be merged.
    A row gives its properties where it lies, so what is stored by vertex stays so."""
    own = F.col("target").isNull()
    linked = F.array(*stub_property_structs(cfg), *stub_title_structs(cfg))
    properties = F.when(own, F.array(*page_property_structs(cfg))).otherwise(linked)
    carry = [F.col(c).alias(f"_{c}") for c in RANK_COLUMNS]
    rows = seen.select("vertex_id", *carry, own.alias("own"), F.inline(properties))
    return _dated(rows.withColumnsRenamed({f"_{c}": c for c in RANK_COLUMNS}))


def page_data_structs(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> dict[str, Column]:
    """The large values of a page vertex: raw page (not indexed) and text."""
    return {
        C.RAW: _property(C.RAW, F.lit(None), cfg, value_bin=F.encode("raw", "UTF-8"), indexed=False),
        C.TEXT: _property(C.TEXT, F.col("text"), cfg, metadata={"textDescription": cfg.text_description}),
    }


def page_data(
    pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, carry: tuple[str, ...] = ()
) -> DataFrame:
    """A row for each of `page_data_structs`."""
    return _explode_properties(pages, list(page_data_structs(cfg).values()), carry)


def stub_property_structs(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> list[Column]:
    return [
        _property(C.CONCEPT_TYPE, F.lit(cfg.page_concept_iri), cfg),
        _property(C.MIME_TYPE, F.lit(cfg.mime_type), cfg),
        _property(C.SOURCE, F.lit(cfg.source), cfg, key=cfg.multi_value_key),
    ]


def stub_properties(stubs: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """What every linked vertex gets besides its title; a stub has no file name."""
    return _explode_properties(stubs.select("vertex_id"), stub_property_structs(cfg))


def stub_title_structs(cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> list[Column]:
    return [
        _property(
            C.TITLE,
            F.col("target"),
            cfg,
            key=title_key(F.col("target"), cfg),
            metadata={"confidence": str(cfg.link_title_confidence)},
        )
    ]


def stub_titles(targets: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """Titles seen through links, under a key made of the folded title."""
    return _explode_properties(targets.select("vertex_id", "target"), stub_title_structs(cfg))


def edges(pairs: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    return pairs.select(
        edge_id(F.col("src"), F.col("dst"), cfg).alias("edge_id"),
        "src",
        "dst",
        F.lit(cfg.link_relationship_iri).alias("label"),
        F.lit(cfg.visibility).alias("visibility"),
    )


def term_mentions(links: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG) -> DataFrame:
    return links.select(
        F.col("src").alias("src_vertex_id"),
        F.lit("").alias("property_key"),
        F.col("start").alias("start_offset"),
        F.col("end").alias("end_offset"),
        F.lit(cfg.page_concept_iri).alias("concept_iri"),
        F.col("target").alias("sign"),
        F.col("dst").alias("dst_vertex_id"),
        edge_id(F.col("src"), F.col("dst"), cfg).alias("edge_id"),
        F.lit(cfg.page_concept_iri).alias("ontology_class"),
        F.lit(cfg.visibility).alias("visibility"),
    )


def audits(
    pages: DataFrame, cfg: C.ImportConfig = C.DEFAULT_CONFIG, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per page that passed, whether or not it has links. `carry` names page columns
    that are wanted besides."""
    return pages.select(
        "vertex_id",
        F.lit(cfg.audit_action).alias("action"),
        F.lit(cfg.audit_process).alias("process"),
        F.lit("").alias("comment"),
        F.lit(cfg.audit_user).alias("user"),
        F.lit(cfg.visibility).alias("visibility"),
        *carry,
    )
