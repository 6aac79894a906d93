"""Settings of an import: id prefixes, IRIs, labels and physical limits.

Every name that ends up in an output table comes from here, so a store that was
filled with other prefixes or IRIs can be continued by passing those values.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ImportConfig:
    # identifiers
    id_prefix: str = "PAGE_"
    link_id_prefix: str = "PAGE_LINK_"
    multi_value_key: str = "pageloom.import"
    source_url_base: str = "http://encyclopedia.example/wiki/"

    # ontology
    page_concept_iri: str = "http://encyclopedia.example/ontology#page"
    link_relationship_iri: str = "http://encyclopedia.example/ontology#pageInternalLinkPage"

    # fixed property values
    mime_type: str = "text/plain"
    source: str = "Encyclopedia"
    text_description: str = "Text"
    visibility: str = ""
    own_title_confidence: float = 0.4
    link_title_confidence: float = 0.1

    # audit
    audit_action: str = "CREATE"
    audit_process: str = "Encyclopedia import"
    audit_user: str = "system"

    # links of the form [[#section]] make a vertex of their own unless this is set
    drop_self_anchors: bool = False

    # A join side is broadcast only when a count proves it has at most this many
    # rows (of a few narrow columns); otherwise the join shuffles.
    broadcast_rows: int = 500_000
    # And at most this many bytes of text.
    broadcast_bytes: int = 64 << 20
    # A join key that owns more rows than this is spread over `salt_buckets` tasks.
    hot_key_rows: int = 5_000_000
    salt_buckets: int = 64


DEFAULT_CONFIG = ImportConfig()

# Property names of a vertex.
CONCEPT_TYPE = "CONCEPT_TYPE"
RAW = "RAW"
TITLE = "TITLE"
MIME_TYPE = "MIME_TYPE"
FILE_NAME = "FILE_NAME"
SOURCE = "SOURCE"
SOURCE_URL = "SOURCE_URL"
PUBLISHED_DATE = "PUBLISHED_DATE"
TEXT = "TEXT"

# Outcome of one input page.
STATUS_OK = "OK"
STATUS_XML = "XML_ERROR"
STATUS_MARKUP = "MARKUP_ERROR"
STATUS_OTHER = "OTHER"

# Kinds of link.
KIND_LINK = "internal"
KIND_REDIRECT = "redirect"

# Names of the output tables.
VERTICES = "vertices"
PROPERTIES = "vertex_properties"
DATA = "vertex_data"
EDGES = "edges"
MENTIONS = "term_mentions"
AUDITS = "audits"
PAGES = "pages"
QUARANTINE = "quarantine"
