"""What the registered queries must return, as SQL over the relational tables.

The expected pages, texts and links are written out from the columns themselves;
no statement here parses markup, so an error in a pattern cannot hide.
"""

from __future__ import annotations

from ..config import DEFAULT_CONFIG as CFG
from .queries import DIGESTED

ID, LINK_ID, KEY = CFG.id_prefix, CFG.link_id_prefix, CFG.multi_value_key

_LOT_TITLE = "'Lot ' || l_orderkey || '/' || l_linenumber"
_STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _raw(title: str, stamp: str, wikitext: str) -> str:
    """The page as the dump holds it."""
    return rf"""(E'<page>\n    <title>' || {_escaped(title)} || E'</title>\n    <ns>0</ns>\n    <revision>\n'
        || CASE WHEN {stamp} IS NULL THEN '' ELSE '      <timestamp>' || {stamp} || E'</timestamp>\n' END
        || '      <text xml:space="preserve">' || {_escaped(wikitext)} || E'</text>\n    </revision>\n  </page>')"""


_LOT_FULL = rf"CASE WHEN l_linestatus = 'O' THEN E' \t' || {_LOT_TITLE} || E'\n' ELSE {_LOT_TITLE} END"
# Two suppliers share a depot: pages of one title and time, told apart by their digest only.
_DEPOT = "'Depot ' || (s_suppkey // 2)"
_DEPOT_FULL = f"CASE WHEN s_suppkey % 2 = 1 THEN ' ' ELSE '' END || {_DEPOT}"
_DEPOT_WIKITEXT = "'Used by [[Supplier ' || s_suppkey || ']].'"


def _lot_corpus(wikitext: str, text: str) -> str:
    return rf"""
    SELECT 'lineitem.xml' AS file, {_LOT_TITLE} AS name,
           {_LOT_FULL} AS title,
           {_STAMP.format('l_shipdate')} AS stamp, l_shipdate::TIMESTAMP AS ts,
           {wikitext} AS wikitext, {text} AS text
    FROM lineitem"""


_LOT_WIKITEXT = r"""'Part of [[Order ' || l_orderkey || E']].\n== Goods ==\n* [[Part ' || l_partkey
    || '#lot|lot]] from [[Supplier ' || l_suppkey || E']]\n=== Terms ===\nReturned ''''' || l_returnflag
    || ''''' on [[Order ' || l_orderkey || ']].'"""
_LOT_TEXT = r"""'Part of Order ' || l_orderkey || E'.\n\n1. Goods\n\nlot from Supplier ' || l_suppkey
    || E'\n\n1.1. Terms\n\nReturned ' || l_returnflag || ' on Order ' || l_orderkey || '.'"""

_ORDER_WIKITEXT = r"""'By [[Customer ' || o_custkey || E']].\n* priority ' || o_orderpriority
    || E'\n* [[ Status ' || o_orderstatus || ' ]]'"""
_ORDER_RAW = _raw("'Order ' || o_orderkey", _STAMP.format("o_orderdate"), _ORDER_WIKITEXT)

_FIXED = "'2014-01-02T03:04:05Z' AS stamp, TIMESTAMP '2014-01-02 03:04:05' AS ts"

CORPUS = rf"""
corpus AS (
    SELECT 'region.xml' AS file, 'Region ' || r_regionkey AS name, 'Region ' || r_regionkey AS title,
           NULL AS stamp, NULL::TIMESTAMP AS ts,
           '''''''' || r_name || ''''''' is a region. [[Category:Regions]]' AS wikitext,
           r_name || ' is a region. ' AS text
    FROM region
    UNION ALL
    SELECT 'nation.xml', 'Nation ' || n_nationkey, 'Nation ' || n_nationkey, 'no time', NULL,
           '''''''' || n_name || ''''''' lies in [[Region ' || n_regionkey || '|the region]].',
           n_name || ' lies in the region.'
    FROM nation
    UNION ALL
    SELECT 'nation.xml', n_name, n_name, {_FIXED},
           '#REDIRECT [[Nation ' || n_nationkey || '#Top|' || n_name || ']]',
           'REDIRECT: Nation ' || n_nationkey || '#Top'
    FROM nation
    UNION ALL
    SELECT 'customer.xml', 'Customer ' || c_custkey, 'Customer ' || c_custkey, {_FIXED},
           '{{{{infobox|seg=' || c_mktsegment || '}}}}' || c_name || ' of [[Nation ' || c_nationkey || ']].',
           c_name || ' of Nation ' || c_nationkey || '.'
    FROM customer
    UNION ALL
    SELECT 'supplier.xml', 'Supplier ' || s_suppkey, 'Supplier ' || s_suppkey, {_FIXED},
           s_name || ' of [[Nation ' || s_nationkey || '#Suppliers|nation]]s, see [http://s.example/'
               || s_suppkey || ' site] and [http://s.example/' || s_suppkey || '/more].',
           s_name || ' of nations, see [1] site (http://s.example/' || s_suppkey
               || ') and [2]  (http://s.example/' || s_suppkey || '/more).'
    FROM supplier
    UNION ALL
    SELECT 'supplier.xml', {_DEPOT}, {_DEPOT_FULL}, {_FIXED}, {_DEPOT_WIKITEXT},
           'Used by Supplier ' || s_suppkey || '.'
    FROM supplier
    UNION ALL
    SELECT 'part.xml', 'Part ' || p_partkey, 'Part ' || p_partkey, {_FIXED},
           '''''' || p_name || ''''' by [[' || p_brand || ']]<!-- ' || p_type || ' --> [[Category:'
               || p_type || ']]',
           p_name || ' by ' || p_brand || ' '
    FROM part
    UNION ALL
    SELECT 'orders.xml', 'Order ' || o_orderkey, 'Order ' || o_orderkey,
           {_STAMP.format('o_orderdate')}, o_orderdate::TIMESTAMP,
           {_ORDER_WIKITEXT},
           'By Customer ' || o_custkey || E'.\n\npriority ' || o_orderpriority
               || E'\n Status ' || o_orderstatus || ' '
    FROM orders
    UNION ALL
    SELECT file, name, title, stamp, ts, wikitext, text FROM ({_lot_corpus(_LOT_WIKITEXT, _LOT_TEXT)})
)"""

_HEAD = "SELECT name, title, ts, file, wikitext"

# One row per link: what the markup of each page says, in order.
LINKS = rf"""
nation_links AS (
    SELECT 'Nation ' || n_nationkey AS name, 'Nation ' || n_nationkey AS title, NULL::TIMESTAMP AS ts,
           'nation.xml' AS file, 1 AS seq, 'internal' AS kind, 'Region ' || n_regionkey AS raw_target,
           'the region' AS surface, length(n_name) + 9 AS start_at, '' AS digest
    FROM nation
    UNION ALL
    SELECT n_name, n_name, TIMESTAMP '2014-01-02 03:04:05', 'nation.xml', 1, 'redirect',
           'Nation ' || n_nationkey || '#Top', 'Nation ' || n_nationkey || '#Top', 10, ''
    FROM nation
),
entity_links AS (
    SELECT 'Customer ' || c_custkey, 'Customer ' || c_custkey, TIMESTAMP '2014-01-02 03:04:05',
           'customer.xml', 1, 'internal', 'Nation ' || c_nationkey, 'Nation ' || c_nationkey,
           length(c_name) + 4, ''
    FROM customer
    UNION ALL
    SELECT 'Supplier ' || s_suppkey, 'Supplier ' || s_suppkey, TIMESTAMP '2014-01-02 03:04:05',
           'supplier.xml', 1, 'internal', 'Nation ' || s_nationkey || '#Suppliers', 'nations',
           length(s_name) + 4, ''
    FROM supplier
    UNION ALL
    SELECT {_DEPOT}, {_DEPOT_FULL}, TIMESTAMP '2014-01-02 03:04:05', 'supplier.xml', 1, 'internal',
           'Supplier ' || s_suppkey, 'Supplier ' || s_suppkey, 8,
           md5({_raw(_DEPOT_FULL, "'2014-01-02T03:04:05Z'", _DEPOT_WIKITEXT)})
    FROM supplier
    UNION ALL
    SELECT 'Part ' || p_partkey, 'Part ' || p_partkey, TIMESTAMP '2014-01-02 03:04:05', 'part.xml',
           1, 'internal', p_brand, p_brand, length(p_name) + 4, ''
    FROM part
),
order_links AS (
    SELECT 'Order ' || o_orderkey, 'Order ' || o_orderkey, o_orderdate::TIMESTAMP, 'orders.xml',
           k.seq, 'internal',
           CASE k.seq WHEN 1 THEN 'Customer ' || o_custkey ELSE ' Status ' || o_orderstatus || ' ' END,
           CASE k.seq WHEN 1 THEN 'Customer ' || o_custkey ELSE ' Status ' || o_orderstatus || ' ' END,
           CASE k.seq WHEN 1 THEN 3
                ELSE length('By Customer ' || o_custkey || E'.\n\npriority ' || o_orderpriority || E'\n') END,
           ''
    FROM orders, (VALUES (1), (2)) k(seq)
),
lot_links AS (
    SELECT {_LOT_TITLE} AS name,
           {_LOT_FULL} AS title,
           l_shipdate::TIMESTAMP AS ts, 'lineitem.xml' AS file, k.seq AS seq, 'internal' AS kind,
           CASE k.seq WHEN 2 THEN 'Part ' || l_partkey || '#lot' WHEN 3 THEN 'Supplier ' || l_suppkey
                ELSE 'Order ' || l_orderkey END AS raw_target,
           CASE k.seq WHEN 2 THEN 'lot' WHEN 3 THEN 'Supplier ' || l_suppkey
                ELSE 'Order ' || l_orderkey END AS surface,
           CASE k.seq WHEN 1 THEN 8
                WHEN 2 THEN length('Part of Order ' || l_orderkey || E'.\n\n1. Goods\n\n')
                WHEN 3 THEN length('Part of Order ' || l_orderkey || E'.\n\n1. Goods\n\nlot from ')
                ELSE length('Part of Order ' || l_orderkey || E'.\n\n1. Goods\n\nlot from Supplier '
                     || l_suppkey || E'\n\n1.1. Terms\n\nReturned ' || l_returnflag || ' on ') END AS start_at,
           md5({_raw(_LOT_FULL, _STAMP.format('l_shipdate'), _LOT_WIKITEXT)}) AS digest
    FROM lineitem, (VALUES (1), (2), (3), (4)) k(seq)
),
links AS (
    SELECT *, CASE WHEN strpos(raw_target, '#') > 1 THEN split_part(raw_target, '#', 1)
                   ELSE raw_target END AS target,
           '{ID}' || name AS src, '{ID}' || trim(CASE WHEN strpos(raw_target, '#') > 1
               THEN split_part(raw_target, '#', 1) ELSE raw_target END) AS dst
    FROM (SELECT * FROM nation_links UNION ALL SELECT * FROM entity_links
          UNION ALL SELECT * FROM order_links UNION ALL SELECT * FROM lot_links)
)"""

# The page that stands for a vertex when several share its title.
CURRENT = f"""
current_page AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY name
            ORDER BY ts DESC NULLS LAST, md5({_raw('title', 'stamp', 'wikitext')}) DESC, title DESC, file DESC) AS rn
        FROM corpus) WHERE rn = 1
)"""

VERTICES = f"""
vertices AS (
    SELECT vertex_id, min(stub) AS stub FROM (
        SELECT '{ID}' || name AS vertex_id, 0 AS stub FROM corpus
        UNION ALL SELECT dst, 1 FROM links) GROUP BY vertex_id
)"""

_TITLES = f"""
titles AS (
    SELECT '{ID}' || name AS vertex_id, '{KEY}' AS key, title, 0.4::DOUBLE AS confidence FROM current_page
    UNION ALL
    SELECT dst, '{KEY}#' || to_base64(encode(lower(trim(max(target))))), max(target), 0.1::DOUBLE
    FROM links GROUP BY dst
)"""

_EDGE = f"'{LINK_ID}' || substr(src, {len(ID) + 1}) || '_' || substr(dst, {len(ID) + 1})"

_XML = f"""
xml AS (SELECT *, {_raw('title', 'stamp', 'wikitext')} AS raw FROM current_page)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _deep(text: str, *more: str) -> str:
    return f"""SELECT '{ID}' || {_LOT_TITLE} AS vertex_id, {', '.join([text + ' AS text', *more])} FROM lineitem"""


# The text of a page of `residue_pages`, cut where something is left in it.
_RESIDUE = f"""
pieces AS (
    SELECT '{ID}Order ' || o_orderkey AS vertex_id, '; Order ' || o_orderkey || E'\\n' AS a,
           ': by Customer ' || o_custkey || ' ' AS b, E'}}}} x; y: z\\n' AS c, ': [[ ' || o_orderstatus || E'\\n' AS d
    FROM orders
)"""

# Redirects as links of a list, followed one by one.
_ROUTES = f"""
RECURSIVE routes AS (
    SELECT '{ID}Route ' || c_custkey AS src, '{ID}' || CASE
        WHEN c_custkey % 64 = 63 THEN 'Route ' || (c_custkey - 15)
        WHEN c_custkey % 64 >= 48 THEN 'Route ' || (c_custkey + 1)
        WHEN c_custkey % 16 = 0 THEN 'Customer ' || c_custkey
        ELSE 'Route ' || (c_custkey - 1) END AS dst
    FROM customer
),
walk AS (
    SELECT src, dst AS place, 1::BIGINT AS hops FROM routes
    UNION ALL
    SELECT w.src, r.dst, w.hops + 1 FROM walk w JOIN routes r ON w.place = r.src WHERE w.hops < 20
)"""


def _lots(text: str) -> str:
    return f"""SELECT '{ID}' || {_LOT_TITLE} AS vertex_id, {text} AS text FROM lineitem"""


_FAULTS = """
faults AS (
    SELECT 'Order ' || o_orderkey AS title, 'orders.xml' AS file,
           CASE WHEN o_orderstatus = 'P' THEN 'XML_ERROR' ELSE 'OK' END AS status
    FROM orders
    UNION ALL
    SELECT 'Part ' || p_partkey || CASE WHEN p_size > 40 THEN ' [big]' ELSE '' END, 'part.xml',
           CASE WHEN p_size > 40 OR p_size = 1 THEN 'MARKUP_ERROR' ELSE 'OK' END
    FROM part
)"""

_ANCHOR = '<a href="([^"]*)">([^<]*)</a>'
_HTML_TEXT = r"""
replace(replace(replace(replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
    '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'),
    '<br\s*/?>', chr(3), 'g'), '<[!/]?[a-zA-Z][^<>]*>', '', 'g'), E'\n\x03'),
    E'\n*\x03[\n\x03]*', E'\n', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')"""

_PROPERTIES = f"""
properties AS (
    SELECT '{ID}' || c.name AS vertex_id, p.* FROM current_page c, LATERAL (
        SELECT 'CONCEPT_TYPE' AS name, '' AS key, '{CFG.page_concept_iri}' AS value, '' AS metadata
        UNION ALL SELECT 'TITLE', '{KEY}', c.title, 'confidence=0.4'
        UNION ALL SELECT 'MIME_TYPE', '', '{CFG.mime_type}', ''
        UNION ALL SELECT 'FILE_NAME', '', c.file, ''
        UNION ALL SELECT 'SOURCE', '{KEY}', '{CFG.source}', ''
        UNION ALL SELECT 'SOURCE_URL', '{KEY}', '{CFG.source_url_base}' || c.title, ''
        UNION ALL SELECT 'PUBLISHED_DATE', '', strftime(c.ts, '%Y-%m-%dT%H:%M:%S'), ''
    ) p WHERE p.value IS NOT NULL
    UNION ALL
    SELECT vertex_id, p.* FROM vertices, LATERAL (
        SELECT 'CONCEPT_TYPE' AS name, '' AS key, '{CFG.page_concept_iri}' AS value, '' AS metadata
        UNION ALL SELECT 'MIME_TYPE', '', '{CFG.mime_type}', ''
        UNION ALL SELECT 'SOURCE', '{KEY}', '{CFG.source}', ''
    ) p WHERE stub = 1
    UNION ALL
    SELECT vertex_id, 'TITLE', key, title, 'confidence=0.1' FROM titles WHERE confidence < 0.2
)"""

_LINK_COLUMNS = "src, seq::BIGINT AS seq, kind, raw_target, target, surface, start_at, start_at + length(surface) AS end_at, dst"
_PAGE_IDS = f"(SELECT '{ID}' || name FROM corpus)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["pages_fields"] = _with(CORPUS) + f"""
        SELECT '{ID}' || name AS vertex_id, name AS title_from_id, title, wikitext,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS published,
               '{CFG.source_url_base}' || title AS source_url, 'OK' AS status, file
        FROM corpus"""
    q["page_line_roundtrip"] = _with(CORPUS) + f"""
        SELECT '{ID}' || name AS vertex_id, regexp_replace(wikitext, E' *\n *', E'\n', 'g') AS wikitext,
               0::BIGINT AS newlines_in_line, status
        FROM (SELECT *, 'OK' AS status FROM corpus)"""
    q["plain_text"] = _with(CORPUS) + f"""
        SELECT '{ID}' || name AS vertex_id, title, text, 0::BIGINT AS residue FROM corpus"""
    q["external_links"] = f"""
        SELECT '{ID}Supplier ' || s_suppkey AS vertex_id, k.n::BIGINT AS n,
               CASE k.n WHEN 1 THEN 'site' ELSE '' END AS label,
               'http://s.example/' || s_suppkey || CASE k.n WHEN 1 THEN '' ELSE '/more' END AS url
        FROM supplier, (VALUES (1), (2)) k(n)"""
    q["hidden_markup"] = _lots(_LOT_TEXT)
    q["tables_text"] = _lots(
        r"""'Order ' || l_orderkey || E'\nPart Supplier\nlot Supplier ' || l_suppkey || E'\n'
            || l_returnflag || ' Order ' || l_orderkey || E'\nShipped || done.'"""
    )
    q["section_numbers"] = _lots(
        r"""E'1. A\n\n1.1. B ' || l_partkey || E'\n\n1.2. C\n\n2. Order ' || l_orderkey
            || E'\n\n2.1.1. E\n\n2.1. F\n\n2.2. G\n\nH\n\n1. ' || l_returnflag"""
    )
    q["entities_decoded"] = _lots(
        r"""'Order' || chr(160) || l_orderkey || ' – Part ' || l_partkey
            || E' <b> &unknown; AT&T\nR&D 😀 Séller' || chr(160) || l_suppkey || '&#1;'"""
    )
    q["link_targets"] = _with(LINKS) + f"SELECT {_LINK_COLUMNS} FROM links"
    q["redirects"] = _with(LINKS) + f"""
        SELECT src, target, dst, start_at, start_at + length(surface) AS end_at
        FROM links WHERE kind = 'redirect'"""
    q["vertices"] = _with(CORPUS, LINKS, VERTICES) + f"""
        SELECT vertex_id, '{CFG.page_concept_iri}' AS concept_type, stub = 1 AS is_stub FROM vertices"""
    q["stub_vertices"] = _with(CORPUS, LINKS) + f"""
        SELECT DISTINCT dst AS vertex_id FROM links WHERE dst NOT IN {_PAGE_IDS}"""
    q["resolved_links"] = _with(CORPUS, LINKS) + f"""
        SELECT src, seq::BIGINT AS seq, dst, target FROM links WHERE dst IN {_PAGE_IDS}"""
    q["unresolved_links"] = _with(CORPUS, LINKS) + f"""
        SELECT src, seq::BIGINT AS seq, dst, target FROM links WHERE dst NOT IN {_PAGE_IDS}"""
    q["edges"] = _with(LINKS) + f"""
        SELECT DISTINCT {_EDGE} AS edge_id, src, dst, '{CFG.link_relationship_iri}' AS label FROM links"""
    q["edge_id_collisions"] = f"""
        SELECT '{LINK_ID}Acct ' || c_custkey || '_N' || c_nationkey || '_Hub' AS edge_id,
               2::BIGINT AS n_edges, '{ID}Acct ' || c_custkey AS first_src,
               '{ID}Acct ' || c_custkey || '_N' || c_nationkey AS last_src
        FROM customer"""
    q["term_mentions"] = _with(LINKS) + f"""
        SELECT src AS src_vertex_id, start_at AS start_offset, start_at + length(surface) AS end_offset,
               target AS sign, dst AS dst_vertex_id, {_EDGE} AS edge_id,
               '{CFG.page_concept_iri}' AS concept_iri, '{CFG.page_concept_iri}' AS ontology_class
        FROM (SELECT *, row_number() OVER (PARTITION BY src, start_at, length(surface)
                  ORDER BY ts DESC NULLS LAST, digest DESC, title DESC, file DESC, seq DESC) AS rn FROM links)
        WHERE rn = 1"""
    q["audits"] = _with(CORPUS) + f"""
        SELECT '{ID}' || name AS vertex_id, '{CFG.audit_action}' AS action,
               '{CFG.audit_process}' AS process, '' AS comment, '{CFG.audit_user}' AS user, '' AS visibility
        FROM corpus"""
    q["vertex_properties"] = _with(CORPUS, LINKS, VERTICES, CURRENT, _TITLES, _PROPERTIES) + """
        SELECT vertex_id, name, key, value, metadata FROM properties"""
    q["vertex_data"] = _with(CORPUS, CURRENT, _XML) + f"""
        SELECT '{ID}' || name AS vertex_id, text, 'textDescription=Text' AS metadata, md5(raw) AS raw_md5,
               false AS raw_indexed FROM xml"""
    q["stub_titles"] = _with(LINKS) + f"""
        SELECT dst AS vertex_id, '{KEY}#' || to_base64(encode(lower(trim(max(target))))) AS key,
               max(target) AS title, 0.1::DOUBLE AS confidence
        FROM links GROUP BY dst"""
    q["title_candidates"] = _with(CORPUS, LINKS, CURRENT, _TITLES) + """
        SELECT vertex_id, key, title, confidence FROM titles"""
    q["best_title"] = _with(CORPUS, LINKS, CURRENT, _TITLES) + """
        SELECT vertex_id, arg_max(title, confidence) AS title, max(confidence) AS confidence
        FROM titles GROUP BY vertex_id"""
    q["import_counters"] = _with(_FAULTS) + """
        SELECT count(*) FILTER (status = 'OK') AS pages_processed,
               count(*) FILTER (status = 'XML_ERROR') AS xml_parse_errors,
               count(*) FILTER (status = 'MARKUP_ERROR') AS wiki_text_parse_errors,
               0::BIGINT AS other_errors
        FROM faults"""
    q["quarantine"] = _with(_FAULTS) + """
        SELECT title, file, status FROM faults WHERE status <> 'OK'"""
    q["rows_per_table"] = _with(CORPUS, LINKS, VERTICES) + """
        SELECT 'vertices' AS table_name, count(*) AS n_rows FROM vertices
        UNION ALL SELECT 'edges', count(*) FROM (SELECT DISTINCT src, dst FROM links)
        UNION ALL SELECT 'audits', count(*) FROM corpus
        UNION ALL SELECT 'term_mentions', count(*) FROM (
            SELECT DISTINCT src, start_at, length(surface) FROM links)"""
    def digests(**changed: str) -> str:
        """As `table_digests`: a query per table with the columns of `DIGESTED`."""
        data = f"({q['vertex_data']})"
        tables = {
            "vertices": q["vertices"],
            "vertex_properties": f"SELECT * FROM ({q['vertex_properties']}) WHERE name <> 'FILE_NAME'",
            "vertex_data": f"""SELECT vertex_id, 'RAW' AS name, raw_md5 AS value, false AS indexed FROM {data}
                UNION ALL SELECT vertex_id, 'TEXT', text, true FROM {data}""",
            "edges": q["edges"],
            "term_mentions": q["term_mentions"],
            "audits": q["audits"],
        } | changed
        parts = []
        for name, rows in tables.items():
            values = ", ".join(f"coalesce({c}::VARCHAR, '∅')" for c in DIGESTED[name])
            parts.append(
                f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
                    coalesce(sum(('0x' || substr(md5(concat_ws(chr(31), {values})), 1, 8))::BIGINT), 0)::VARCHAR AS digest FROM ({rows})"""
            )
        return " UNION ALL ".join(parts)

    q["import_tables"] = digests()
    # A page that is sent again as it was is audited once.
    once = f"""{_with(CORPUS)} SELECT DISTINCT '{ID}' || name AS vertex_id, md5({_raw('title', 'stamp', 'wikitext')}) AS digest FROM corpus"""
    q["stream_tables"] = digests(
        audits=f"""SELECT vertex_id, '{CFG.audit_action}' AS action, '{CFG.audit_process}' AS process, '' AS comment,
            '{CFG.audit_user}' AS user, '' AS visibility FROM ({once})"""
    )
    q["stream_counters"] = _with(_FAULTS) + """
        SELECT CASE file WHEN 'orders.xml' THEN 0 ELSE 1 END::BIGINT AS batch, count(*) FILTER (status = 'OK') AS pages_processed,
               count(*) FILTER (status = 'XML_ERROR') AS xml_parse_errors,
               count(*) FILTER (status = 'MARKUP_ERROR') AS wiki_text_parse_errors, 0::BIGINT AS other_errors
        FROM faults GROUP BY file"""
    q["quarantine_positions"] = f"""
        SELECT title, bucket, 'XML_ERROR' AS status, byte_offset FROM (
            SELECT title, bucket, o_orderstatus, coalesce(sum(strlen(raw) + 1) OVER (PARTITION BY bucket ORDER BY o_orderkey
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset
            FROM (SELECT o_orderkey, o_orderstatus, 'Order ' || o_orderkey AS title, (o_orderkey // 4096)::BIGINT AS bucket,
                    CASE o_orderstatus WHEN 'P' THEN replace({_ORDER_RAW}, 'By ', 'By R&D ') ELSE {_ORDER_RAW} END AS raw FROM orders))
        WHERE o_orderstatus = 'P'"""
    q["deep_templates"] = _deep(
        """'Part of Order ' || l_orderkey || ' }} from {{a Supplier ' || l_suppkey || ' {1}.'""", "2::BIGINT AS residue"
    )
    q["residue_kinds"] = _with(_RESIDUE) + """
        SELECT vertex_id, 7::BIGINT AS residue, k.n::BIGINT AS n, k.kind,
               CASE k.n WHEN 0 THEN 0 WHEN 1 THEN length(a) WHEN 2 THEN length(a || b) WHEN 3 THEN length(a || b || c)
                   WHEN 4 THEN length(a || b || c) + 2 WHEN 5 THEN length(a || b || c || d) ELSE length(a || b || c || d) + 1 END::BIGINT AS start_at
        FROM pieces, (VALUES (0, 'definition_term'), (1, 'definition'), (2, 'template_close'), (3, 'definition'),
            (4, 'link_open'), (5, 'definition_term'), (6, 'link_close')) k(n, kind)"""
    q["rare_markup"] = f"""
        SELECT '{ID}' || k.name || ' ' || p_partkey AS vertex_id,
            CASE k.name
                WHEN 'Bare' THEN 'See http://p.example/' || p_partkey || ' now, ' || p_name || '.'
                WHEN 'Rule' THEN 'a ' || p_name || E'\n\nb\n\nc'
                WHEN 'Steps' THEN 'one Part ' || p_partkey || E'\ntwo\nthree'
                WHEN 'Only' THEN '{{{{only|' || p_partkey || '}}}}'
                WHEN 'Moved' THEN 'REDIRECT: Part ' || p_partkey || ' see ' || p_brand || ' and it'
                ELSE 'first Part ' || p_partkey || ' and second' END AS text,
            CASE k.name
                WHEN 'Steps' THEN 'internal:Part ' || p_partkey || ':4:' || (9 + length(p_partkey::VARCHAR))
                WHEN 'Moved' THEN 'internal:' || p_brand || ':' || (20 + length(p_partkey::VARCHAR)) || ':' || (20 + length(p_partkey || p_brand))
                    || ';internal:Part ' || p_partkey || '#x:' || (25 + length(p_partkey || p_brand)) || ':' || (27 + length(p_partkey || p_brand))
                    || ';redirect:Part ' || p_partkey || ':10:' || (15 + length(p_partkey::VARCHAR))
                WHEN 'Twice' THEN 'internal:Part ' || p_partkey || ':6:' || (11 + length(p_partkey::VARCHAR))
                    || ';internal:second:' || (16 + length(p_partkey::VARCHAR)) || ':' || (22 + length(p_partkey::VARCHAR))
                ELSE '' END AS links
        FROM part, (VALUES ('Bare'), ('Rule'), ('Steps'), ('Only'), ('Moved'), ('Twice')) k(name)"""
    q["ontology_terms"] = """
        SELECT 'concept' AS kind, 'http://world.example/region' || r_regionkey AS iri, r_name AS label, 'place' AS display_type,
               NULL AS domain_iri, NULL AS range_iri FROM region
        UNION ALL
        SELECT 'relationship', 'http://world.example/in' || n_nationkey, 'in ' || n_name, NULL, 'http://world.example/page',
               'http://world.example/region' || n_regionkey FROM nation
        UNION ALL SELECT 'missing', 'http://world.example/page', NULL, NULL, NULL, NULL"""
    q["sink_keys"] = _with(CORPUS, LINKS, VERTICES) + """
        SELECT vertex_id, 'vertices' || chr(31) || to_base64(encode(vertex_id)) AS sink_key, 'vertices' AS table_name FROM vertices"""
    q["file_names"] = _with(CORPUS) + f"""
        SELECT '{ID}' || name AS vertex_id, true AS same FROM corpus"""
    q["sink_layout"] = _with(CORPUS, LINKS, VERTICES) + """
        SELECT *, 0::BIGINT AS n_unsorted, 0::BIGINT AS n_overlaps, true AS even FROM (
            SELECT 'vertices' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_repeated FROM vertices
            UNION ALL SELECT 'edges', count(*), 0 FROM (SELECT DISTINCT src, dst FROM links)
            UNION ALL SELECT 'audits', sum(n)::BIGINT, count(*) FILTER (n > 1) FROM (SELECT name, count(*) AS n FROM corpus GROUP BY name))"""
    q["redirect_targets"] = _with(_ROUTES) + f"""
        SELECT r.src, w.place AS final_dst, coalesce(w.hops, 0) AS hops, w.place IS NULL AS in_cycle
        FROM routes r LEFT JOIN (SELECT * FROM walk WHERE place NOT IN (SELECT src FROM routes)) w USING (src)"""
    q["links_through_redirects"] = _with(_ROUTES) + f"""
        SELECT '{ID}Stop ' || c_custkey AS src, 1::BIGINT AS seq, '{ID}Route ' || c_custkey AS dst,
               coalesce(w.place, '{ID}Route ' || c_custkey) AS final_dst
        FROM customer LEFT JOIN (SELECT * FROM walk WHERE place NOT IN (SELECT src FROM routes)) w ON w.src = '{ID}Route ' || c_custkey
        UNION ALL
        SELECT '{ID}Stop ' || c_custkey, 2, '{ID}Nation ' || c_nationkey, '{ID}Nation ' || c_nationkey FROM customer"""
    q["resolved_hot_links"] = q["resolved_links"]
    q["resolved_bucketed_links"] = q["resolved_links"]
    q["merged_properties"] = q["vertex_properties"]
    q["import_files"] = q["import_tables"]
    q["dump_files"] = f"SELECT vertex_id, title, wikitext, published, source_url, status FROM ({q['pages_fields']})"
    q["page_line_files"] = f"SELECT vertex_id, wikitext, status FROM ({q['page_line_roundtrip']})"
    q["title_buckets"] = _with(CORPUS, LINKS, VERTICES) + f"""
        SELECT CASE WHEN regexp_matches(c, '[0-9A-Za-z]') THEN c ELSE '' END AS bucket,
               count(*) AS n_vertices
        FROM (SELECT substr(vertex_id, {len(ID) + 1}, 1) AS c FROM vertices) GROUP BY 1"""
    q["edge_type_violations"] = _with(LINKS) + f"""
        SELECT DISTINCT {_EDGE} AS edge_id, src, dst, v AS violation
        FROM links, (VALUES ('domain'), ('range')) t(v)
        WHERE (v = 'domain' AND src LIKE '{ID}Supplier %') OR (v = 'range' AND dst LIKE '{ID}Supplier %')"""
    q["html_links"] = rf"""
        SELECT '{ID}' || url AS src, seq::BIGINT AS seq, a[1] AS target, a[2] AS surface, '{ID}' || trim(a[1]) AS dst
        FROM (SELECT url, unnest(range(1, len(all_a) + 1)) AS seq,
                     unnest(list_zip(regexp_extract_all(html, '{_ANCHOR}', 1),
                                     regexp_extract_all(html, '{_ANCHOR}', 2))) AS a
              FROM (SELECT *, regexp_extract_all(html, '{_ANCHOR}', 1) AS all_a FROM pages))"""
    q["html_edges"] = rf"""
        SELECT DISTINCT '{LINK_ID}' || url || '_' || trim(h) AS edge_id, '{ID}' || url AS src,
               '{ID}' || trim(h) AS dst
        FROM (SELECT url, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS h FROM pages)"""
    q["html_text"] = rf"""
        SELECT '{ID}' || url AS vertex_id, {_HTML_TEXT} AS text FROM pages"""
    q["stream_edges"] = f"""
        SELECT DISTINCT {_EDGE} AS edge_id, src, dst FROM (
            SELECT '{ID}' || {_LOT_TITLE} AS src, unnest(['{ID}Order ' || l_orderkey,
                '{ID}Part ' || l_partkey, '{ID}Supplier ' || l_suppkey]) AS dst FROM lineitem)"""
    return q
