"""Registered queries against SQL over the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FAST = (
    "pages_fields", "page_line_roundtrip", "plain_text", "external_links", "link_targets", "edges",
    "vertices", "vertex_properties", "vertex_data", "term_mentions", "best_title", "dump_files", "page_line_files",
    "edge_type_violations", "hidden_markup", "tables_text", "section_numbers", "entities_decoded",
    "html_links", "html_edges", "html_text", "resolved_links", "import_counters", "quarantine",
    "stream_tables", "stream_counters", "quarantine_positions", "deep_templates",
    "links_through_redirects", "residue_kinds", "rare_markup", "ontology_terms", "sink_keys", "sink_layout", "file_names",
    "resolved_bucketed_links",
)
NAMES = tuple(entry.oracle_sql()) if os.environ.get("PAGELOOM_ALL_QUERIES") else FAST


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(map(repr, pdf.where(pdf.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_the_corpus_holds_pages_that_only_their_digest_tells_apart(con):
    """Were pages ranked by another digest than that of the raw page, the SQL would differ."""
    from pageloom.plans.oracle import CORPUS, _raw, _with

    ranks = [f"max_by(wikitext, md5({x}))" for x in ("wikitext", _raw("title", "stamp", "wikitext"))]
    tied = f"SELECT {ranks[0]} <> {ranks[1]} AS other FROM corpus GROUP BY name, ts HAVING count(DISTINCT wikitext) > 1"
    assert con.execute(f"{_with(CORPUS)} SELECT count(*) FROM ({tied}) WHERE other").fetchone()[0] > 0


def test_every_query_has_sql_but_the_learned_ones():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(n == "pipeline" or n.startswith("op") for n in without)


def test_no_predicate_is_pushed_into_the_conversion(spark, sf_dir):
    """The XML of a page is parsed once per branch, not again for each filter."""
    plan = entry.queries()["edges"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1
