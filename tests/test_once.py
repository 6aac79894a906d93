"""What several steps ask for is computed once and written."""

from dataclasses import replace

import pytest

from pageloom import config as C
from pageloom.operators import graph as G
from pageloom.operators import joins
from pageloom.operators import merge as M
from pageloom.plans import queries as Q


@pytest.fixture
def written(monkeypatch):
    names = []
    for module in (joins, Q):
        monkeypatch.setattr(module, "stage", lambda df, name, *rest, was=module.stage: names.append(name) or was(df, name, *rest))
    return names


@pytest.mark.parametrize("cfg", [C.DEFAULT_CONFIG, replace(C.DEFAULT_CONFIG, hot_key_rows=2, salt_buckets=3), replace(C.DEFAULT_CONFIG, broadcast_rows=0)])
def test_targets_are_counted_once(spark, written, cfg):
    rows = [(f"s{i}", i, f"d{i % 5}", None, None) for i in range(40)]
    links = spark.createDataFrame(rows, "src string, seq int, dst string, start int, end int")
    known = spark.createDataFrame([("d1", False), ("d3", False), ("d4", True)], "vertex_id string, is_stub boolean")
    for how, wanted in (("left_semi", {"d1", "d3"}), ("left_anti", {"d0", "d2", "d4"})):
        found = joins.resolve_links(links, known, how, cfg).collect()
        assert sorted((r.src, r.dst) for r in found) == sorted((r[0], r[2]) for r in rows if r[2] in wanted)
    assert written == ["targets", "targets"]


def test_vertex_properties_explode_links_once(spark, sf_dir, written):
    Q.vertex_properties(spark, sf_dir)
    assert written == [C.PAGES, "targets"]


@pytest.mark.parametrize("name", ["vertices", "stub_vertices", "title_buckets", "sink_keys"])
def test_vertices_take_one_pass_over_the_pages(spark, sf_dir, written, name):
    plan = Q.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert written == [] and plan.count("l_orderkey") > 0 and plan.count("Union") == 1


def test_vertices_of_one_pass_are_the_merged_ones(spark):
    schema = "vertex_id string, links array<struct<target string>>"
    rows = [("p_A", [("B#x",), ("B",), (" A",), ("#s",)]), ("p_A", []), ("p_C", None), ("p_D", [("C",), (None,)])]
    cfg = replace(C.DEFAULT_CONFIG, id_prefix="p_")
    pages = spark.createDataFrame(rows, schema)
    own = G.page_vertices(pages, cfg).unionByName(G.stub_vertices(G.distinct_targets(pages, cfg), cfg))
    found, wanted = (sorted(map(tuple, df.collect())) for df in (M.graph_vertices(pages, cfg), M.merge_vertices(own)))
    assert found == wanted and [(v, stub) for v, _, stub in found] == [("p_#s", True), ("p_A", False), ("p_B", True), ("p_C", False), ("p_D", False)]


@pytest.mark.parametrize("cfg", [C.DEFAULT_CONFIG, replace(C.DEFAULT_CONFIG, broadcast_rows=0)])
def test_edge_types_are_checked_once_per_end_point(spark, written, cfg):
    edges = [("a", "b", "is"), ("a", "b", "is"), ("c", "a", "is"), ("a", "c", "has"), ("a", "x", "is")]
    edges = spark.createDataFrame(edges, "src string, dst string, label string")
    typed = spark.createDataFrame([("a", "page"), ("b", "page"), ("c", "other")], "vertex_id string, concept_type string")
    rules = spark.createDataFrame([("is", "page", "page")], "iri string, domain_iri string, range_iri string")
    found = sorted((r.src, r.dst, r.label, r.violation) for r in joins.check_edge_types(edges, typed, rules, cfg).collect())
    assert found == [("a", "c", "has", "domain"), ("a", "c", "has", "range"), ("a", "x", "is", "range"), ("c", "a", "is", "domain")]
    assert written == ["wrong"]


def test_edges_do_not_shuffle_to_be_checked(spark, sf_dir, written):
    plan = Q.edge_type_violations(spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert written == [C.PAGES, "wrong"] and "SortMergeJoin" not in plan


def test_properties_are_merged_where_vertices_are_stored(spark, sf_dir, written):
    plan = Q.merged_properties(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert written == [C.PAGES, "targets"] and plan.count("Exchange") == 0 and plan.count("Scan parquet") == 1
