"""What shuffles and what is stored is no more than a later step needs."""

import random
from datetime import datetime

import pytest

from pageloom import config as C
from pageloom.operators import graph as G
from pageloom.operators import joins
from pageloom.operators import merge as M
from pageloom.operators.parse import build_pages
from pageloom.plans import corpus as K
from pageloom.plans import queries as Q
from pageloom.plans.importer import import_pages
from pageloom.sources.dump import PAGE_CLOSE
from pageloom.streaming.incremental import read_merged, write_batch

LINKS = "links array<struct<kind string, target string, surface string, start int, end int>>"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(11)
    link = lambda: (C.KIND_LINK, rng.choice(["B", " B", "C#x", "#s", "D"]), "s", rng.randrange(4), rng.randrange(4, 6))
    rows = [
        (f"PAGE_{rng.randrange(12)}", rng.choice([None, datetime(2014, 1, 2), datetime(2015, 1, 2)]), f"{n:032x}", "t", "f", [link() for _ in range(rng.randrange(6))])
        for n in range(80)
    ]
    rows += [("PAGE_x", None, "0" * 32, "t", "f", None), (None, None, None, None, None, [link()])]
    return spark.createDataFrame(rows, f"vertex_id string, published_ts timestamp, content_md5 string, title string, file string, {LINKS}").cache()


@pytest.mark.parametrize("most", [10**6, 5, 0])
def test_links_merge_where_their_vertex_is(pages, tmp_path, most):
    hot = M.hot_vertices(pages, C.ImportConfig(hot_key_rows=most), str(tmp_path))
    assert (hot is None) == (most > 80)
    columns = ["src", "start", "end", "target", "dst"]
    merged = M.merge_page_links(pages, hot=hot).select(*columns)
    wanted = M.merge_mentions(G.all_links(pages, *G.RANK_COLUMNS)).select(*columns)
    assert sorted(map(str, merged.collect())) == sorted(map(str, wanted.collect()))


def test_pages_travel_once_and_not_their_links(pages):
    plan = M.merge_page_links(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_import_stores_its_tables_small(spark, sf_dir, tmp_path):
    out = tmp_path / "out"
    import_pages(K.raw_corpus(spark, sf_dir, ("customer", "supplier")), str(out))
    files = [f for f in out.rglob("*.parquet") if "_work" not in str(f)]
    assert files and all(".zstd." in f.name for f in files)
    rows = [tuple(r) for f in sorted((out / C.EDGES).glob("*.parquet")) for r in spark.read.parquet(str(f)).select("src", "dst").collect()]
    assert rows == sorted(rows) and len(rows) > 100


def test_one_segment_is_read_as_it_is(spark, sf_dir, tmp_path):
    write_batch(build_pages(K.raw_corpus(spark, sf_dir, ("supplier",))), 0, str(tmp_path / "s"))
    tables = read_merged(spark, str(tmp_path / "s"))
    for name in (C.EDGES, C.MENTIONS, C.AUDITS):
        assert "Exchange" not in tables[name]._jdf.queryExecution().executedPlan().toString()
    for name in (C.EDGES, C.MENTIONS):
        assert tables[name].count() == tables[name].distinct().count() > 0


def test_most_dump_files_are_packed(spark, sf_dir):
    """Files of each kind, of which the plain ones hold few of the pages, and none is so long
    that one task would read much."""
    pages = spark.read.option("lineSep", PAGE_CLOSE).text(Q._dump_files(spark, sf_dir)).selectExpr("value", "_metadata.file_name f").where("value LIKE '%<page>%'")
    kinds = {r.kind: r["count"] for r in pages.selectExpr("substring_index(f, '.', -1) kind").groupBy("kind").count().collect()}
    assert set(kinds) == {"txt", "bz2", "gz"} and kinds["txt"] < kinds["bz2"] < kinds["gz"]
    assert sum(kinds.values()) == K.raw_corpus(spark, sf_dir).count()


def test_arriving_and_page_line_files_are_packed_and_bounded(spark, sf_dir, monkeypatch):
    folders = []
    monkeypatch.setattr(Q, "work_dir", lambda s, was=Q.work_dir: folders.append(was(s)) or folders[-1])
    monkeypatch.setattr(Q, "RECORDS_PER_FILE", 1000)
    lines = Q.page_line_files(spark, sf_dir)
    files = spark.read.text(f"{folders[0]}/lines").inputFiles()
    assert all(f.endswith(".gz") for f in files) and len(files) > lines.count() // 1000


def test_links_shuffle_once_to_be_resolved(spark):
    """Also where very many targets are hot: which class is, is known everywhere."""
    rows = [(f"s{i}", i, f"d{i % 7}" if i % 9 else None, None, None) for i in range(90)]
    links = spark.createDataFrame(rows, "src string, seq int, dst string, start int, end int")
    known = spark.createDataFrame([("d1", False), ("d3", False), ("d4", True)], "vertex_id string, is_stub boolean")
    cfg = C.ImportConfig(broadcast_rows=0, hot_key_rows=2, salt_buckets=3)
    for how, wanted in (("left_semi", {"d1", "d3"}), ("left_anti", {"d0", "d2", "d4", "d5", "d6"})):
        found = joins.resolve_links(links, known, how, cfg)
        assert found.columns == ["dst", "src", "seq", "start", "end"]
        assert sorted(r.seq for r in found.collect()) == [i for _, i, dst, _, _ in rows if dst in wanted]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") - plan.count("rightHint=(strategy=broadcast)") == 1
