"""Lossless XML, pages that used to take quadratic time, anchors, shared folders."""

import time

import pytest
from pyspark.sql import functions as F

from pageloom import config as C
from pageloom.operators.html import html_pages, resolve_target
from pageloom.operators.parse import build_pages, parse_pages
from pageloom.plans.importer import graph_tables
from pageloom.sources.stage import work_dir


def parsed(spark, *raws):
    rows = [(r, "f", "f", 0) for r in raws]
    df = spark.createDataFrame(rows, "raw string, file string, file_path string, file_block_start long")
    return [(r.title, r.wikitext, r.status) for r in parse_pages(df).collect()]


def page(text, title="<title>x</title>"):
    return f"<page>{title}<revision><text a='>' b=\"'\">{text}</text></revision></page>"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a<b>c</b>d", "ad"),
        ("a<b>c<i>e</i>f</b>d<br/>g", "adg"),
        ("a<!-- c -->b", "ab"),
        ("a<![CDATA[<b> & ]]x]]>c", "a<b> & ]]xc"),
        ("<![CDATA[<!-- kept -->]]><!-- <![CDATA[ gone ]]> -->", "<!-- kept -->"),
        ("a<?p i?>b", "ab"),
        ("a<!-- <page> </page> -->b<![CDATA[</page>]]>c<?p </page>?>", "ab</page>c"),
        ("a<!-- <?x --><![CDATA[-->]]>b<?p <!-- ]]>?>c", "a-->bc"),
        ("&lt;ref&gt; &amp;nbsp; &#65;", "<ref> &nbsp; A"),
        ("", ""),
    ],
)
def test_text_of_a_page_is_whole(spark, text, want):
    assert parsed(spark, page(text)) == [("x", want, C.STATUS_OK)]


def test_first_title_and_all_revisions(spark):
    two = "<page><title>a</title><title>b</title><revision><text>x<!-- -->y</text></revision><revision><text>z</text></revision></page>"
    assert parsed(spark, two) == [("a", "xyz", C.STATUS_OK)]


@pytest.mark.parametrize(
    "raw",
    ["<foo><title>x</title></foo>", page("a") + page("b"), "<page><title>x</title>", page("a") + "tail", "", "text",
     page("one<!-- c -->") + page("two"), page("one") + page("<![CDATA[two]]>"), page("a") + "<!-- " + page("b") + " -->",
     page("<?p ?>" + page("a")), page("<!-- </page>") + "</page>"],
)
def test_what_is_not_one_page_is_an_error(spark, raw):
    assert [s for _, _, s in parsed(spark, raw)] == [C.STATUS_XML]


@pytest.mark.parametrize(("ref", "want"), [("&#0000000065;", "A"), ("&#x00000041;", "A"), ("&#99999999999;", "&#99999999999;"), ("&#0;", "&#0;"), ("&#;", "&#;")])
def test_leading_zeros_of_references(spark, ref, want):
    raw = page(f"[{ref.replace('&', '&amp;')}]")
    df = spark.createDataFrame([(raw, "f", "f", 0)], "raw string, file string, file_path string, file_block_start long")
    assert build_pages(df).first().text.strip() == f"[{want}]"


@pytest.mark.parametrize(
    "unit",
    ["{{", "&lt;ref&gt;text ", "&lt;!-- note ", "&lt;math&gt;x &lt;ref&gt;y ", "[[A|]][[B|]]"],
)
def test_long_damaged_pages_take_linear_time(spark, unit):
    n = 500_000 // len(unit)
    df = spark.createDataFrame([(page(unit * n), "f", "f", 0)], "raw string, file string, file_path string, file_block_start long")
    start = time.monotonic()
    row = build_pages(df).select("status", F.length("text").alias("n"), F.size("links").alias("k")).first()
    assert row.status == C.STATUS_OK
    assert time.monotonic() - start < 40


def test_openers_after_the_last_closer_stay_and_others_go(spark):
    filler = "word " * 2500
    raw = page(f"a&lt;ref&gt;gone&lt;/ref&gt;b&lt;!-- gone --&gt;c {filler}&lt;ref&gt;d&lt;ref name=x/&gt;e&lt;!-- f")
    df = spark.createDataFrame([(raw, "f", "f", 0)], "raw string, file string, file_path string, file_block_start long")
    text = build_pages(df).first().text
    assert text.startswith("abc ") and "gone" not in text and text.rstrip().endswith("de<!-- f")


def test_mentions_of_one_span_keep_the_last_link(spark, tmp_path):
    df = spark.createDataFrame([(page("[[A|]][[B|]][[C|c]]"), "f", "f", 0)], "raw string, file string, file_path string, file_block_start long")
    pages = build_pages(df).withColumn("page_id", F.lit(1).cast("long"))
    pages.write.parquet(str(tmp_path / "p"))
    tables = graph_tables(spark.read.parquet(str(tmp_path / "p")), folder=str(tmp_path / "w"))
    assert sorted(r.sign for r in tables[C.MENTIONS].select("sign").collect()) == ["B", "C"]


def test_anchors_in_all_forms(spark):
    html = """<a href="/d?x=1&amp;y=2">one</a> <A class='c' href='two.html'>two</A> <a href=http://s/t>three</a> <a data-href="no">four</a><a title="a>b" href="//h/p">five</a>"""
    df = spark.createDataFrame([("http://site/dir/page.html", html)], "url string, html string")
    links = html_pages(df).first().links
    assert [(k.target, k.surface) for k in links] == [("/d?x=1&y=2", "one"), ("two.html", "two"), ("http://s/t", "three"), ("//h/p", "five")]
    seen = [k.target for k in html_pages(df, resolve=True).first().links]
    assert seen == ["http://site/d?x=1&y=2", "http://site/dir/two.html", "http://s/t", "http://h/p"]
    one = spark.sql("select 'http://site' as u, '#x' as t").select(resolve_target(F.col("t"), F.col("u")).alias("r")).first().r
    assert one == "http://site#x"


def test_intermediate_tables_stand_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert work_dir(spark).startswith(f"{shared.rstrip('/')}/pageloom-")
    assert work_dir(spark) != work_dir(spark)
