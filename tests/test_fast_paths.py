"""Cheaper ways to the same result: plain pages, matched braces, links without texts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pageloom.functions.xmltext import is_plain_page
from pageloom.operators import markup, parse
from pageloom.operators.markup import count_braces, match_braces
from pageloom.operators.parse import build_pages, parse_pages
from pageloom.plans import corpus as K

RAW = "raw string, file string, file_path string, file_block_start long"
HEAD = "<page>\n <title>{t}</title><ns>0</ns>\n<revision><id>7</id>"
END = "</revision>\n</page>"


def page(text="x", title="A b", time="<timestamp>2014-01-02T03:04:05Z</timestamp>", attributes=' xml:space="preserve"'):
    return HEAD.replace("{t}", title) + time + f"<text{attributes}>{text}</text>" + END


PLAIN = [
    page(), page(""), page("\n a\tb \n"), page("&lt;ref&gt; &amp;lt; &amp;amp; &quot;&apos;"), page(title=" \tLot 1/2\n"), page(time=""),
    page(time="<timestamp>soon</timestamp>"), page(attributes=""), page("ü 😀  "), page("{{a}} [[b|c]] = d"),
]
OTHER = [
    page("a\r\nb"), page("&#65;"), page("AT&T"), page("a]]>b"), page("  "), page("a<b>c</b>"), page("a<!-- c -->b"), page(title="R&amp;D"),
    page(title=" "), page(title=""), page("\x01"), page("￾"), page("x") + "y", page(attributes=" bytes='1'"), "<page>", "",
    page().replace("<ns>", "<title>second</title><ns>"), page().replace("</revision>", "</revision><revision><text>z</text></revision>"),
    page().replace("<ns>0</ns>", "<ns>0</id>"), page().replace("<ns>0</ns>", "<ns>&x;</ns>"), page().replace("</page>", "</page >"),
]


@pytest.fixture(scope="module")
def raws(spark):
    return spark.createDataFrame([(r, "f", "f", 0) for r in PLAIN + OTHER], RAW)


def test_the_usual_page_needs_no_reader(spark, sf_dir, raws):
    assert [r[0] for r in raws.select(is_plain_page(F.col("raw"))).collect()] == [True] * len(PLAIN) + [False] * len(OTHER)
    assert K.raw_corpus(spark, sf_dir).where(~is_plain_page(F.col("raw"))).isEmpty()


def test_plain_pages_are_cut_as_the_reader_reads_them(raws, monkeypatch):
    fields = ["raw", "title", "wikitext", "published_ts", "vertex_id", "status"]
    cut = parse_pages(raws).select(*fields).collect()
    monkeypatch.setattr(parse, "is_plain_page", lambda raw: F.lit(False))
    assert cut == parse_pages(raws).select(*fields).collect()


def test_braces_match_as_they_count(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["{{", "}}", "{", "}", "{{{", "}}}", "a", "\n"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["{{" * n + "x" + "}}" * m for n, m in ((5, 5), (40, 40), (40, 41), (41, 40), (400, 400), (400, 399), (399, 400))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(match_braces(F.col("t")) != count_braces(F.col("t"))).isEmpty()


def test_links_without_texts_are_the_same_links(spark, sf_dir):
    pages = K.raw_corpus(spark, sf_dir).unionByName(K.rare_pages(spark, sf_dir)).unionByName(K.faulty_corpus(spark, sf_dir))
    links = F.transform("links", lambda k: F.struct(k["kind"], k["target"])).alias("links")
    full, bare = (build_pages(pages, texts=t).select("vertex_id", "content_md5", "status", links) for t in (True, False))
    assert full.exceptAll(bare).isEmpty() and bare.exceptAll(full).isEmpty()


def test_deep_braces_cost_a_fraction_of_counting_them(spark):
    mountain = [F.repeat(F.lit("{{n|k="), F.lit(60)), F.col("id").cast("string"), F.repeat(F.lit(" }}"), F.lit(60)), F.lit(" of ")]
    df = spark.range(0, 3000, 1, 4).select(F.concat(*mountain, *mountain).alias("t"))

    def seconds(match):
        start = time.monotonic()
        assert df.where(match(F.col("t")) != " of  of ").isEmpty()
        return time.monotonic() - start

    matched, counted = (min(seconds(match) for _ in range(3)) for match in (match_braces, count_braces))
    assert matched * 3 < counted


def test_more_hills_than_a_block_holds(spark):
    n = markup._HILLS
    texts = ["{{a}} b" * (3 * n), "{{a}} {{b" * (2 * n) + "}} c" * n, "{{o" + "{{a}} }} {{b" * (4 * n) + "}}"]
    texts += ["{{a" * n + "b}} c" * n, "x}} {{a}} {{" * (2 * n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(match_braces(F.col("t")) != count_braces(F.col("t"))).isEmpty()
