"""Queries pay for what they ask for: pages, titles, lines, and markup that hides nothing."""

import random

import pytest
from pyspark.sql import functions as F

from pageloom import config as C
from pageloom.functions.strings import java_trim
from pageloom.operators import markup as MK
from pageloom.operators.parse import build_pages, good_pages, passed_pages
from pageloom.plans import corpus as K
from pageloom.plans import queries as Q
from pageloom.sources.dump import ESCAPED_NEWLINE, PAGE_OPEN, page_line


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["audits", "file_names"])
def test_pages_are_not_converted_where_only_they_are_asked_for(spark, sf_dir, name):
    assert "(?i:category)" not in plan(Q.queries()[name](spark, sf_dir))


def test_what_passes_is_what_passes_with_its_links_checked(spark, sf_dir):
    raw = K.faulty_corpus(spark, sf_dir).unionByName(K.rare_pages(spark, sf_dir))
    odd = ["[[]]", "[[ ]]", "[[|a]]", "[[#]]", "[[a|]]", "#REDIRECT [[ |x]]", "#REDIRECT [[#]]", "[[\x01]]", "[[a]][[", "[[[[b]]]]"]
    odd = [(f"Odd {i}", "2014-01-02T03:04:05Z", t, "f") for i, t in enumerate(odd)]
    raw = raw.unionByName(K.page_xml(spark.createDataFrame(odd, "title string, timestamp string, wikitext string, file string")))
    checked = build_pages(raw, texts=False)
    assert checked.where(F.col("status") == C.STATUS_OTHER).isEmpty()
    found, wanted = (sorted(r.vertex_id for r in p.select("vertex_id").collect()) for p in (passed_pages(raw), good_pages(checked)))
    assert found == wanted


def test_title_candidates_store_what_they_ask_for(spark, sf_dir, monkeypatch):
    stored = []
    monkeypatch.setattr(Q, "stage", lambda df, name, was=Q.stage: stored.append(df.columns) or was(df, name))
    found = plan(Q.title_candidates(spark, sf_dir))
    assert stored == [["vertex_id", *Q.G.RANK_COLUMNS, "links"]] and "date_format" not in found and C.SOURCE_URL not in found


def test_lines_are_folded_without_loops_over_them(spark):
    rng = random.Random(3)
    parts = [" ", "\t", "\r", "\n", "\r\n", "a", "<page>", "\x01", "\\n", "ü", "\x1f", "$1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(2000)] + ["<page>\n a", "<page> \r\n\n b", " " * 200_000, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lines = F.array_join(F.transform(F.split("t", "\r\n|\n|\r"), java_trim), ESCAPED_NEWLINE)
    wanted = F.regexp_replace(lines, r"\A<page>\\n", PAGE_OPEN)
    folded = df.select(page_line(F.col("t")).alias("line"))
    assert [r[0] for r in folded.collect()] == [r[0] for r in df.select(wanted).collect()]
    assert "lambda" not in plan(folded)


def test_texts_with_nothing_to_hide_pass_the_rules_unchanged(spark, sf_dir):
    rng = random.Random(5)
    parts = [" ", "\n", "a", "[[A|b]]", "_", "__TOC__", "#", "#REDIRECT [[x]]", "{{", "}}", "{|", "|}", "<b>", ":", "[[File:x]]", "\x01", "￾", "�", "\r", "😀", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(7))) for _ in range(2000)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "wikitext string")
    hidden = MK.hide_markup(df, MK.HIDING_RULES).select("_markup").collect()
    ruled = MK.apply_rules(df.withColumn("_markup", F.col("wikitext")), "_markup", MK.HIDING_RULES).select("_markup").collect()
    assert hidden == ruled
    lots = K.pages_of(spark, sf_dir, "lineitem")
    assert lots.where(~F.rlike("wikitext", F.lit(MK._NOTHING_HIDDEN))).isEmpty()
