"""Short pages take cheaper ways, with the results of the general ones."""

import itertools
import random

from pyspark.sql import functions as F

from pageloom.functions import arrays
from pageloom.functions.arrays import sum_before
from pageloom.operators import markup
from pageloom.operators.markup import count_sections, section_labels
from pageloom.operators.parse import parse_pages


def test_up_to_two_headings_are_labelled_as_the_fold_does(spark):
    levels = [list(x) for n in range(4) for x in itertools.product(range(1, 7), repeat=n)]
    df = spark.createDataFrame([(x,) for x in levels], "levels array<int>")
    assert df.where(section_labels(F.col("levels")) != count_sections(F.col("levels"))).isEmpty()


def test_sums_before_few_and_many_values_are_the_same(spark, monkeypatch):
    sizes = [0, 1, 2, arrays._FEW - 1, arrays._FEW, arrays._FEW + 1, arrays._BLOCK, arrays._BLOCK + 1]
    df = spark.createDataFrame([([(i * i) % 7 for i in range(n)],) for n in sizes], "x array<int>")
    sums = [r[0] for r in df.select(sum_before(F.col("x"))).collect()]
    assert sums == [[0, *itertools.accumulate((i * i) % 7 for i in range(n))] for n in sizes]


def test_targets_are_those_of_the_whole_links(spark):
    texts = ["[[a]]b[[c|d]]e", "[[a|b[c]d]]x", "[[a|b", "[[a|]]", "[[|a]]", "[[a|b[[c]]d]]", "[[[a]]]", "[[a b|c|d]]s [[e#f]]g", "[[a\n]]", "[[a|b\nc]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole, targets = (F.regexp_extract_all("t", F.lit(p), F.lit(1)) for p in (markup._LINK, markup._LINK_TARGET))
    assert df.where(whole != targets).isEmpty()


def test_few_headings_and_pieces_are_told_without_a_loop(spark):
    """Each heading costs no step of a fold: the usual text is numbered, cut and placed as the
    general expressions do it."""
    rng = random.Random(3)
    marks = [markup.HEADING + "=" * n + markup.LEVEL_END for n in range(1, 7)]
    texts = ["".join(rng.choice(["é", "b\n", " ", *marks[:4]]) for _ in range(rng.randrange(12))) for _ in range(200)]
    texts += [a + "x" + b for a in marks for b in ("", *marks)] + [markup.MARK.join("é" * (i % 3) for i in range(n)) for n in range(1, 14)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    many = F.when(F.contains("t", F.lit(markup.HEADING)), markup.number_many_sections(F.col("t"))).otherwise(F.col("t"))
    assert df.where(markup.number_sections(F.col("t")) != many).isEmpty()
    pieces = df.select(markup._cut(F.col("t")).alias("p"))
    assert pieces.where(markup._piece_starts(F.col("p")) != sum_before(F.col("p"), F.length)).isEmpty()


def test_paragraphs_are_written_by_one_search_as_by_two(spark):
    rng = random.Random(4)
    usual = ["a", "\n", markup.GAP, markup.LINE, markup.TABLE, markup.ROW, " "]
    texts = ["".join(rng.choice(usual + extra) for _ in range(rng.randrange(14))) for extra in ([], [markup.PARAGRAPH]) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    joined = F.regexp_replace("t", rf"\x04[{markup._BREAKS}]*+", markup.PARAGRAPH)
    assert df.where(markup.write_paragraphs(F.col("t")) != F.regexp_replace(joined, r"[\n\x03\x0e\x0f]++\x04", "\n\n")).isEmpty()


def test_one_search_reads_a_plain_page(spark):
    """The search is in one projection with its answer, where it runs once, and in no branch."""
    raw = spark.createDataFrame([("<page></page>", "f", "f", 0)], "raw string, file string, file_path string, file_block_start long")
    plan = parse_pages(raw)._jdf.queryExecution().optimizedPlan().toString()
    branches = [line for line in plan.split("\n") if "</revision>" in line and "CASE WHEN" in line.split("</revision>")[0]]
    assert not branches
