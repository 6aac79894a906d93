"""Golden strings: one small text per rule."""

import random

from pyspark.sql import functions as F

from pageloom.config import ImportConfig
from pageloom.functions.arrays import sum_before
from pageloom.operators.markup import HIDING_RULES, convert_markup

# rule, wikitext, text, links (kind initial, target, start, end)
GOLDEN = [
    ("mixed", "x [[Beta|the ''b'']]s {{t|{{u}}}}and [[Gamma#Sec]] [[Category:Z]]<!-- [[no]] --> 😀 [[#l]] [a] end",
     "x the bs and Gamma#Sec  😀 #l [a] end",
     [("i", "Beta", 2, 8), ("i", "Gamma#Sec", 13, 22), ("i", "#l", 26, 28)]),
    ("list", "By [[C 5]].\n== Lines ==\n* [[P 3#lot|lot]] a\n* b", "By C 5.\n\n1. Lines\n\nlot a\nb",
     [("i", "C 5", 3, 6), ("i", "P 3#lot", 19, 22)]),
    ("redirect", "#REDIRECT [[N 5#x|y]] more [[Z]]abc", "REDIRECT: N 5#x more Zabc",
     [("i", "Z", 21, 25), ("r", "N 5#x", 10, 15)]),
    ("redirect to category", "#redirect [[Category:X]]", "REDIRECT: Category:X", [("r", "Category:X", 10, 20)]),
    ("sections", "== a ==\n=== b ===\n=== c ===\n== d ==\n==== e ====\n=== f ===\n=== g ===\n= h =\n== i ==",
     "1. a\n\n1.1. b\n\n1.2. c\n\n2. d\n\n2.1.1. e\n\n2.1. f\n\n2.2. g\n\nh\n\n1. i", []),
    ("link in heading", "t\n== [[A]] x ==\ny", "t\n\n1. A x\n\ny", [("i", "A", 6, 7)]),
    ("unequal heading", "=== A ==", "1. = A", []),
    ("table", '{| class="x"\n|+ Cap\n! h1 !! style="a" | h2\n|-\n| a || style="b" | b [[Q|q]]\n|-\n| c\n| d\n|}\nafter || x',
     "Cap\nh1 h2\na b q\nc d\nafter || x", [("i", "Q", 14, 15)]),
    ("nested table", "{| a\n| x\n{| b\n| y || z\n|}\n| w\n|}\nt", "x\ny z\nw\nt", []),
    ("pipes outside", "| a\n! b!! c\n|} d", "| a\n! b!! c\n|} d", []),
    ("emphasis", "''i'' '''b''' '''''bi''''' ''''four'''' it's '''''''x", "i b bi 'four' it's ''x", []),
    ("external", "see [http://x.y/z site] and [http://q.r] [mailto:a@b c] http://bare.z",
     "see [1] site (http://x.y/z) and [2]  (http://q.r) [3] c (mailto:a@b) http://bare.z", []),
    ("deep templates", "{{a|{{b|{{c|{{d|{{e}}}}}}}}}}z{{{p}}} {{un", "z {{un", []),
    ("references", "a&nbsp;b &foo; &#128512; &#x41; &amp;lt; a&b AT&T; &#1; &#99999999;",
     "a b &foo; 😀 A &lt; a&b AT&T; &#1; &#99999999;", []),
    ("elements", "x<BR/>y<ref name=a>r</ref>z<ref n=b />w<i>v</i><nowiki>[[n]]</nowiki>", "x\nyzwv", []),
    ("only template", "{{only}}", "{{only}}", []),
    ("empty", "", "", []),
    ("image", "[[File:x.jpg|thumb|cap [[L]] [http://a b]]]t __TOC__ [[:Category:X]] [[ A ]]",
     "t  :Category:X  A ", [("i", ":Category:X", 3, 14), ("i", " A ", 15, 18)]),
    ("paragraphs", "----\npara one\n\npara two\n* i1\n** i2\ntext\n; def : x",
     "para one\n\npara two\n\ni1\ni2\ntext\n; def : x", []),
    ("brackets", "[[[[[[a]]]]]]", "[[[[a]]]]", [("i", "a", 4, 5)]),
    ("title forms", "[[A|]]x[[B|[c] d]]", "x[c] d", [("i", "A", 0, 1), ("i", "B", 1, 6)]),
    ("no target", "[[]] [[|x]]", "[[]] [[|x]]", []),
    ("marks in input", "a\x01b\x06c\x0e[[L]]", "abcL", [("i", "L", 3, 4)]),
    ("category", "a [[category:X|s]]b [[ Category : Y]]", "a  ", []),
    ("single brace", "{{m|{x}}} {y} {{n|a{b}c}}", "} {y} ", []),
]


def convert(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, wikitext string")
    return convert_markup(df, **kw).orderBy("i").collect()


def test_golden(spark):
    for (name, _, text, links), row in zip(GOLDEN, convert(spark, [g[1] for g in GOLDEN])):
        assert row.text == text, name
        assert [(k.kind[0], k.target, k.start, k.end) for k in row.links] == links, name
        for k in row.links:
            assert row.text[k.start : k.end] == k.surface, name


def test_residue_counts_what_is_left(spark):
    rows = convert(spark, ["{{a [[b", "; d\n: e", "plain"])
    assert [r.residue for r in rows] == [2, 2, 0]


def test_any_text_keeps_offsets_right(spark):
    """Random markup soup: surfaces are where the offsets say."""
    rng = random.Random(7)
    bits = ["[[", "]]", "|", "{{", "}}", "''", "'''", "\n", "== ", " ==", "* ", "{|", "|}", "|-", "a", "b c",
            "<br>", "<ref>", "</ref>", "[http://x y]", "&amp;", "😀", "Category:", "#", "[[A]]", "[[B|b]]"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(400)]
    for text, row in zip(texts, convert(spark, texts)):
        for k in row.links:
            assert row.text[k.start : k.end] == k.surface, text
            assert k.target is not None, text


def test_page_with_very_many_links_and_depth(spark):
    n = 30_000
    big = "".join(f"[[T{i}|w]] " for i in range(n))
    deep = "{{x|" * 60 + "}}" * 60 + "end"
    row, nested = convert(spark, [big, deep])
    assert len(row.links) == n
    assert [(k.start, k.end) for k in row.links[:3]] == [(0, 1), (2, 3), (4, 5)]
    assert (row.links[-1].target, row.links[-1].start) == (f"T{n - 1}", 2 * (n - 1))
    assert nested.text == "end"


def test_sum_before_in_blocks(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x.cast("int")).alias("a"))
    got = df.select(sum_before(F.col("a")).alias("s")).first().s
    assert got == [i * (i + 1) // 2 for i in range(1001)]
    assert spark.sql("select cast(array() as array<int>) a").select(sum_before(F.col("a")).alias("s")).first().s == [0]


def test_own_rule_and_self_anchors(spark):
    shout = ("shout", lambda c: F.replace(c, F.lit("!"), F.lit("[[Noise]]")))
    (row,) = convert(spark, ["a! [[#x]]"], rules={"hide": (*HIDING_RULES, shout)}, cfg=ImportConfig(drop_self_anchors=True))
    assert row.text == "aNoise #x"
    assert [k.target for k in row.links] == ["Noise"]
