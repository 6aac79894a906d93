"""Chains and circles of redirects, and braces nested to any depth."""

import random

import time

import pytest
from pyspark.sql import functions as F

from pageloom import config as C
from pageloom.operators.markup import match_braces
from pageloom.operators.redirects import follow_redirects, through_redirects


def brute(edges):
    found = {}
    for src in edges:
        at, seen = src, []
        while at in edges and at not in seen:
            seen.append(at)
            at = edges[at]
        found[src] = (None, None, True) if at in edges else (at, len(seen), False)
    return found


@pytest.mark.parametrize("rows", [500_000, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_redirects(spark, seed, rows):
    rng = random.Random(seed)
    edges = {f"v{k}": f"v{rng.randrange(400)}" for k in rng.sample(range(400), 250)}
    edges |= {f"c{k}": f"c{k + 1}" for k in range(70)}  # a chain of 70
    edges |= {f"h{k}": "c0" for k in range(100)}  # many into it
    edges |= {"self": "self", "x": "self"}
    df = spark.createDataFrame(list(edges.items()), "src string, dst string").repartition(4)
    cfg = C.ImportConfig(broadcast_rows=rows)
    followed = follow_redirects(df, cfg)
    got = {r.src: (r.target, r.hops, r.in_cycle) for r in followed.collect()}
    assert got == brute(edges)
    links = spark.createDataFrame([("a", "h3", 1), ("a", "x", 2), ("b", "none", 3), ("b", "h3", 4)], "src string, dst string, n int")
    ends = {r.n: r.final_dst for r in through_redirects(links, followed, cfg).collect()}
    assert ends == {1: "c70", 2: "x", 3: "none", 4: "c70"}


def test_no_redirects(spark):
    assert follow_redirects(spark.createDataFrame([], "src string, dst string")).collect() == []


def matched(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, c string")
    return [r.t for r in df.select("k", match_braces(F.col("c")).alias("t")).orderBy("k").collect()]


def nested(rng, depth):
    body = "".join(
        rng.choice(["x", " {y ", "}z", "\n"]) if depth == 0 or rng.random() < 0.5 else f"{rng.choice(['', ' ', '|'])}{nested(rng, depth - 1)} "
        for _ in range(rng.randint(0, 3))
    )
    # A run of braces means one thing only if what it opens begins with something else.
    return "{{" + f"t{body}" + " }}" if rng.random() < 0.6 else "{{{" + f"p{body}" + rng.choice([" ", "}z ", "-"]) + "}}}"


def top_level(rng):
    """Text with nested templates and parameters, and the same without them."""
    parts, want = [], []
    for _ in range(rng.randint(0, 6)):
        plain = rng.choice(["a", "b c", " {d} ", "\n", " }} ", ""])
        parts += [plain, nested(rng, rng.randint(0, 6)) + " "]
        want += [plain, " "]
    tail = rng.choice(["", " {{ open", "{{{x", " {{ {{{a "])
    return "".join([*parts, tail]), "".join([*want, tail])


def test_nested_braces_go_and_others_stay(spark):
    rng = random.Random(5)
    cases = [top_level(rng) for _ in range(300)]
    cases += [(t, t) for t in ("", "a", "{{", "}}", "x }} {{ y", "{ }}")]
    cases += [("{{a}} }}", " }}"), ("{{ {{b}} c", "{{  c"), ("x }} {{a}} {{ y", "x }}  {{ y"), ("{{a}}}", "}"), ("{{a|{{{b}}}}}", "")]
    cases += [("{{a" * 300 + " }}" * 200, "{{a" * 100), ("{{a" * 300 + "}}" * 300 + "x", "x"), ("{{a }} }} " * 300, " }} " * 300)]
    # Many blocks of tokens.
    many = [(t, w) for t, w in (top_level(rng) for _ in range(200)) if "{{" not in w and "}}" not in w]
    cases.append(("".join(t for t, _ in many), "".join(w for _, w in many)))
    assert matched(spark, [t for t, _ in cases]) == [w for _, w in cases]


def test_runs_of_braces_match_from_inside(spark):
    texts = {"{{{{{a}}}}}": "", "{{{{{a}} b}}}": "", "{{{{{a}}} b}}": "", "{{" * 300 + "}}" * 300 + "x": "x", "{{{{a}} b}}c": "c", "{{{{ {{a}}": "{{{{ "}
    assert matched(spark, list(texts)) == list(texts.values())


@pytest.mark.parametrize(
    ("text", "want"),
    [("{{a|" * 330_000 + "}}" * 330_000, ""), ("{{{a|b" * 180_000 + " }}} " * 180_000, " "), ("{{a}} {{" * 250_000, " {{" * 250_000)],
    ids=["run", "parameters", "open"],
)
def test_two_megabytes_of_braces_take_linear_time(spark, text, want):
    start = time.monotonic()
    assert len(text) > 1_950_000
    assert matched(spark, [text])[0] == want
    assert time.monotonic() - start < 40
