import random
import re
from collections import defaultdict

import numpy as np
import pytest

from pageloom.llm import neardup as N
from pageloom.llm.graph import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(ids, texts):
    sets = [grams(t) for t in texts]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k in range(len(sets)):
        least[find(k)].append(ids[k])
    return sorted((ids[k], min(least[find(k)]), links[k]) for k in range(len(sets)))


@pytest.fixture(scope="module")
def case(words, edge_texts):
    rng = random.Random(9)
    texts = [t for t in edge_texts if not t or len(t) < 50_000] + ["a b c", "A, b. C!", "a b c d"]
    for family in range(6):
        base = words(120, 50 + family).split()
        for _ in range(14):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 4))):
                own[rng.randrange(len(own))] = "x%d" % rng.randrange(1000)
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize(("members", "grams_"), [(1024, 1 << 19), (5, 1 << 19), (1024, 300)])
def test_links_and_classes_equal_brute_force(make_docs, case, members, grams_, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(N, "BLOCK_GRAMS", grams_)
    monkeypatch.setattr(N, "FREQUENT", 3)
    rows = N.near_duplicates(make_docs(case)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, rows)) == brute(list(range(len(case))), case)


def test_one_of_each_class_stays(make_docs, case):
    docs = make_docs(case)
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = [i for i, c, _ in brute(list(range(len(case))), case) if i == c]
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_repeated_rows_and_null_ids(make_docs, words):
    text = words(30, 1)
    docs = make_docs([text, text, text, words(30, 2), None, None], [3, 3, 5, None, 7, 7])
    assert sorted((r["doc_id"] or -1) for r in N.drop_near_duplicates(docs).collect()) == [-1, 3, 7]
    assert N.near_duplicates(make_docs([])).collect() == []


def test_bands_reach_the_recall():
    b = N.bands_for(0.8, 0.9999, 5)
    assert 1 - (1 - 0.8**5) ** b >= 0.9999 > 1 - (1 - 0.8**5) ** (b - 1)


def test_intersections_equal_sets(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(N, "PAIRS", 7)
    monkeypatch.setattr(N, "FREQUENT", 2)
    a, b = ([np.unique(rng.integers(0, 60, rng.integers(0, 30))).astype(np.uint64) for _ in range(12)] for _ in range(2))
    got = N.intersections(a, b)
    assert all(got[i, j] == len(np.intersect1d(x, y)) for i, x in enumerate(a) for j, y in enumerate(b))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(139, 200), (500, 500), (7, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in (100, 139, 200)} == {100} and got[500] == 500
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
