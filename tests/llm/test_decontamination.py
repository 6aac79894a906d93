import random
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from pageloom.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    out = {}
    for k, t in enumerate(texts):
        w = split(t)
        hit, ids, longest = set(), set(), 0
        for i, item in items:
            own = split(item)
            n = min(10, len(own))
            for a in range(len(own) - n + 1) if n and i is not None else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == own[a : a + n]:
                        hit.update(range(b, b + n))
                        ids.add(i)
                        m = n
                        while a + m < len(own) and b + m < len(w) and own[a + m] == w[b + m]:
                            m += 1
                        longest = max(longest, m)
        out[k] = (len(w), len(hit), sorted(ids), longest)
    return out


@pytest.fixture(scope="module")
def case(words):
    p, q = words(25, 100), words(14, 101)
    items = [(1, p), (2, q), (3, "Alpha beta"), (4, None), (5, ""), (6, "..."), (2, q), (7, p), (None, words(12, 102)), (8, "solo"), (9, words(10, 103))]
    a, b = p.split(), q.split()
    texts = [
        None, "", "?", p, " ".join(a[3:14]), " ".join(a[:9]), words(30, 7) + " " + p.upper() + ". " + q, " ".join(b[:10] + b[:10] + b[4:]),
        "ALPHA, beta! gamma", "alpha gamma beta", "solo", "so lo", words(12, 102), " ".join(a[:12] + ["x"] + a[12:]), (p + " ") * 50,
        words(30_000, 8) + " " + p, "alpha", "beta", words(10, 103), "é" + p, p + "é", p, p,
    ]
    return texts, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_matches_equal_brute_force(spark, make_docs, case, block_bytes):
    texts, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.match_benchmark(make_docs(texts), bench, match_col="m", block_bytes=block_bytes).select(
        "doc_id", "m.*", F.aggregate("m.runs", F.lit(0), lambda n, r: n + r["end"] - r["start"]).alias("n_hit")
    )
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["longest"]) for r in found.collect()}
    assert got == brute(texts, items)


def test_decontamination_keeps_clean_rows_as_they_are(spark, make_docs, case):
    texts, items = case
    docs = make_docs(texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    want = [k for k, v in brute(texts, items).items() if not v[1]]
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_empty_tables(spark, make_docs, words):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([words(20, 1), None])
    assert D.decontaminate(docs, bench).count() == 2
    assert D.decontaminate(make_docs([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_hash_collisions_do_not_count(monkeypatch, words):
    from pageloom.llm import words as W
    import numpy as np
    import pyarrow as pa

    tests = D.TestSuffixes.of([(1, "aaa bbb")], 10)
    monkeypatch.setattr(D, "stretch_hashes", lambda p, s, e: np.zeros(len(s), dtype=np.uint64))
    searcher = D.Searcher(tests)
    monkeypatch.setattr(W.Words, "hashes", lambda self: np.zeros(len(self.starts), dtype=np.uint64))
    (chunk,) = W.chunks(pa.array(["ccc ddd"]))
    assert len(searcher.search(W.words_of(chunk))[0]) == 0


def test_sorted_suffixes_and_windows_equal_plain_ones(words):
    rng = random.Random(4)
    for _ in range(60):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 8))]
        tests = D.TestSuffixes.of(list(enumerate(texts)), 5)
        ids, ends = tests.ids.tolist(), tests.ends.tolist()
        suffixes = [ids[p : ends[p]] for p in tests.sorted.tolist()]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(t.split()) for t in texts)
        found = {tuple(w[:n]): tests.items_of(k) for k, (w, n) in enumerate(zip(tests.windows.tolist(), tests.lengths.tolist()))}
        number = {w: k for k, w in enumerate(tests.words, 1)}
        want = {}
        for item, text in enumerate(texts):
            own = [number[w.encode()] for w in text.split()]
            n = min(5, len(own))
            for a in range(len(own) - n + 1) if n else ():
                want.setdefault(tuple(own[a : a + n]), set()).add(item)
        assert found == want


def test_one_item_of_a_megabyte(spark, make_docs, words):
    """Memory and time grow with the item, also where a document holds all of it."""
    rng = random.Random(5)
    item = " ".join(f"t{rng.randrange(3_000)}" for _ in range(200_000))
    own = item.split()
    texts = [words(500, 3), "x " + item, " ".join(own[1_000:1_030]), "ab " * 300_000]
    bench = spark.createDataFrame([(1, item), (2, "ab " * 250_000)], "item_id long, text string")
    tracemalloc.start()
    start = time.monotonic()
    D.TestSuffixes.of([(1, item), (2, "ab " * 250_000)], 10)
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
    found = D.match_benchmark(make_docs(texts), bench, match_col="m").select("doc_id", "m.longest", F.size("m.runs").alias("n"))
    assert {r["doc_id"]: (r["longest"], r["n"]) for r in found.collect()} == {0: (0, 0), 1: (200_000, 1), 2: (30, 1), 3: (250_000, 1)}
    assert time.monotonic() - start < 60
