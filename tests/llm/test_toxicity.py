import random
import zlib

import pytest
from pyspark.sql import functions as F

from pageloom.llm import toxicity as X


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = ["abcab", "abc", "bcabca*", "ab*", "caabbc", "aaaaa*", "cabab"]
    automaton = X.LexiconAutomaton(terms)
    for _ in range(6000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        want = []
        for k, t in enumerate(terms):
            stem = t.rstrip("*")
            ds = [distance(word[:n], stem) for n in range(len(word) + 1)] if t.endswith("*") else [distance(word, stem)]
            d = min(ds)
            if d == 0 or (d == 1 and len(stem) >= X.EDIT_LETTERS):
                want.append((k, d))
        assert list(automaton.matches(word)) == want, word


def test_quotation_counts_less_than_abuse():
    model = X.ToxicityModel(["idiot"], [[[5.0] * X.LEVELS, [2.5] * X.LEVELS]], [1.0, 0.25, 0.5, 0.1, 0.25], -3.0)
    automaton = X.LexiconAutomaton(model.terms)
    score = lambda t: model.score(X.hits_of(automaton, t))
    assert score("you idiot") > score("an idiot here") > score("an idi0t here") > score("nothing here")
    assert score('the word "idiot" here') < score("an idiot here")
    assert score(None) == score("") == score("nothing")


def test_held_out_rows(spark):
    ids = [0, 1, 5, 12345, -7]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", X.held_out(F.col("i")).alias("h")).collect()
    assert {r["i"]: r["h"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return X.op9_toxicity(spark, sf).join(labels, "doc_id").collect()


def test_held_out_accuracy(scored):
    own = [r for r in scored if r["held_out"]]
    right = sum(r["predicted"] == r["toxic"] for r in own)
    assert len(own) > 500 and right >= 0.97 * len(own)
    pairs = [(a["score"], b["score"]) for a in own if a["toxic"] for b in own if not b["toxic"]]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) >= 0.95 * len(pairs)


def test_labels_of_held_out_rows_are_never_read(spark, make_docs, words):
    texts = [("vile " if k % 2 else "") + words(20, k) for k in range(400)]
    docs = make_docs(texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = X.train(docs, labels), X.train(docs, flipped)
    assert a == b and any(t.rstrip("*") in "vile" for t in a.terms)


def test_small_odd_and_empty_tables(spark, make_docs, edge_texts):
    docs = make_docs(edge_texts + ["vile thing"] * 3)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.drop_toxic(docs, none).count() == docs.count() and X.drop_toxic(docs, none).columns == docs.columns
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    assert X.score_toxicity(docs, X.train(docs, odd), score_col="s").count() == docs.count()
    assert X.drop_toxic(make_docs([]), none).collect() == []


def swap_distance(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            d = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, rows[i - 2][j - 2] + 1)
            rows[i].append(d)
    return rows[-1][-1]


def test_edits_grow_with_the_term_and_swaps_are_one():
    rng = random.Random(5)
    terms = ["abc", "bcab", "abcab*", "cabbcab", "aabbccab*", "abcabcabc"]
    model = X.ToxicityModel(terms)
    automaton = model.automaton()
    for _ in range(6000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 11)))
        if rng.random() < 0.5:
            word = list(rng.choice(terms).rstrip("*"))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(word) - 1)
                word[k], word[k + 1] = word[k + 1], rng.choice([word[k], "a"])
            word = "".join(word)
        want = []
        for k, t in enumerate(terms):
            stem = t.rstrip("*")
            d = min(swap_distance(word[:n], stem) for n in (range(len(word) + 1) if t.endswith("*") else [len(word)]))
            if d <= (len(stem) >= 4) + (len(stem) >= 7):
                want.append((k, d))
        assert list(automaton.matches(word)) == want, word


def test_misspelled_abuse_is_caught_and_look_alikes_are_not(spark, make_docs, words):
    terms = ["scum", "stupid", "trash", "idiot", "moron", "pathetic", "worthless"]
    alike = ["slum", "studio", "crash", "idiom", "baron", "prosthetic", "worth-less"]
    texts = [f"{words(20, k)} {alike[k % 7]} {words(5, k)} {' '.join(terms[(k + n) % 7] for n in range(3)) if k % 2 else ''}" for k in range(600)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(600)], "doc_id long, toxic int")
    model = X.train(make_docs(texts), labels)
    automaton = model.automaton()
    assert {t.rstrip("*")[:3] for t in model.terms} == {t[:3] for t in terms}
    bad = ["scvm", "csum", "s*um", "idoit", "stupdi", "st*pid", "tr@sh", "id!ot", "mor_n", "pahtteic", "worthlezz", "w0rthl3ss", "path-tic"]
    clean = model.score([])
    for word in bad:
        assert model.score(X.hits_of(automaton, f"so {word} here")) > clean, word
    for word in [*alike, "well-known", "is-it", "don't", "a.b.c.d", "-" * 50, "a." * 500_000, "a" * 1_000_000]:
        assert X.hits_of(automaton, f"so {word} here") == [], word
    for k in range(len(bad)):
        assert model.score(X.hits_of(automaton, "you " + " ".join(bad[k:] + bad[:k]))) > 0.5
    assert model.score(X.hits_of(automaton, "a " + " and ".join(alike))) == clean
