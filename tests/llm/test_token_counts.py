import hashlib
import random
import re

import pytest

from pageloom.llm import token_counts as K
from pageloom.llm.tokenizing import PieceCounter, byte_encoding

NAME = "byte_bpe_50k.tiktoken"


@pytest.mark.parametrize("leaf", [1, 2, 32])
def test_edits_equal_full_encoding(words, leaf, monkeypatch):
    monkeypatch.setattr(K, "LEAF", leaf)
    monkeypatch.setattr(K, "LARGEST_LEAF", 4 * leaf)
    counter, encoding = PieceCounter(NAME), byte_encoding(NAME)
    rng = random.Random(4)
    alphabet = "a b'\n  srevl1é日!? \t"
    texts = ["", words(300, 1)] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    for text in texts:
        tree = K.SegmentTree.of(text, counter)
        for _ in range(3):
            edits = []
            for _ in range(rng.randint(0, 5)):
                s = rng.randint(-2, len(text) + 2)
                edits.append({"start": s, "end": s + rng.choice((0, 1, 3, 20)), "text": "".join(rng.choice(alphabet) for _ in range(rng.choice((0, 1, 2, 8))))})
            todo = K.apart(edits, len(text))
            tree = K.SegmentTree.stored(tree.state())
            after, _ = tree.edit(text, todo, counter)
            want = text
            for s, e, new in reversed(todo):
                want = want[:s] + new + want[e:]
            assert after == want and tree.total == len(encoding.encode_ordinary(want)) and sum(tree.chars) == len(want)
            assert tree.tree[1] == sum(tree.tree[tree.size :])
            text = want


def test_only_touched_regions_are_encoded(words):
    counter = PieceCounter(NAME)
    text = words(50_000, 1)
    tree = K.SegmentTree.of(text, counter)
    _, n = tree.edit(text, [(1000, 1005, "new"), (200_000, 200_000, " x")], counter)
    assert n < 6 * K.LEAF


def test_all_documents_before_and_after(spark, sf_dir):
    encoding = byte_encoding(NAME)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = K.op1_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        d = docs[r["doc_id"]]
        after = f"[{d['source']}] " + re.sub("[0-9]{4,}", "[NUM]", d["text"])
        assert r["n_tokens"] == len(encoding.encode_ordinary(d["text"]))
        assert r["n_tokens_after"] == len(encoding.encode_ordinary(after))
        assert r["text_after_sha256"] == hashlib.sha256(after.encode()).hexdigest()


def test_odd_texts_and_edits(make_docs, edge_texts, spark):
    docs = make_docs(edge_texts)
    counted = K.with_counts(K.masking_edits(docs))
    rows = K.after_edits(counted).collect()
    encoding = byte_encoding(NAME)
    for r in rows:
        assert r["tokens"]["tree"][1] == len(encoding.encode_ordinary(r["text"])) and r["text"].startswith("[src0] ")
    assert K.after_edits(K.with_counts(K.masking_edits(make_docs([])))).collect() == []
    assert K.apart([None, {"start": None, "end": 1, "text": "a"}, {"start": 5, "end": 2, "text": None}], 3) == [(3, 3, "")]


def test_columns_of_the_caller_stay(spark):
    docs = spark.createDataFrame([(1, "a 12345 b", "s", 7, 8, 9)], "doc_id long, text string, source string, _RUNS int, _gaps int, _before int")
    row = K.after_edits(K.with_counts(K.masking_edits(docs))).first()
    assert (row["_RUNS"], row["_gaps"], row["_before"], row["text"]) == (7, 8, 9, "[s] a [NUM] b")
    for name, add in (("Tokens", K.with_counts), ("EDITS", K.masking_edits)):
        with pytest.raises(ValueError, match="already"):
            add(docs.withColumnRenamed("_gaps", name))
    with pytest.raises(ValueError, match="encoded"):
        K.after_edits(K.with_counts(K.masking_edits(docs)).withColumnRenamed("_gaps", "Encoded"))
    assert K.with_counts(K.masking_edits(docs.limit(0))).collect() == []
