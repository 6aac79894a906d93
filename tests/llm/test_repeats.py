import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import repeats as R


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone])
        out.append((len(d), [tuple(e) for e in edges.tolist()], kept))
    return out


@pytest.fixture(scope="module")
def case(words):
    rng = random.Random(3)
    passage, line = words(14, 70), words(5, 71)
    texts = [None, "", "short", None, "é" * 100, "ab" * 150, words(40, 72), words(40, 72), passage[:39] + "é", "x" * 39 + passage[:40]]
    for k in range(60):
        a = words(rng.randrange(1, 60), 100 + k)
        cut = rng.randrange(len(passage))
        texts.append(f"{a}{passage[cut:]}{line}{rng.choice('abc')}{words(rng.randrange(1, 40), 300 + k)}{passage[:cut] if k % 3 else ''}")
    texts.append(words(4000, 73) + passage)
    return texts


@pytest.mark.parametrize(("length", "gram", "hot"), [(40, 17, 10**6), (40, 17, 3), (64, 20, 10**6), (40, 40, 10**6), (30, 1, 10**6)])
def test_removed_bytes_equal_brute_force(make_docs, case, length, gram, hot):
    ids = [k // 2 for k in range(len(case))]
    rows = R.remove_repeats(make_docs(case, ids), length=length, gram=gram, hot=hot).collect()
    got = sorted((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows)
    assert got == sorted((i, *x) for i, x in zip(ids, brute(case, length)))


def test_many_buckets_and_cells(make_docs, case, monkeypatch):
    monkeypatch.setattr(R, "BUCKET_ANCHORS", 50)
    monkeypatch.setattr(R, "CELL_BYTES", 2000)
    rows = R.remove_repeats(make_docs(case), length=40, gram=17).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in rows} == {k: x[2] for k, x in enumerate(brute(case, 40))}


def test_suffixes_are_sorted(words):
    data = np.frombuffer((words(300, 5, 6) + "ab" * 50).encode(), dtype=np.uint8)
    sorter = R.SuffixSorter(data, 20)
    starts = np.arange(len(data) - 20)
    group = starts % 3
    order = sorter.sort(starts, group)
    keys = [(int(group[k]), data[starts[k] : starts[k] + 20].tobytes()) for k in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(starts)))


def test_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(R, "stretch_hashes", lambda p, s, e, *_: np.zeros(len(s), dtype=np.uint64))
    data = np.frombuffer(b"abcdefghij" * 2 + b"zzzzz", dtype=np.uint8)
    found = R.repeated_windows(data, np.array([0, 3, 20]), np.zeros(3, dtype=np.int64), 5)
    assert not found.any()


def test_empty_table_and_digest(spark, make_docs, sf_dir):
    assert R.remove_repeats(make_docs([])).collect() == []
    rows = R.op2_repeat_removal(spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(docs, brute(docs.values(), 200)))
    assert len(rows) == len(docs)
    for r in rows:
        n, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
