import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import differencing as D


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_differencing_deals_every_length_once():
    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(0, 40))]
        n = rng.randint(1, 9)
        windows = D.differencing(lengths, n)
        assert len(windows) <= n
        assert sorted(k for _, own in windows for k in own) == list(range(len(lengths)))
        assert [s for s, _ in windows] == sorted((sum(lengths[k] for k in own) for _, own in windows), reverse=True)


def test_known_partitions():
    # Two-way differencing of these leaves 2 of a total of 30; three ways come out even.
    assert [s for s, _ in D.differencing([8, 7, 6, 5, 4], 2)] == [16, 14]
    assert [s for s, _ in D.differencing([5, 5, 4, 4, 3, 3], 3)] == [8, 8, 8]


def test_differencing_is_near_the_best():
    rng = random.Random(4)
    worse = 0
    for _ in range(40):
        lengths = [rng.randint(1, 30) for _ in range(7)]
        best = min(max(sum(s for s, w in zip(lengths, c) if w == b) for b in range(3)) for c in itertools.product(range(3), repeat=7))
        worse += D.differencing(lengths, 3)[0][0] - best
    assert worse / 40 < 2


def test_window_count_rises_where_the_fullest_is_too_full():
    # 3 x 6 = 18 would fit two windows of 10 by volume only.
    assert [s for s, _ in D.near_equal_windows([6, 6, 6], 10)] == [6, 6, 6]
    assert D.near_equal_windows([], 10) == []


def check(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    lengths = []
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        lengths.append(end)
    assert max(lengths, default=0) <= capacity
    return lengths


def padding(lengths, capacity):
    return sum(capacity - n for n in lengths if n & (n - 1))


def expected(tokenizer, rows):
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def assert_pieces_are_the_documents(rows, docs):
    """Pieces tile each document and hold its ids. Ids are unique here."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert set(by_doc) == {i for i, _ in docs}
    for i, ids in docs:
        at = 0
        for start, length, crc, n in sorted(by_doc[i]):
            assert (start, n) == (at, len(ids))
            assert crc == zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())
            at += length
        assert at == len(ids)


def test_documents_fill_windows(make_docs, edge_texts, words, tokenizer, monkeypatch):
    monkeypatch.setattr(D, "PART_CHARS", 5_000)
    texts = edge_texts + [words(random.Random(k).randint(1, 900), k) for k in range(150)]
    docs = make_docs(texts).repartition(5)
    rows = D.pack_by_differencing(docs, group=8).collect()
    assert_pieces_are_the_documents(rows, expected(tokenizer, enumerate(texts)))
    assert padding(check(rows, 2048), 2048) == 0


def test_rounds_meet_until_one_group_is_left(make_docs, words, tokenizer):
    texts = [words(60, k) for k in range(80)]
    # 40 tasks leave parts of windows of 64 tokens over; groups of two windows need rounds.
    rows = D.pack_by_differencing(make_docs(texts).repartition(40), capacity=64, group=2).collect()
    assert_pieces_are_the_documents(rows, expected(tokenizer, enumerate(texts)))
    lengths = check(rows, 64)
    assert padding(lengths, 64) == 0
    assert sum(n < 64 for n in lengths) <= 6


def test_repeated_rows_null_ids_and_an_empty_table(make_docs, words):
    texts = ["one two", "one two", None, "", words(3_000, 1), words(3_000, 1)]
    docs = make_docs(texts, [5, 5, None, None, 7, 7])
    rows = D.pack_by_differencing(docs).collect()
    check(rows, 2048)
    totals = defaultdict(int)
    for r in rows:
        totals[r["doc_id"]] += r["length"]
    whole = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert totals == {5: 2 * whole[5], None: 2, 7: 2 * whole[7]}
    assert D.pack_by_differencing(make_docs([])).collect() == []
