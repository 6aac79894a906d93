import hashlib
import zlib
from collections import defaultdict

import pytest

from pageloom.llm import sharding as S


def brute_capacity(sizes, shards):
    def fits(capacity):
        n, room = 0, -1
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n <= shards

    return next(c for c in range(-(-sum(sizes) // shards), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("ranges", [1 << 14, 16])
def test_least_capacity_groups_and_slots(make_docs, words, edge_texts, ranges, monkeypatch):
    monkeypatch.setattr(S, "SUMMARY_RANGES", ranges)
    monkeypatch.setattr(S, "SLOT_ROWS", 3)
    texts = [t for t in edge_texts if not t or len(t) < 5000] + [words(n % 60 + 1, n % 37) for n in range(300)] + [words(40, 5)] * 30
    rows = S.shard_documents(make_docs(texts, [k // 2 for k in range(len(texts))]), 7).collect()
    assert len(rows) == len(texts)
    by_key, shards, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    groups = defaultdict(int)
    for t in texts:
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 16
    for r in rows:
        by_key[r["key"]].add(r["shard"])
        shards[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in by_key.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(shards.values()) == brute_capacity([groups[k] for k in sorted(groups)], 7)
    assert set(shards) <= set(range(7))
    assert sorted(r["text_crc32"] for r in rows) == sorted(zlib.crc32((t or "").encode()) for t in texts)


def test_one_group_larger_than_a_share_leaves_the_others_even(make_docs, words):
    texts = [words(50, 1)] * 100 + [words(50, n + 2) for n in range(100)]
    rows = S.shard_documents(make_docs(texts), 10).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 10
    # The fair share beside the large group is 2,787 bytes; a cut may only fall near it.
    assert sorted(sizes.values())[-2] < 2 * 2787 and sorted(sizes.values())[2] > 2500


def test_empty_and_few(make_docs):
    assert S.shard_documents(make_docs([])).collect() == []
    rows = S.shard_documents(make_docs([None, "", "a"])).collect()
    assert len({r["shard"] for r in rows if r["key"] == hashlib.sha256(b"").hexdigest()}) == 1
