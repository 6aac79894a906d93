import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import packing as P
from pageloom.llm import tokenizing as K


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_equal_the_tokenizer_s(tokenizer, monkeypatch):
    monkeypatch.setattr(K, "KNOWN_WORDS", 200)
    own = K.WordTokenizer("word_bpe_49k.json")
    rng = random.Random(5)
    alphabet = "aB'é <|\n\t.,1Σ́日sßÿ\x1c\x85"
    texts = ["", "it's 'sx don't", "a<|endoftext|>b", "Σίσυφος ΟΔΥΣ", "ﬁ ² ª µ", "🙂👍🏽 ok", "İs ẞ", "A" * 20_000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_bound_is_a_bound_and_best_fit_fits():
    rng = random.Random(6)
    for _ in range(300):
        sizes = np.array([rng.choice((1, 2, 3, 4, 5, 6, 7, 8, 10)) for _ in range(rng.randint(0, 7))], dtype=np.int64)
        bins = P.best_fit_decreasing(sizes, 10)
        assert all(sizes[bins == b].sum() <= 10 for b in set(bins.tolist()))
        best = next(
            (n for n in range(len(sizes) + 1) for c in itertools.product(range(max(n, 1)), repeat=len(sizes))
             if (n or not len(sizes)) and all(sum(s for s, x in zip(sizes, c) if x == b) <= 10 for b in range(n))), 0,
        )
        assert P.lower_bound(sizes, 10) <= best <= len(set(bins.tolist()))
    assert P.lower_bound(np.array([6] * 5), 10) == 5
    assert P.lower_bound(np.array([4] * 5 + [7] * 2), 10) >= 4


def check(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_parts_with_gaps_meet_and_improve(spark):
    # Parts of 40 pieces rarely meet their bounds; pieces of 34 leave much room.
    sizes = [34, 35, 40, 51, 66, 49, 60] * 60
    pieces = spark.createDataFrame([(k, s, "x") for k, s in enumerate(sizes)], "uid long, length long, offset_ string")
    rows = P.pack(pieces, 100, 40).collect()
    assert sorted(r["uid"] for r in rows) == list(range(len(sizes)))
    n = check(rows, 100)
    alone = len(set(P.best_fit_decreasing(np.array(sizes), 100).tolist()))
    assert n <= alone + 6, (n, alone)
    packed = spark.createDataFrame([(r["sequence_id"], r["length"]) for r in rows], "sequence_id long, length long")
    assert P.certificate(packed, 100) == (n, P.lower_bound(np.array(sizes), 100))
    assert P.certificate(packed.limit(0), 100) == (0, 0)


def test_documents_become_pieces(make_docs, edge_texts, tokenizer):
    ids = list(range(len(edge_texts)))
    ids[1] = 0
    rows = P.pack_documents(make_docs(edge_texts, ids)).collect()
    check(rows, 4096)
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    want = []
    for i, t in zip(ids, edge_texts):
        own = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(own), 4096):
            part = own[a : a + 4096]
            want.append((i, a // 4096, a, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    assert got == sorted(want)
    assert P.pack_documents(make_docs([])).collect() == []
