import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pageloom.llm import alignment as A

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(A.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.TOKENIZER_B))


def byte_level():
    """The usual table of the byte-level spelling, built by the published rule."""
    shown = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + n)] = b
            n += 1
    return table


def brute(texts, tokenizers):
    """Per document: numbers, links and digest, then counts, all by loops over tokens."""
    a_tok, b_tok = tokenizers
    table = byte_level()
    special = {t for t in a_tok.get_added_tokens_decoder()}
    documents, counts = [], Counter()
    for text in texts:
        none = (0, 0, 0, [], "")
        if not text:
            documents.append(none)
            continue
        want = (" " + text).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False).ids
        assert not special & set(a)
        b = b_tok.encode(text)
        a_bytes = [bytes(table[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b_tok.id_to_piece, b)]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            documents.append(none)
            continue
        ends = []
        for own in (a_bytes, b_bytes):
            at, found = 0, []
            for x in own:
                at += len(x)
                found.append(at)
            ends.append(found)
        where_b = {e: j for j, e in enumerate(ends[1])}
        links, groups, i0, j0 = [], [], 0, 0
        for i, e in enumerate(ends[0]):
            if e in where_b:
                j = where_b[e]
                links.append((a[i], b[j]))
                groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
                i0, j0 = i + 1, j + 1
        counts.update(links)
        documents.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (n_a, n_b, n_g, len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), digest)
        for n_a, n_b, n_g, links, digest in documents
    ], counts


@pytest.fixture(scope="module")
def texts(words):
    rng = random.Random(8)
    alphabet = "aBc \n\t.,'1é日ßﬁ²▁　🙂\x00<|>ÿ"
    mixed = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    known = ["<|endoftext|> and <s> </s> <unk> <0x41>", "The quick brown fox", "The quick brown fox", "don't  stop", "x" * 5_000, " " * 3_000 + "a", "ﬁne"]
    return mixed + known + [words(rng.randint(1, 400), k) for k in range(60)]


def test_quick_ids_equal_the_tokenizer_s(texts, tokenizers):
    aligner = A.Aligner(A.TOKENIZER_A, A.TOKENIZER_B)
    rng = random.Random(9)
    more = ["".join(chr(rng.choice((rng.randrange(32, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0xE000, 0x1FFFF)))) for _ in range(40)) for _ in range(2_000)]
    for text in texts + more:
        spaced = " " + text
        if not A.LONG_RUN.search(text):
            assert aligner.quick_a.encode_ordinary(spaced) == tokenizers[0].encode(spaced, add_special_tokens=False).ids, repr(text)


def test_identity_map(tokenizers):
    words = A.vocabularies(A.TOKENIZER_A, A.TOKENIZER_B)
    assert len(words.same) == len(words.a) == tokenizers[0].get_vocab_size()
    for a, b in enumerate(words.same.tolist()):
        if b >= 0:
            assert words.a[a] == words.b[b]
            assert not (tokenizers[1].is_control(b) or tokenizers[1].is_unknown(b))
        else:
            assert words.a[a] not in {words.b[k] for k in range(3, 259)} or words.a[a] == b""


@pytest.mark.parametrize("most", [1_000_000, 100, 0])
def test_documents_equal_loops_over_tokens(make_docs, edge_texts, texts, tokenizers, monkeypatch, most):
    monkeypatch.setattr(A, "LOOKUP_PAIRS", most)
    texts = texts + edge_texts
    want, counts = brute(texts, tokenizers)
    documents, same, pairs = A.align_corpus(make_docs(texts).repartition(6))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in documents.collect()}
    assert got == dict(enumerate(want))
    found = {(r["a"], r["b"]): r["n"] for r in same.unionByName(pairs).collect()}
    assert found == counts
    assert sum(n for _, _, n in same.collect()) > 0 and sum(r["n"] for r in pairs.collect()) > 0


def test_repeated_rows_null_ids_and_empty_tables(make_docs):
    documents, _, _ = A.align_corpus(make_docs(["one two", "one two", None, ""], [4, 4, None, None]))
    rows = sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in documents.where("doc_id IS NOT NULL").collect())
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0][6] >= 2 * rows[0][4]
    assert [tuple(r[c] for c in COLUMNS) for r in documents.where("doc_id IS NULL").collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
    documents, same, pairs = A.align_corpus(make_docs([]))
    assert documents.collect() == same.collect() == pairs.collect() == []


def test_least_looked_up(spark):
    pairs = spark.createDataFrame([(k, n) for k, n in enumerate([1] * 50 + [2, 3] * 10 + [9, 900])], "pair int, n long")
    assert A.least_looked_up(pairs, 100) == 1
    assert A.least_looked_up(pairs, 30) == 2
    assert A.least_looked_up(pairs, 5) == 8
    assert A.least_looked_up(pairs, 1) == 512
    assert A.least_looked_up(pairs, 0) > 900
