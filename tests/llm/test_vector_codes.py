import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from pageloom.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, Id string, v int, error double"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Plain integers, no matrix products. Rows of equal length with ids."""
    kept = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    seeds = sorted({i for i, _, _ in kept})[:entries]
    first = [min(v for i, _, v in kept if i == s) for s in seeds]
    books = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for x in cut:
                members[assign(p, x[p])[1]].append(x[p])
            for e, own in members.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = [[assign(p, x[p]) for p in range(parts)] for x in cut]
    errors = [sum(d for d, _ in own) for own in final]
    by_label = defaultdict(int)
    for (_, label, _), error in zip(kept, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(
        (i, "".join(f"{e:02x}" for _, e in own), error, by_label[label], digest)
        for (i, label, _), own, error in zip(kept, final, errors)
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "d", 1, 2.0) for i, v, label in rows], SCHEMA)


def got(df):
    return sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    found = [(3 * k + 7, [rng.gauss(0, 1) for _ in range(32)], rng.choice([0, 1, 2, None])) for k in range(300)]
    # Ties and copies, extreme and unusable components, a repeated id.
    found += [(5_000 + k, found[k][1], 9) for k in range(20)] + [found[0], found[0]]
    found += [(1, [0.0] * 32, 3), (2, [0.0] * 32, 3), (4, [-70_000.5] * 32, None), (6_000, [90_000.25] * 32, 1)]
    found += [(0, None, 1), (5, [float("nan")] + [0.0] * 31, 1), (6, [None] + [0.0] * 31, 2), (8, [float("-inf")] + [1.0] * 31, 2)]
    return found


def test_codes_equal_plain_integers(spark, rows):
    assert got(V.vector_codes(frame(spark, rows).repartition(7))) == brute(rows)


def test_fewer_ids_than_entries_and_small_parts(spark, rows):
    few = rows[:10]
    assert got(V.vector_codes(frame(spark, few))) == brute(few)
    assert got(V.vector_codes(frame(spark, rows), parts=8, entries=200, rounds=1)) == brute(rows, 8, 200, 1)


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for width in (1, 3, 4, 96):
        top = V.largest_integer(width)
        for size in (9, 1 << 20, top):
            x = rng.integers(-size, size, (2, 40, width), endpoint=True)
            y = rng.integers(-size, size, (2, width, 9), endpoint=True)
            x[0, 0], y[0, :, 0] = -size, size
            want = x.astype(object) @ y.astype(object)
            assert (V.exact_products(x, y).astype(object) == want).all()
            for part in V.limbs(x, V.limb_bits(width)):
                assert width * np.abs(part).max() * (1 << V.limb_bits(width)) < 1 << 53
            # Plain float64 is not enough there.
            if size == top and width == 96:
                assert ((x.astype(float) @ y.astype(float)).astype(np.int64).astype(object) != want).any()


def test_limbs_give_the_number_back():
    x = np.array([0, 1, -1, 2**40 + 5, -(2**40) - 5, -(2**24), 2**24])
    for bits in (3, 24, 26):
        assert (sum(p.astype(np.int64) << (bits * k) for k, p in enumerate(V.limbs(x, bits))) == x).all()


def test_other_lengths_null_ids_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.5], 1), (None, [1.0, 2.5, 3.0], None), (3, [], None), (1, [1.0, 2.0, 3.0], 1)]
    out = V.vector_codes(frame(spark, rows)).collect()
    assert len(out) == 5
    found = defaultdict(list)
    for r in out:
        found[r["vec_id"]].append((r["code"], r["error"], r["label_error"]))
    assert found[2] == found[3] == [(None, None, None)]
    # The one entry is the mean of all three: floor((512 + 512 + 640) / 3) = 554.
    assert found[1] == [("00" * 16, 42 * 42, 2 * 42 * 42)] * 2
    assert found[None] == [("00" * 16, 86 * 86, 86 * 86)]
    assert V.vector_codes(frame(spark, [])).collect() == []
    assert V.vector_codes(frame(spark, [(1, None, 2)])).collect() == []
    assert [r["code"] for r in V.vector_codes(frame(spark, [(None, [1.0], 2)])).collect()] == [None]
    empty = V.vector_codes(frame(spark, [(1, [], 2), (2, [], 2)])).collect()
    assert [(r["code"], r["error"]) for r in empty] == [("00" * 16, 0)] * 2


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        V.vector_codes(frame(spark, [(1, [1e30] * 16, 1)])).collect()


def test_many_labels_take_the_other_join(spark, rows, monkeypatch):
    want = brute(rows)
    monkeypatch.setattr(V, "BROADCAST_LABELS", 2)
    monkeypatch.setattr(V, "HOT_SHARE", 5)
    assert got(V.vector_codes(frame(spark, rows))) == want
