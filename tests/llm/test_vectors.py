import numpy as np
import pytest

from pageloom.llm import vectors as V


def brute(rows, similarity=0.95):
    fine = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            x = x / np.abs(x).max()
            fine[k] = x / np.linalg.norm(x)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(rows)
    keys = list(fine)
    for i in keys:
        for j in keys:
            if i < j and fine[i] @ fine[j] >= similarity:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((rows[k][0], links[k], least[find(k)]) for k in range(len(rows)))


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(4)
    rows = []
    for family in range(60):
        base = rng.normal(size=16)
        base /= np.linalg.norm(base)
        for _ in range(1 if family % 3 else 12):
            rows.append([float(x) for x in base + rng.normal(size=16) * 0.02])
    rows += [rows[0], [2 * x for x in rows[0]], [1e-300 * x for x in rows[5]], [0.0] * 16, None, [None] + [1.0] * 15]
    rows += [[float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, None]
    return [(k * 3, v) for k, v in enumerate(rows)]


@pytest.mark.parametrize(("block", "per_cell"), [(2000, 1000), (40, 1000), (2000, 40)])
def test_links_and_components_equal_brute_force(spark, case, block, per_cell, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "PER_CELL", per_cell)
    table = spark.createDataFrame([(i, v, 1, "c") for i, v in case], "vec_id long, embedding array<double>, rep int, cells string")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in V.near_vectors(table).collect())
    want = brute(case)
    assert [g[0] for g in got] == [w[0] for w in want]
    found, all_ = sum(g[1] for g in got), sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and found >= 0.98 * all_
    if found == all_:
        assert got == want


def test_empty_and_invalid_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.near_vectors(empty).collect() == []
    rows = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, V.near_vectors(rows).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_recall_on_a_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = sorted(map(tuple, V.near_vectors(table).select("vec_id", "n_links", "component_id").collect()))
    assert got == want


def test_audit_sees_what_is_missing_and_asks_for_more(spark, case, monkeypatch):
    rows = [(i * 100, v) for i, v in case]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = V.near_vectors(table)
    assert V.audit_recall(table, found) > 0.98
    none = found.withColumn("n_links", found["n_links"] * 0)
    assert V.audit_recall(table, none) == 0.0
    tried = []

    def poor(vectors, id_col, vector_col, similarity, cells):
        tried.append(cells)
        return found if cells > 3 else none

    monkeypatch.setattr(V, "near_vectors", poor)
    assert sorted(map(tuple, V.audited_near_vectors(table).collect())) == sorted(map(tuple, found.collect())) and tried == [3, 6]


def families(n, size, dims=64, noise=0.02):
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(n):
        base = rng.normal(size=dims)
        base /= np.linalg.norm(base)
        rows += [[float(x) for x in base + rng.normal(size=dims) * noise] for _ in range(size)]
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [2000, 300])
def test_large_families_of_near_copies_in_one_shard(spark, block, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", block)
    rows = families(8, 125)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in V.near_vectors(table).collect())
    assert got == brute(rows)


def test_more_cells_than_shards_compare_all(spark, case, monkeypatch):
    def no_graph(*_):
        raise AssertionError

    monkeypatch.setattr(V, "BLOCK", 40)
    monkeypatch.setattr(V, "in_cells", no_graph)
    table = spark.createDataFrame(case, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in V.near_vectors(table, cells=2 * V.CELLS).collect())
    assert got == brute(case)


def test_audit_reads_every_vector_it_names(spark, case, monkeypatch):
    table = spark.createDataFrame([(i * 100, v) for i, v in case], "vec_id long, embedding array<double>")
    found = V.near_vectors(table)
    poor = found.withColumn("n_links", found["n_links"] * (found["vec_id"] % 200 == 0).cast("int"))
    whole = V.audit_recall(table, poor)
    assert 0 < whole < 1
    monkeypatch.setattr(V, "AUDIT_QUERIES", 50)
    assert V.audit_recall(table, poor) == whole
