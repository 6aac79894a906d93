"""Embedding near-duplicates over a robust-pruned flat graph.

Vectors are dealt to overlapping shards: each goes to its CELLS nearest centroids, which are
fitted on a bounded sample. In each shard a flat graph is built: nearest candidates, pruned
so that a kept neighbour is not closer to another kept one (with slack ALPHA), and reversed.
The lists that a vector has in its shards are united. Then each vector is searched for in its
shards: greedy searches with a list of LIST_SIZE, from the shard's medoid and from an entry
into each part of the graph that no edges lead to from there; together with the vector itself
and its neighbours that is where the range expands: everything within reach of a hit, by
edges of the united lists, is looked at until no new hit is found. Parts that the angles
prove to hold no hit are left out. What is found is verified by its cosine in double
precision, and a link that one of two vectors finds counts for both.

Equal vectors are one vector with a weight. A shard of many vectors is dealt in blocks, and
every two blocks meet in a task. A pair that shares several shards counts in one of them, so
tasks return one row per vector, never pairs.

The audit compares all vectors whose id is divisible by AUDIT_EVERY, AUDIT_QUERIES of them at
a time, with all rows by brute force. While less than RECALL of their links was found, the
search is done again with vectors in more shards. Where MOST_CELLS do not suffice, or a vector
is in all shards already, all vectors are compared, block by block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table
from .graph import components

SIMILARITY = 0.95
# The sample that centroids are fitted on, and vectors per centroid.
SAMPLE = 20_000
PER_CELL = 1_000
CELLS = 3
# Vectors of a shard that one task holds at most, in two blocks.
BLOCK = 2_000
DEGREE = 24
CANDIDATES = 64
ALPHA = 1.2
LIST_SIZE = 32
# Edges lead on from vectors this much below the similarity that counts.
REACH = 0.1
AUDIT_EVERY = 100
AUDIT_QUERIES = 2_000
RECALL = 0.98
MOST_CELLS = 24


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: the rows that have a direction, scaled to length 1."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.where(valid(F.col(vector_col))).select(F.col(id_col).alias("id"), v.alias("v"))
    # Scaled by the largest component first, so that no square over- or underflows.
    rows = rows.withColumn("top", F.array_max(F.transform("v", F.abs)))
    rows = rows.select("id", F.transform("v", lambda x: x / F.col("top")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("norm", norm).select("id", F.transform("v", lambda x: x / F.col("norm")).alias("v"))


def centroids_of(units: DataFrame, n: int, seed: int = 7) -> np.ndarray:
    """Centroids from at most SAMPLE vectors, chosen by a hash of their components; three
    rounds of Lloyd's algorithm. Their number follows the table, up to SAMPLE / 8."""
    share = min(1.0, 2 * SAMPLE / max(n, 1))
    picked = units.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    rows = picked.select("v").limit(SAMPLE).collect()
    sample = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), -1)
    k = max(1, min(n // PER_CELL, len(sample) // 8))
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), k, replace=False)] if len(sample) else sample
    for _ in range(3 if k > 1 else 0):
        nearest = np.argmax(sample @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        found = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], found)
    return found


def in_cells(units: DataFrame, centroids: np.ndarray, cells: int) -> DataFrame:
    """`units` with cells: the nearest centroids, sorted by number."""
    sent = units.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(batch.schema.names.index("v")))
            m = min(cells, len(sent.value))
            near = np.argpartition(-(x @ sent.value.T), m - 1, axis=1)[:, :m] if len(x) else np.zeros((0, m))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * m), pa.array(np.sort(near, axis=1).astype(np.int32).reshape(-1)))
            yield batch.append_column("cells", lists)

    return units.mapInArrow(run, T.StructType([*units.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 1))


def deal_shards(rows: DataFrame) -> DataFrame:
    """`rows` (with cells) once per shard: columns cell, a, b (blocks that meet), side."""
    each = rows.withColumn("cell", F.explode("cells"))
    sizes = each.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m"))
    dealt = each.join(F.broadcast(sizes), "cell")  # one row per centroid, SAMPLE / 8 at most
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    # A lone block meets itself; of several, each meets each other one.
    other = F.when(F.col("m") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda o: o != F.col("side")))
    dealt = dealt.withColumn("other", F.explode(other))
    return dealt.withColumn("a", F.least("side", "other")).withColumn("b", F.greatest("side", "other")).drop("m", "other")


def pruned_graph(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each vector: the nearest candidates, robustly pruned, and reverse edges."""
    n = len(x)
    m = min(CANDIDATES, n - 1)
    lists: list[list[int]] = [[] for _ in range(n)]
    if m < 1:
        return [np.zeros(0, dtype=np.int64)] * n
    for first in range(0, n, 512):
        sims = x[first : first + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(first, first + len(sims))] = -2
        near = np.argpartition(-sims, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1), axis=1)
        for k, candidates in enumerate(near):
            lists[first + k] = robust_prune(x, first + k, candidates)
    reverse: list[list[int]] = [[] for _ in range(n)]
    for k, own in enumerate(lists):
        for other in own:
            reverse[other].append(k)
    out = []
    for k in range(n):
        both = np.unique(np.array(lists[k] + reverse[k], dtype=np.int64))
        if len(both) > 2 * DEGREE:
            both = np.array(robust_prune(x, k, both[np.argsort(-(x[both] @ x[k]), kind="stable")], 2 * DEGREE), dtype=np.int64)
        out.append(both)
    return out


def robust_prune(x: np.ndarray, k: int, candidates: np.ndarray, degree: int = DEGREE) -> list[int]:
    """Candidates, nearest first, without those that are ALPHA times closer to a kept one than
    to `k` (by squared distance); the nearest pruned ones fill what is left of the degree."""
    away = 2 - 2 * (x[candidates] @ x[k])
    between = 2 - 2 * (x[candidates] @ x[candidates].T)
    alive = np.ones(len(candidates), dtype=bool)
    kept: list[int] = []
    for c in range(len(candidates)):
        if alive[c]:
            kept.append(c)
            if len(kept) == degree:
                break
            alive &= ALPHA * between[c] > away
            alive[: c + 1] = False
    rest = [c for c in range(len(candidates)) if c not in set(kept)][: max(0, degree // 2 - len(kept))]
    return candidates[kept + rest].tolist()


def greedy(x: np.ndarray, graph: list[np.ndarray], start: int, q: np.ndarray, size: int) -> list[int]:
    """The best `size` vectors that a greedy search from `start` meets."""
    sim = float(x[start] @ q)
    seen = {start}
    todo = [(-sim, start)]
    best = [(sim, start)]
    while todo:
        s, k = heapq.heappop(todo)
        if len(best) == size and -s < best[0][0]:
            break
        fresh = [o for o in graph[k].tolist() if o not in seen]
        if not fresh:
            continue
        seen.update(fresh)
        for o, v in zip(fresh, (x[fresh] @ q).tolist(), strict=True):
            if len(best) < size or v > best[0][0]:
                heapq.heappush(todo, (-v, o))
                (heapq.heappush if len(best) < size else heapq.heapreplace)(best, (v, o))
    return [o for _, o in best]


def entries(x: np.ndarray, graph: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors from which all others are reached: the medoid, then the medoid of what is left,
    and so on; and for each the widest angle to what it is the first to reach."""
    left = np.ones(len(x), dtype=bool)
    starts, angles = [], []
    while left.any():
        rest = np.flatnonzero(left)
        start = int(rest[np.argmax(x[rest] @ x[rest].mean(axis=0))])
        front = np.array([start])
        least = 1.0
        while len(front):
            left[front] = False
            least = min(least, float((x[front] @ x[start]).min()))
            near = np.unique(np.concatenate([graph[k] for k in front.tolist()]))
            front = near[left[near]]
        starts.append(start)
        angles.append(np.arccos(max(least, -1.0)))
    return np.array(starts, dtype=np.int64), np.array(angles)


def range_search(x: np.ndarray, graph: list[np.ndarray], starts: Iterable[int], k: int, similarity: float) -> np.ndarray:
    """Vectors within `similarity` of x[k] that the search reaches."""
    q = x[k]
    seen = np.zeros(len(x), dtype=bool)
    seen[k] = True
    seen[graph[k]] = True
    for start in starts:
        seen[greedy(x, graph, start, q, LIST_SIZE)] = True
    front = np.flatnonzero(seen)
    hits = []
    while len(front):
        sims = x[front] @ q
        hits.append(front[sims >= similarity])
        near = front[sims >= similarity - REACH]
        if not len(near):
            break
        front = np.unique(np.concatenate([graph[k] for k in near.tolist()]))
        front = front[~seen[front]]
        seen[front] = True
    return np.concatenate(hits) if hits else np.zeros(0, dtype=np.int64)


def build_shard(rows: pa.Table) -> pa.Table:
    """rep, neighbours of one shard."""
    rep = rows.column("rep").to_numpy()
    graph = pruned_graph(_matrix(rows.column("v")))
    return pa.table({"rep": rep, "neighbours": pa.array([rep[g] for g in graph], pa.list_(pa.int64()))})


def search_shard(rows: pa.Table, similarity: float) -> pa.Table:
    """rep, root, links of one shard: every vector searched for in the united graph, or
    compared with all others where there are no neighbours."""
    rep, side = rows.column("rep").to_numpy(), rows.column("side").to_numpy()
    order = np.argsort(rep, kind="stable")
    rows, rep, side = rows.take(pa.array(order)), rep[order], side[order]
    x, copies = _matrix(rows.column("v")), rows.column("copies").to_numpy()
    cells = _matrix(rows.column("cells"))
    cell, a, b = (rows.column(c)[0].as_py() for c in ("cell", "a", "b"))
    near = np.zeros((len(rep), len(rep)), dtype=bool)
    if "neighbours" in rows.column_names:
        graph = []
        for own in rows.column("neighbours").combine_chunks():
            ids = own.values.to_numpy() if own.values is not None else np.zeros(0, dtype=np.int64)
            at = np.minimum(np.searchsorted(rep, ids), len(rep) - 1)
            graph.append(at[rep[at] == ids])
        starts, angles = entries(x, graph)
        # Angles are a metric: a part holds no hit if its entry is further away than this.
        farthest = angles + np.arccos(np.clip(similarity, -1, 1)) + 1e-6
        for k in range(len(rep)):
            away = np.arccos(np.clip(x[starts] @ x[k], -1, 1))
            hits = range_search(x, graph, starts[away <= farthest].tolist(), k, similarity)
            near[k, hits] = near[hits, k] = True
    else:
        for k in range(0, len(rep), 512):
            near[k : k + 512] = x[k : k + 512] @ x.T >= similarity
    links, root = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(rep)):
        hits = np.flatnonzero(near[k])
        hits = hits[hits != k]
        # In the first cell that both have; inside a block, where the block meets its first other one.
        both = (cells[hits][:, :, None] == cells[k][None, None, :]).any(axis=2)
        first = np.where(both, cells[hits], np.iinfo(np.int32).max).min(axis=1) if len(hits) else hits
        partner = (a if side[k] == b else b) if a != b else 0
        own_turn = a == b or partner == (0 if side[k] else 1)
        counted = hits[(first == cell) & ((side[hits] != side[k]) | own_turn)]
        links[k] = copies[counted].sum()
        for h in counted.tolist():
            x_, y_ = find(k), find(h)
            if x_ != y_:
                root[max(x_, y_)] = min(x_, y_)
    first = np.array([find(k) for k in range(len(rep))], dtype=np.int64)
    return pa.table({"rep": rep, "root": rep[first] if len(rep) else rep, "links": links})


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = SIMILARITY, cells: int = CELLS
) -> DataFrame:
    """One row per row of `vectors`: id_col, n_links (other rows with a cosine of `similarity`
    or more), component_id (smallest id reachable by links, itself included), kept.

    Vectors that are null or zero or hold null or non-finite components link with nothing.
    Equal directions are linked. Repeated ids are rows of their own, and a component's id is
    the smallest of its rows'. Vectors must have one length; other columns are not read. An
    empty table gives no rows. With more `cells` than there are shards, or than MOST_CELLS,
    all vectors are compared.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    units = staged(unit_vectors(vectors, id_col, vector_col))
    distinct = units.groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    distinct = staged(distinct.withColumn("rep", F.monotonically_increasing_id()))
    n = distinct.count()
    shard = ("cell", "a", "b")
    centroids = centroids_of(distinct, n) if n else np.zeros((0, 1))
    if cells > min(MOST_CELLS, max(CELLS, len(centroids))):
        # One shard, whose blocks all meet.
        graph = distinct.withColumn("cells", F.array(F.lit(0)))
    else:
        placed = staged(in_cells(distinct, centroids, cells)) if n else distinct.withColumn("cells", F.array().cast("array<int>"))
        built = deal_shards(placed.select("rep", "v", "cells")).groupBy(*shard).applyInArrow(build_shard, "rep long, neighbours array<long>")
        # A vector is in a bounded number of shards, or meets in each the blocks of a hot cell.
        united = built.select("rep", F.explode("neighbours").alias("o")).distinct().groupBy("rep").agg(F.collect_list("o").alias("neighbours"))
        graph = staged(placed.join(united, "rep", "left").withColumn("neighbours", F.coalesce("neighbours", F.array().cast("array<long>"))))
    found = staged(
        deal_shards(graph.drop("least"))
        .groupBy(*shard).applyInArrow(lambda t: search_shard(t, similarity), "rep long, root long, links long")
    )
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    linked = linked.join(distinct.select("rep", "least"), "rep")
    heads = linked.groupBy("component").agg(F.min("least").alias("head"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_rep = linked.join(heads, "component").join(links, "rep").select("rep", "head", "links")
    by_vector = distinct.join(by_rep, "rep").select("v", "head", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    by_row = units.join(by_vector, "v").select("id", "head", "n_links")
    # Rows, not ids, are what links: ids may repeat, and equal ids of unlike vectors stay apart.
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("_v"))
    invalid = own.where(~valid(F.col("_v"))).select("id", F.col("id").alias("head"), F.lit(0).cast("long").alias("n_links"))
    out = by_row.unionByName(invalid)
    return out.select(F.col("id").alias(id_col), "n_links", F.col("head").alias("component_id"), F.col("id").eqNullSafe(F.col("head")).alias("kept"))


def valid(v: Column) -> Column:
    """Whether a vector has a direction."""
    x = F.transform(v, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & fine & F.exists(x, lambda c: c != 0), F.lit(False))


def audit_recall(
    vectors: DataFrame, found: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = SIMILARITY
) -> float:
    """The share of the links of the audited vectors that `found` (of `near_vectors`) counts;
    1 where they have none. Ids must be whole numbers; repeated ones are left out."""
    spark = vectors.sparkSession
    python_ready(spark)
    units = unit_vectors(vectors, id_col, vector_col).select(F.col("id").cast("long").alias("id"), "v")
    asked = units.where(F.col("id") % AUDIT_EVERY == 0).groupBy("id").agg(F.count("*").alias("n"), F.first("v").alias("v"))
    asked = staged(asked.where("n = 1").select("id", "v"))
    counted = found.select(F.col(id_col).cast("long").alias("id"), "n_links")
    blocks = -(-asked.count() // AUDIT_QUERIES)
    all_ = right = 0
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        queries = spark.sparkContext.broadcast((np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows])))

        def run(batches: Iterator[pa.RecordBatch], queries=queries) -> Iterator[pa.RecordBatch]:
            ids, q = queries.value
            n = np.zeros(len(ids), dtype=np.int64)
            for batch in batches:
                n += (_matrix(batch.column(1)) @ q.T >= similarity).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n)], names=["id", "n"])

        # A vector links with itself in these counts.
        exact = units.mapInArrow(run, "id long, n long").groupBy("id").agg((F.sum("n") - 1).alias("n"))
        row = exact.join(counted, "id").agg(F.sum("n").alias("all"), F.sum(F.least("n", "n_links")).alias("found")).first()
        all_, right = all_ + (row["all"] or 0), right + (row["found"] or 0)
        queries.unpersist()
    return right / all_ if all_ else 1.0


def audited_near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = SIMILARITY) -> DataFrame:
    """`near_vectors` with as many shards per vector as the audit asks for; beyond MOST_CELLS
    it compares all vectors."""
    cells = CELLS
    while True:
        found = staged(near_vectors(vectors, id_col, vector_col, similarity, cells))
        if cells > MOST_CELLS or audit_recall(vectors, found, id_col, vector_col, similarity) >= RECALL:
            return found
        cells *= 2


def op4_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_near_vectors(table(spark, sf_dir, "embeddings"))
