"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Documents with the same set of word n-grams form a class and are represented once. The
numbers of bands and rows follow from the similarity and the recall asked for. Band hashes
are shuffled as narrow rows; members of one bucket are linked to its smallest member only,
so a bucket of any size gives as many links as members. The connected buckets of these links
(candidate groups) are where similar sets can be.

Within a group every pair is compared on the full sets. A group of many members is dealt in
blocks, and a task gets two blocks, so that no task holds more than two; what it returns is
one row per member: how many sets it links to, weighted by their copies, and the smallest
member it reaches. Pairs are never written. The rows of all tasks are summed, and their
components are the classes of near-duplicates.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, python_ready, staged, table, text_key
from .graph import components
from .words import Chunk, Words, chunks, mixed, words_of

NGRAM = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.9999
ROWS = 5
# What one block holds at most: members, and n-grams of all of them.
BLOCK_MEMBERS = 1024
BLOCK_GRAMS = 1 << 19
# n-grams in fewer members than this are paired one by one, others by a matrix product.
FREQUENT = 16
PAIRS = 1 << 20


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of `rows` rows that find a pair of this similarity with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams and where those of each document begin; a document of fewer than
    n words, but not none, has one n-gram of all its words."""
    h = words.hashes()
    count = np.diff(words.first)
    grams = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(grams)]).astype(np.int64)
    document = np.repeat(np.arange(len(count)), grams)
    at = words.first[document] + np.arange(first[-1]) - first[document]
    end = words.first[document + 1] if len(document) else at
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        inside = at + k < end
        out = mixed(out + np.uint64(k + 1))
        out[inside] += h[at[inside] + k]
    return mixed(out), first


def gram_sets(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each document, sorted, and where they begin."""
    h, first = gram_hashes(words_of(chunk), n)
    document = np.repeat(np.arange(chunk.n), np.diff(first))
    order = np.lexsort((h, document))
    h, document = h[order], document[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (document[1:] != document[:-1])
    return h[new], np.searchsorted(document[new], np.arange(chunk.n + 1))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def band_hashes(h: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row per document that has n-grams: a 64-bit hash per band, the band within it."""
    factors, shifts = _permutations(bands * rows)
    begins = first[:-1][np.diff(first) > 0]
    out = np.zeros((len(begins), bands), dtype=np.uint64)
    if len(begins):
        for k in range(bands * rows):
            least = np.minimum.reduceat((h ^ shifts[k]) * factors[k], begins)
            out[:, k // rows] = mixed(out[:, k // rows] + least + np.uint64(k + 1))
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """id, key (digest of the text), grams (digest of the set, null without words), size (of
    the set), bands."""
    python_ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                h, first = gram_sets(chunk, n)
                sizes = np.diff(first)
                hashes = band_hashes(h, first, bands, rows).view(np.int64)
                own = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                digests = [hashlib.blake2b(x, digest_size=16).hexdigest() if x else None for x in own]
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                part = batch.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(digests, pa.string()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.reshape(-1))),
                    ],
                    names=["id", "key", "grams", "size", "bands"],
                )

    schema = T.StructType([source.schema["id"], source.schema["key"], *T.DataType.fromDDL("grams string, size long, bands array<long>").fields])
    return source.mapInArrow(run, schema)


def candidate_groups(sets: DataFrame) -> DataFrame:
    """rep, component: sets that share a bucket with another one, by connected buckets."""
    rows = sets.select("rep", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("rep").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = rows.join(buckets, "bucket").where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    return components(edges.distinct())


def deal_blocks(members: DataFrame, group: str, weight: str, item: str) -> DataFrame:
    """`members` dealt to tasks: columns cell (a task's key), a and b (its blocks), side (of
    the member). Small groups have one block and share cells; of a group of m blocks, every
    pair of blocks meets in a cell of its own, and a member goes to m of them."""
    sums = members.groupBy(group).agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    blocks = F.greatest(F.ceil(F.col("_n") / BLOCK_MEMBERS), F.ceil(F.col("_w") / BLOCK_GRAMS), F.lit(1)).cast("int")
    sums = sums.select(group, blocks.alias("_m"))
    total = members.agg(F.sum(weight)).first()[0] or 0
    cells = max(1, -(-total // BLOCK_GRAMS))
    dealt = members.join(sums, group).withColumn("side", F.pmod(F.xxhash64(item), F.col("_m")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    a, b = F.least("side", "_other"), F.greatest("side", "_other")
    shared = F.pmod(F.xxhash64(group), F.lit(cells))
    own = -1 - F.abs(F.xxhash64(group, a, b) % F.lit(1 << 62))
    return dealt.select(*members.columns, F.when(F.col("_m") == 1, shared).otherwise(own).alias("cell"), a.alias("a"), b.alias("b"), "side")


def intersections(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another."""
    out = np.zeros((len(sets_a), len(sets_b)), dtype=np.int64)
    both = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (sets_a, sets_b)]
    common = np.intersect1d(*(np.unique(h) for h, _ in both), assume_unique=True)
    if not len(common):
        return out
    lists = []
    for h, owner in both:
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        held = common[at] == h
        gram, owner = at[held], owner[held]
        order = np.argsort(gram, kind="stable")
        lists.append((gram[order], owner[order], np.bincount(gram, minlength=len(common))))
    (gram_a, owner_a, n_a), (gram_b, owner_b, n_b) = lists
    many = n_a * n_b > FREQUENT * FREQUENT
    # A column for each frequent n-gram, some hundred at a time.
    columns = np.flatnonzero(many)
    for first in range(0, len(columns), 512):
        own = columns[first : first + 512]
        wide = []
        for gram, owner, sets in ((gram_a, owner_a, sets_a), (gram_b, owner_b, sets_b)):
            lo, hi = np.searchsorted(gram, own[0]), np.searchsorted(gram, own[-1], side="right")
            held = many[gram[lo:hi]]
            block = np.zeros((len(sets), len(own)), dtype=np.float32)
            block[owner[lo:hi][held], np.searchsorted(own, gram[lo:hi][held])] = 1
            wide.append(block)
        out += (wide[0] @ wide[1].T).astype(np.int64)
    # The others: each holder on one side with each holder on the other.
    rare = ~many[gram_a]
    gram, owner = gram_a[rare], owner_a[rare]
    begin = np.concatenate([[0], np.cumsum(n_b)[:-1]])
    ends = np.cumsum(n_b[gram])
    first = 0
    while first < len(gram):
        # So many holders at a time that their pairs stay below PAIRS.
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        g, o = gram[first:last], owner[first:last]
        times = n_b[g]
        shift = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = owner_b[np.repeat(begin[g], times) + shift]
        out += np.bincount(np.repeat(o, times) * len(sets_b) + other, minlength=out.size).reshape(out.shape)
        first = last
    return out


def reached(links: np.ndarray) -> np.ndarray:
    """The first member of each one's component in a symmetric matrix of links."""
    label = np.arange(len(links))
    while True:
        new = label.copy()
        for k in range(len(links)):
            near = np.flatnonzero(links[k])
            if len(near):
                new[k] = min(new[k], int(label[near].min()))
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def compare_cell(rows: pa.Table, similarity: Fraction) -> pa.Table:
    """rep, root, links for the members of a cell; columns rep, copies, set, component, a, b, side."""
    columns = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "copies", "component", "a", "b", "side")}
    sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("set").to_pylist()]
    order = np.lexsort((columns["rep"], columns["b"], columns["a"], columns["component"]))
    group = np.stack([columns[c][order] for c in ("component", "a", "b")], axis=1)
    edges = np.flatnonzero(np.any(group[1:] != group[:-1], axis=1)) + 1 if len(group) else np.zeros(0, dtype=np.int64)
    rep, root, found = [], [], []
    for own in np.split(order, edges):
        if not len(own):
            continue
        # The same row may come twice from repeated rows of the table.
        own = own[np.unique(columns["rep"][own], return_index=True)[1]]
        a, b = int(columns["a"][own[0]]), int(columns["b"][own[0]])
        left = own[columns["side"][own] == a]
        right = own[columns["side"][own] == b]
        sizes_l, sizes_r = (np.array([len(sets[k]) for k in side], dtype=np.int64) for side in (left, right))
        shared = intersections([sets[k] for k in left], [sets[k] for k in right]) if len(left) and len(right) else np.zeros((len(left), len(right)), dtype=np.int64)
        p, q = similarity.numerator, similarity.denominator
        linked = (p + q) * shared >= p * (sizes_l[:, None] + sizes_r[None, :])
        if a == b:
            np.fill_diagonal(linked, False)
            whole, members = linked, left
            links = linked @ columns["copies"][left]
        else:
            n, m = linked.shape
            whole = np.zeros((n + m, n + m), dtype=bool)
            whole[:n, n:], whole[n:, :n] = linked, linked.T
            members = np.concatenate([left, right])
            links = np.concatenate([linked @ columns["copies"][right], linked.T @ columns["copies"][left]])
        ids = columns["rep"][members]
        by_id = np.argsort(ids)
        first = reached(whole[np.ix_(by_id, by_id)])
        rep.append(ids[by_id])
        root.append(ids[by_id][first])
        found.append(links[by_id])
    kind = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (rep, root, found)]
    return pa.table(dict(zip(("rep", "root", "links"), map(pa.array, kind), strict=True)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
    similarity: Fraction = SIMILARITY, recall: float = RECALL, rows: int = ROWS,
) -> DataFrame:
    """One row per row of `docs`: id, key (digest of its text), class_id (smallest id of its
    class), class_key (digest of the text of the row that stands for the class: smallest id,
    then smallest digest), n_links (other rows whose set of word n-grams has a Jaccard
    similarity of `similarity` or more with this one's; copies count).

    Null and empty texts and texts without words link with nothing and are a class of their
    own. Texts of fewer than n words have one n-gram. Null ids sort first. Repeated rows are
    copies. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    signed = staged(signatures(docs, id_col, text_col, n, bands_for(float(similarity), recall, rows), rows))
    sets = staged(
        signed.where("grams IS NOT NULL").groupBy("grams")
        .agg(
            F.count("*").alias("copies"), F.max("size").alias("size"), F.first("bands").alias("bands"),
            F.min(F.struct("id", "key")).alias("least"),
        )
        .withColumn("rep", F.monotonically_increasing_id())
    )
    groups = candidate_groups(sets)
    members = staged(sets.select("rep", "copies", "size", "least").join(groups.withColumnRenamed("node", "rep"), "rep"))
    # The full sets of the members, from the text of the row that stands for each.
    wanted = members.select("rep", "copies", "component", "size", F.col("least.id").alias("id"), F.col("least.key").alias("key"))
    source = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))
    texts = source.join(wanted, (F.col("_key") == F.col("key")) & F.col("_id").eqNullSafe(F.col("id")))
    texts = texts.select("rep", "copies", "component", "size", F.col("_text").alias("text"))
    dealt = deal_blocks(staged(full_sets(texts, n)), "component", "size", "rep")
    compared = staged(
        dealt.select("rep", "copies", "set", "component", "a", "b", "side", "cell")
        .groupBy("cell").applyInArrow(lambda t: compare_cell(t, similarity), "rep long, root long, links long")
    )
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(compared.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    own = members.select("rep", "least").join(classes.withColumnRenamed("node", "rep"), "rep")
    heads = own.groupBy("component").agg(F.min("least").alias("head"))
    decided = own.join(heads, "component").join(links, "rep").select("rep", "head", "links")
    by_set = sets.select("grams", "copies", "rep", "least").join(decided, "rep", "left")
    by_set = by_set.select("grams", F.coalesce("head", "least").alias("head"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("id", "key", "grams").join(by_set, "grams", "left")
    head = F.coalesce("head", F.struct("id", "key"))
    return out.select(
        F.col("id").alias(id_col), "key", head["id"].alias("class_id"), head["key"].alias("class_key"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def full_sets(texts: DataFrame, n: int) -> DataFrame:
    """`texts` with the column text replaced by set: the n-gram hashes, sorted, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for chunk in chunks(batch.column(names.index("text"))):
                h, first = gram_sets(chunk, n)
                part = batch.slice(chunk.first, chunk.n)
                own = pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
                yield part.set_column(names.index("text"), "set", own)

    fields = [T.StructField("set", T.BinaryType()) if f.name == "text" else f for f in texts.schema.fields]
    return texts.mapInArrow(run, T.StructType(fields))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row of each class that stands for it (smallest id, then smallest text digest); one
    of several equal rows. Columns as in `docs`."""
    found = near_duplicates(docs, id_col, text_col, **options)
    heads = found.where(F.col(id_col).eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key")))
    key, head_key, head_id, n = (free_name(docs, x) for x in ("_key", "_head_key", "_head_id", "_n"))
    heads = staged(heads.groupBy(F.col(id_col).alias(head_id), F.col("key").alias(head_key)).agg(F.count("*").alias(n)))
    keyed = docs.withColumn(key, text_key(F.col(text_col)))
    kept = keyed.join(heads, (F.col(key) == F.col(head_key)) & F.col(id_col).eqNullSafe(F.col(head_id)))
    repeated = kept.where(F.col(n) > 1)
    if not heads.where(F.col(n) > 1).isEmpty():  # equal rows, of which one stays
        kept = kept.where(F.col(n) == 1).unionByName(repeated.dropDuplicates([key, id_col]))
    return kept.select(*docs.columns)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", (F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


# Sets of joined words, all pairs that share an n-gram, and closure.
ORACLE = {
    "op5_jaccard_join": r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT rid, count(*) AS n FROM grams GROUP BY rid),
pairs AS (
  SELECT x.rid AS a, y.rid AS b FROM grams x JOIN grams y ON x.g = y.g AND x.rid <> y.rid
  JOIN sizes s ON s.rid = x.rid JOIN sizes t ON t.rid = y.rid
  GROUP BY x.rid, y.rid, s.n, t.n HAVING 9 * count(*) >= 4 * (s.n + t.n)
),
reach AS (SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a AS rid, min(doc_id) AS class_id FROM reach JOIN docs ON docs.rid = reach.b GROUP BY a),
links AS (SELECT a AS rid, count(*) AS n_links FROM pairs GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(class_id, doc_id)) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links,
  doc_id = least(doc_id, coalesce(class_id, doc_id)) AS kept
FROM docs LEFT JOIN least USING (rid) LEFT JOIN links USING (rid)"""
}
