"""Benchmark decontamination with suffix arrays of the training texts.

The training texts are taken in shards (chunks of a partition). A shard's suffix array holds
the word suffixes that can match at all: those inside runs of benchmark words, which are
few; they are sorted by prefix doubling. Every test suffix is then searched in it by binary
search, word by word: the suffixes that share its window are one stretch of the array, whose
entries are the locations. For those, a binary search among the sorted test suffixes gives
the longest verbatim match.

The benchmark is a stated query set. Its size is measured first; it is sent to the executors
in blocks of at most BLOCK_BYTES, and one more pass is made over the rows for every further
block. Documents never leave their partition: there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, python_ready, staged, table
from .words import _POWERS, Words, chunks, mixed, prefix_hashes, stretch_hashes, words_of

WINDOW = 10
BLOCK_BYTES = 16 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MATCH = "struct<n_words:long,longest:int,runs:array<struct<start:int,end:int>>,items:array<long>>"


@dataclass
class TestSuffixes:
    """The distinct windows of a block of items with the items they stand in, and the sorted
    suffixes of all items. An item is one stretch of `ids`, behind which a 0 stands; a suffix
    is the place where it starts, so memory grows with the items and no faster."""

    words: list[bytes]  # sorted; a word's number is its place, from 1
    ids: np.ndarray
    windows: np.ndarray  # one row each, filled up with 0
    lengths: np.ndarray
    first_text: np.ndarray  # where a window's part of `texts` begins
    texts: np.ndarray
    items: list[list[int]]  # of each text
    sorted: np.ndarray
    ends: np.ndarray  # of the item, for each place

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]], window: int) -> TestSuffixes:
        texts: dict[tuple[bytes, ...], set[int]] = {}
        for item, text in rows:
            own = tuple(_WORD.findall(_lower(text))) if item is not None and text else ()
            if own:
                texts.setdefault(own, set()).add(item)
        words = sorted(set(chain.from_iterable(texts)))
        number = {w: k for k, w in enumerate(words, 1)}
        sizes = np.array([len(own) for own in texts], dtype=np.int64)
        ids = np.fromiter((n for own in texts for n in (*map(number.__getitem__, own), 0)), dtype=np.int64, count=int((sizes + 1).sum()))
        text = np.repeat(np.arange(len(sizes)), sizes + 1)
        ends = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1)
        order = _sorted_suffixes(ids)
        # Windows in the order of their suffixes: equal ones are neighbours. An item of fewer
        # words is one window.
        length = np.minimum(sizes, window)[text]
        start = order[order + length[order] <= ends[order]]
        same = length[start[1:]] == length[start[:-1]]
        for k in range(window):
            a, b = start[1:] + k, start[:-1] + k
            behind = k >= length[start[1:]]
            same &= behind | (ids[np.minimum(a, len(ids) - 1)] == ids[np.minimum(b, len(ids) - 1)])
        group = np.concatenate([[0], np.cumsum(~same)])[: len(start)]
        first = start[np.flatnonzero(np.concatenate([[True], ~same])[: len(start)])]
        windows = np.zeros((len(first), window), dtype=np.int32)
        for k in range(window):
            inside = k < length[first]
            windows[inside, k] = ids[first[inside] + k]
        pairs = np.unique(group * len(sizes) + text[start])
        first_text = np.searchsorted(pairs, np.arange(len(first) + 1) * len(sizes))
        return cls(words, ids, windows, length[first], first_text, pairs % max(len(sizes), 1), [sorted(i) for i in texts.values()], order, ends)

    def items_of(self, window: int) -> set[int]:
        return {i for t in self.texts[self.first_text[window] : self.first_text[window + 1]].tolist() for i in self.items[t]}


def _sorted_suffixes(ids: np.ndarray) -> np.ndarray:
    """Places of `ids` but zeros, in the order of what follows each up to the next zero."""
    rank, step = np.unique(ids, return_inverse=True)[1].reshape(-1).astype(np.int64) if len(ids) else ids, 1
    open_ = ids > 0
    while step < len(ids):
        later = np.zeros(len(rank), dtype=np.int64)
        later[:-step] = np.where(open_[:-step], rank[step:] + 1, 0)
        new = np.unique(rank * (later.max() + 1) + later, return_inverse=True)[1].reshape(-1)
        # Behind a zero nothing counts.
        open_[:-step] &= open_[step:]
        open_[-step:] = False
        rank, step = new, 2 * step
        if not open_.any() or len(rank) == rank.max() + 1:
            break
    order = np.argsort(rank, kind="stable")
    return order[ids[order] > 0]


def _lower(text: str) -> bytes:
    return text.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


class Searcher:
    def __init__(self, tests: TestSuffixes):
        self.tests = tests
        self.lengths, self.padded = tests.lengths, tests.windows
        self.depth = int(self.lengths.max(initial=0))
        self.prefix = _prefix(tests.ids)
        joined = np.frombuffer(b"".join(tests.words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in tests.words], dtype=np.int64)
        hashes = stretch_hashes(prefix_hashes(joined), ends - [len(w) for w in tests.words], ends) if len(ends) else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order + 1
        # Most words fail a look at one bit.
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def numbered(self, words: Words) -> np.ndarray:
        """The benchmark's number of each word, 0 if it has none."""
        out = np.zeros(len(words.starts), dtype=np.int64)
        if len(self.hashes) and len(out):
            h = words.hashes()
            maybe = np.flatnonzero(self.seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == h[maybe]
            out[maybe[same]] = self.numbers[at[same]]
        return out

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Test windows and the words where they start, and the longest match from there."""
        ids = self.numbered(words)
        while True:
            window, place, longest = self._search(words, ids)
            wrong = self._collisions(words, ids, window, place)
            if not len(wrong):
                return window, place, longest
            ids[wrong] = 0

    def _collisions(self, words: Words, ids: np.ndarray, window: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Words in matches that differ from the benchmark word of equal hash."""
        spread = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(spread, place, 1)
        np.add.at(spread, place + self.lengths[window], -1)
        hit = np.flatnonzero(np.cumsum(spread[:-1]) > 0)
        text, known = words.data, self.tests.words
        return np.array(
            [k for k in hit if text[words.starts[k] : words.ends[k]].tobytes() != known[ids[k] - 1]], dtype=np.int64
        )

    def _search(self, words: Words, ids: np.ndarray):
        array = SuffixArray(ids, words.first, int(self.lengths.min(initial=1)), self.depth)
        lo = np.zeros(len(self.lengths), dtype=np.int64)
        hi = np.full(len(self.lengths), len(array.places), dtype=np.int64)
        alive = np.arange(len(lo)) if len(array.places) else np.zeros(0, dtype=np.int64)
        done: list[np.ndarray] = []
        for d in range(self.padded.shape[1]):
            done.append(alive[self.lengths[alive] == d])
            alive = alive[self.lengths[alive] > d]
            if not len(alive):
                break
            lo[alive], hi[alive] = array.narrowed(lo[alive], hi[alive], d, self.padded[alive, d])
            alive = alive[lo[alive] < hi[alive]]
        found = np.sort(np.concatenate([*done, alive]))
        found = found[self.lengths[found] > 0]
        counts = hi[found] - lo[found]
        window = np.repeat(found, counts)
        at = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(window)) if len(found) else window
        if not len(window):
            return window, window, window
        place, which = np.unique(array.places[at], return_inverse=True)
        return window, array.places[at], self._longest(ids, array.end, place)[which.reshape(-1)]

    def _longest(self, ids: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
        """For each place the longest match with any test suffix: that of one of the two test
        suffixes between which its own suffix sorts. Two suffixes are compared by the length
        that they have in common, which binary search finds over prefix hashes."""
        tests, prefix = self.tests, _prefix(ids)
        room = end[place] - place

        def common(which: np.ndarray, start: np.ndarray) -> np.ndarray:
            lo, hi = np.zeros(len(which), dtype=np.int64), np.minimum(room[which], tests.ends[start] - start)
            p = place[which]
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_] + 1) // 2
                equal = _stretch(prefix, p[open_], mid) == _stretch(self.prefix, start[open_], mid)
                lo[open_[equal]] = mid[equal]
                hi[open_[~equal]] = mid[~equal] - 1
            return lo

        lo, hi = np.zeros(len(place), dtype=np.int64), np.full(len(place), len(tests.sorted), dtype=np.int64)
        best = np.zeros(len(place), dtype=np.int64)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            start = tests.sorted[mid]
            n = common(open_, start)
            best[open_] = np.maximum(best[open_], n)
            # Where one of them has ended, 0 stands for its next word.
            own = np.where(n < room[open_], ids[np.minimum(place[open_] + n, len(ids) - 1)], 0)
            less = tests.ids[start + n] < own
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        # The search has met both neighbours of the place it ends at.
        return best


def _prefix(ids: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes; spread numbers, since words are numbered from 1 on."""
    _POWERS.reach(len(ids) + 1)
    out = np.zeros(len(ids) + 1, dtype=np.uint64)
    np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(ids)], out=out[1:])
    return out


def _stretch(prefix: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (prefix[start + n] - prefix[start]) * _POWERS.down[start]


class SuffixArray:
    """Word suffixes in runs of known words of at least `least` words, sorted by their first
    `depth` words; a suffix ends with its run."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, least: int, depth: int):
        self.ids = ids
        known = ids > 0
        stop = np.zeros(len(ids) + 1, dtype=bool)  # words at which a run that began before ends
        stop[:-1] = ~known
        stop[first] = True
        stops = np.flatnonzero(stop)
        self.end = np.zeros(len(ids), dtype=np.int64)
        if len(ids):
            self.end = stops[np.searchsorted(stops, np.arange(len(ids)), side="right")]
        room = self.end - np.arange(len(ids))
        # All places of runs that are long enough anywhere.
        begins = np.flatnonzero(known & (np.concatenate([[True], ~known[:-1]]) | stop[:-1])) if len(ids) else np.zeros(0, np.int64)
        begins = begins[room[begins] >= least]
        sizes = room[begins]
        place = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes) + np.arange(sizes.sum()) if len(begins) else begins
        left = self.end[place] - place if len(place) else place
        rank = ids[place].astype(np.int64) if len(place) else place
        step = 1
        while step < depth and len(place):
            later = np.zeros(len(rank), dtype=np.int64)
            inside = np.flatnonzero(left > step)
            later[inside] = rank[inside + step]
            rank = np.unique(rank * (later.max() + 1) + later, return_inverse=True)[1] + 1
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.places = place[order]

    def word(self, entries: np.ndarray, depth: int) -> np.ndarray:
        """The word at `depth` of the suffixes, 0 where they have ended."""
        place = self.places[entries]
        at = place + depth
        inside = at < self.end[place]
        return np.where(inside, self.ids[np.minimum(at, len(self.ids) - 1)], 0)

    def narrowed(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of the stretches lo..hi whose word at `depth` is `word`."""
        return self._bound(lo, hi, depth, word), self._bound(lo, hi, depth, word + 1)

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less = self.word(mid, depth) < word[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return lo


def _matched(searcher: Searcher, batch: pa.RecordBatch, text_col: str, match_col: str) -> pa.RecordBatch:
    names = batch.schema.names
    old = batch.column(names.index(match_col)).to_pylist() if match_col in names else None
    out: list[dict] = []
    for chunk in chunks(batch.column(names.index(text_col))):
        words = words_of(chunk)
        window, place, longest = searcher.search(words)
        spread = np.zeros(len(words.starts) + 1, dtype=np.int64)
        np.add.at(spread, place, 1)
        np.add.at(spread, place + searcher.lengths[window], -1)
        covered = np.cumsum(spread[:-1]) > 0
        document = np.searchsorted(words.first, place, side="right") - 1
        items: dict[int, set[int]] = {}
        best = np.zeros(chunk.n, dtype=np.int64)
        np.maximum.at(best, document, longest)
        pairs = np.unique(document * max(1, len(searcher.lengths)) + window)
        for p in pairs.tolist():
            doc, w = divmod(p, len(searcher.lengths))
            items.setdefault(doc, set()).update(searcher.tests.items_of(w))
        for k in range(chunk.n):
            was = old[chunk.first + k] if old else None
            if k not in items:
                out.append(was or {"n_words": int(words.first[k + 1] - words.first[k]), "longest": 0, "runs": [], "items": []})
                continue
            hit = covered[words.first[k] : words.first[k + 1]].copy()
            for r in was["runs"] if was else []:
                hit[r["start"] : r["end"]] = True
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            out.append(
                {
                    "n_words": len(hit),
                    "longest": max(int(best[k]), was["longest"] if was else 0),
                    "runs": [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)],
                    "items": sorted(items[k].union(was["items"] if was else ())),
                }
            )
    kind = pa.struct(
        [("n_words", pa.int64()), ("longest", pa.int32()), ("runs", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.int64()))]
    )
    column = pa.array(out, type=kind)
    if old is not None:
        return batch.set_column(names.index(match_col), match_col, column)
    return batch.append_column(match_col, column)


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of about `limit` bytes at most, one at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i IS NOT NULL AND t <> ''")
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-total // limit)
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else items
        yield [(r["i"], r["t"]) for r in rows.distinct().collect()]


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    match_col: str = "benchmark_match",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` with `match_col`: number of words, longest verbatim match in words, runs of hit
    words (end exclusive) and the matching item ids.

    A null or empty text has no words and no match; an item without words or without an id
    matches nothing; items of equal id count once; an empty benchmark matches nothing. Rows,
    also repeated ones, and the other columns of `docs` pass through; `match_col` must be
    free in `docs`.
    """
    if match_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {match_col}")
    spark = docs.sparkSession
    python_ready(spark)
    out = docs
    schema = T.StructType([*docs.schema.fields, T.StructField(match_col, T.DataType.fromDDL(MATCH))])
    blocks = benchmark_blocks(benchmark, item_id, item_text, block_bytes)
    rows = next(blocks, [])
    while rows is not None:
        tests = spark.sparkContext.broadcast(TestSuffixes.of(rows, window))
        out = _pass(out, tests, text_col, match_col, schema)
        rows = next(blocks, None)
        if rows is not None:
            # Written between blocks, so that one block at a time is in memory.
            out = staged(out)
            tests.destroy()
    return out


def _pass(docs: DataFrame, tests, text_col: str, match_col: str, schema: T.StructType) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(tests.value)
        for batch in batches:
            yield _matched(searcher, batch, text_col, match_col)

    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any hit word; columns as in `docs`."""
    match = free_name(docs, "_benchmark_match")
    found = match_benchmark(docs, benchmark, text_col, match, **options)
    return found.where(F.size(f"{match}.runs") == 0).select(*docs.columns)


def op8_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = match_benchmark(docs, table(spark, sf_dir, "benchmark"), match_col="m")
    ids = F.array_join(F.array_sort(F.transform("m.items", lambda i: i.cast("string"))), ",")
    n_hit = F.aggregate("m.runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id",
        F.col("m.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("m.items").cast("long").alias("n_items"),
        F.sha2(F.encode(ids, "utf-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


# Windows as joined words, matched by equality: no suffix arrays, no hashes.
_ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
dw AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT rid, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs)
),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s, len(w) AS total
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
dwin AS (
  SELECT rid, pos, n, s FROM (
    SELECT rid, pos, sizes.n AS n,
      array_to_string(list_slice(words, pos, pos + sizes.n - 1), ' ') AS s, len(words) AS total
    FROM dw JOIN (SELECT rid, list(word ORDER BY pos) AS words FROM dw GROUP BY rid) USING (rid), sizes
  ) WHERE pos + n - 1 <= total
),
hits AS (SELECT rid, pos, n, item_id FROM dwin JOIN windows USING (n, s)),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hits) GROUP BY rid
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN (SELECT rid, count(*) AS n FROM dw GROUP BY rid) USING (rid)
LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)"""

ORACLE = {"op8_benchmark_matches": _ORACLE}
