"""Removal of repeated byte strings: a suffix sort whose comparisons are hash look-ups.

A byte goes if it lies in a string of LENGTH bytes that also starts somewhere else. Sorting
every suffix of the corpus in one place is out of the question, so suffixes meet only where
they can be equal: each window of LENGTH bytes is represented by its anchor, the GRAM bytes
in it with the least hash. Equal windows have equal anchors at equal offsets.

1. Texts are packed into chunks, compressed and written; they are read from there.
2. Each chunk sends its anchors (hash of the anchor, hash of all bytes of the windows that it
   stands for) to buckets of anchor hashes, packed into one row per chunk and bucket. A bucket
   answers which are alone (nothing repeats there), which have a twin with equal windows
   (all of them repeat), and which must be looked at: equal anchors, unequal surroundings.
   A chunk sends an anchor with two surroundings at most; more are looked at in any case. So
   a passage that stands everywhere gives a bucket two entries per chunk, not all its copies.
3. What must be looked at is sent with its surroundings. There the suffixes that begin at the
   windows are sorted: a merge sort over all groups at once, each comparison a binary search
   for the common extension with prefix hashes, then one byte. Neighbours that agree in LENGTH
   bytes are compared byte by byte before they count. Anchors that stand in very many places
   are decided by equal windows in a distributed count instead.
4. The found windows go back to their chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table
from .words import Chunk, Powers, chunks, mixed, prefix_hashes, rolling_hashes, stretch_hashes

LENGTH = 200
GRAM = 96
# Anchors that one bucket holds, on average; bytes of surroundings that one cell holds.
BUCKET_ANCHORS = 400_000
CELL_BYTES = 1 << 19
# An anchor with more surroundings than this is decided by a distributed count.
HOT = 2_000
_POSITION = np.uint64((1 << 28) - 1)
_SECOND = Powers(0xD1342543DE82EF95)

ALONE, TWIN, LOOK, TWIN_SHOWN = 0, 1, 2, 3


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours: blocks of that width, run through from both ends."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).reshape(-1)
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


@dataclass
class Anchors:
    """at: where each anchor stands; first, last: starts of the windows it stands for; own: its
    hash; around: another hash, of the bytes of these windows and its place among them."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    own: np.ndarray
    around: np.ndarray


def anchors_of(chunk: Chunk, length: int, gram: int) -> Anchors:
    data, n = chunk.data, len(chunk.data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return Anchors(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = rolling_hashes(prefix_hashes(data), gram)
    # The leftmost of equal hashes, by the place in the low bits.
    keys = grams & ~_POSITION
    keys |= np.arange(len(grams), dtype=np.uint64) & _POSITION
    least = sliding_minimum(keys, length - gram + 1)
    # Windows that end in the document they begin in.
    inside = np.zeros(len(least) + 1, dtype=np.int8)
    sizes = np.diff(chunk.offsets)
    np.add.at(inside, chunk.offsets[:-1][sizes >= length], 1)
    np.add.at(inside, chunk.offsets[1:][sizes >= length] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    # Places beyond the bits' range are counted from the window's own.
    at = (least[start] & _POSITION).astype(np.int64) - (start & int(_POSITION))
    at = start + np.where(at < 0, at + int(_POSITION) + 1, at)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(start)) - 1 if len(opens) else opens
    at, first, last = at[opens], start[opens], start[closes]
    around = prefix_hashes(data, _SECOND)
    around = mixed(stretch_hashes(around, first, last + length, _SECOND) + (at - first).astype(np.uint64))
    # Least hashes are small ones; mixed again they fill the buckets evenly.
    return Anchors(at, first, last, mixed(grams[at]), around)


@dataclass
class Entries:
    """The distinct anchors of a chunk, by hash, then surroundings. which: the entry of each
    anchor; several: whether it stands there more than once; sent: whether the bucket hears
    of it (two for each hash); shown: an anchor of each entry."""

    own: np.ndarray
    around: np.ndarray
    which: np.ndarray
    several: np.ndarray
    sent: np.ndarray
    shown: np.ndarray

    @classmethod
    def of(cls, a: Anchors) -> Entries:
        order = np.lexsort((a.around, a.own))
        own, around = a.own[order], a.around[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (around[1:] != around[:-1])
        opens = np.flatnonzero(new)
        which = np.empty(len(own), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        several = np.diff(np.append(opens, len(own))) > 1
        own, around = own[opens], around[opens]
        sent = np.ones(len(own), dtype=bool)
        sent[2:] = own[2:] != own[:-2]
        return cls(own, around, which, several, sent, order[opens])


def pack_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """chunk, ids, offsets, data: texts one after another, compressed. Null is empty."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for c in chunks(batch.column(1)):
                ids = batch.column(0).slice(c.first, c.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, c.n], pa.int32()), ids),
                        pa.array([c.offsets.astype(np.int64).tobytes()], pa.binary()),
                        pa.array([packer.compress(c.data.tobytes())], pa.binary()),
                        pa.array([len(c.data)], pa.int64()),
                    ],
                    names=["chunk", "ids", "offsets", "data", "size"],
                )
                number += 1

    long = T.LongType()
    fields = [("chunk", long), ("ids", T.ArrayType(source.schema["id"].dataType)), ("offsets", T.BinaryType()), ("data", T.BinaryType()), ("size", long)]
    return source.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def _unpacked(offsets: bytes, data: bytes) -> Chunk:
    return Chunk(0, np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8), np.frombuffer(offsets, dtype=np.int64))


def _bucket_of(own: np.ndarray, bits: int) -> np.ndarray:
    return (own >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), dtype=np.int64)


def sent_entries(packed: DataFrame, bits: int, length: int, gram: int) -> DataFrame:
    """bucket, chunk, entries: own and around hashes and a flag, in the order of Entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, offsets, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                e = Entries.of(anchors_of(_unpacked(offsets, data), length, gram))
                own, around, several = e.own[e.sent], e.around[e.sent], e.several[e.sent].astype(np.uint8)
                buckets = _bucket_of(own, bits)
                names, begin = np.unique(buckets, return_index=True)
                cuts = np.append(begin, len(own))
                out = [own[a:b].tobytes() + around[a:b].tobytes() + several[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), pa.array([number] * len(out), pa.int64()), pa.array(out, pa.binary())],
                    names=["bucket", "chunk", "entries"],
                )

    return packed.select("chunk", "offsets", "data").mapInArrow(run, "bucket int, chunk long, entries binary")


def answer_bucket(rows: pa.Table) -> pa.Table:
    """chunk, bucket, flags: what becomes of each entry that was sent."""
    parts = rows.column("entries").to_pylist()
    sizes = np.array([len(p) // 17 for p in parts], dtype=np.int64)
    own = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(parts, sizes, strict=True)])
    around = np.concatenate([np.frombuffer(p, np.uint64, n, 8 * n) for p, n in zip(parts, sizes, strict=True)])
    several = np.concatenate([np.frombuffer(p, np.uint8, n, 16 * n) for p, n in zip(parts, sizes, strict=True)])
    chunk = np.repeat(rows.column("chunk").to_numpy(), sizes)
    order = np.lexsort((chunk, around, own))
    o, a = own[order], around[order]
    new_own = np.ones(len(o), dtype=bool)
    new_own[1:] = o[1:] != o[:-1]
    new = new_own.copy()
    new[1:] |= a[1:] != a[:-1]
    entry, group = np.cumsum(new) - 1, np.cumsum(new_own) - 1
    twin = np.bincount(entry, weights=1 + several[order]) > 1
    unlike = np.bincount(group, weights=new) > 1  # more than one kind of surroundings
    flag = np.where(twin[entry], np.where(unlike[group] & new, TWIN_SHOWN, TWIN), np.where(unlike[group], LOOK, ALONE))
    flags = np.empty(len(own), dtype=np.uint8)
    flags[order] = flag
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    out = [flags[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "flags": pa.array(out, pa.binary())})


def _runs(first: np.ndarray, last: np.ndarray) -> bytes:
    """Window starts first..last, touching runs joined."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order]) if len(last) else last
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] > last[:-1] + 1
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(first)) - 1 if len(opens) else opens
    return np.stack([first[opens], last[closes]], axis=1).astype(np.int64).tobytes()


def answered(packed: DataFrame, answers: DataFrame, bits: int, length: int, gram: int) -> DataFrame:
    """Per chunk one row with runs (windows known to repeat), and a row for each anchor to be
    looked at or shown: own, at, first and last relative to around, look, around (bytes)."""
    grouped = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "flags"))).alias("flags"))
    rows = packed.select("chunk", "offsets", "data").join(grouped, "chunk")
    fields = [("chunk", pa.int64()), ("own", pa.int64()), ("start", pa.int64()), ("at", pa.int32()), ("look", pa.bool_()), ("around", pa.binary()), ("runs", pa.binary())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, offsets, data, flags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk = _unpacked(offsets, data)
                a = anchors_of(chunk, length, gram)
                e = Entries.of(a)
                # Entries that were not sent have others beside them.
                own_flags = np.where(e.several, TWIN_SHOWN, LOOK).astype(np.uint8)
                own_flags[e.sent] = np.frombuffer(b"".join(f["flags"] for f in flags), dtype=np.uint8)
                # Where a chunk has more than it sent, what was sent also faces the rest.
                more = np.zeros(len(e.own), dtype=bool)
                more[:-1] = e.own[:-1] == e.own[1:]
                more[1:] |= e.own[:-1] == e.own[1:]
                own_flags[more & (own_flags == TWIN)] = TWIN_SHOWN
                twin = np.isin(own_flags[e.which], (TWIN, TWIN_SHOWN))
                out = [{"chunk": number, "runs": _runs(a.first[twin], a.last[twin])}]
                for k in np.flatnonzero(own_flags >= LOOK).tolist():
                    s = e.shown[k]
                    out.append(
                        {
                            "chunk": number, "own": int(e.own[k].astype(np.int64)), "start": int(a.first[s]), "at": int(a.at[s] - a.first[s]),
                            "look": bool(own_flags[k] == LOOK), "around": chunk.data[a.first[s] : a.last[s] + length].tobytes(),
                        }
                    )
                yield pa.Table.from_pylist(out, schema=schema).combine_chunks().to_batches()[0]

    return rows.select("chunk", "offsets", "data", "flags").mapInArrow(run, "chunk long, own long, start long, at int, look boolean, around binary, runs binary")


class SuffixSorter:
    """Suffixes of `data`, compared in their first `length` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefix = data, length, prefix_hashes(data)

    def equal(self, x: np.ndarray, y: np.ndarray, n) -> np.ndarray:
        return stretch_hashes(self.prefix, x, x + n) == stretch_hashes(self.prefix, y, y + n)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The common prefix of suffixes x and y, `length` at most."""
        low, high = np.zeros(len(x), dtype=np.int64), np.full(len(x), self.length, dtype=np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_] + 1) // 2
            same = self.equal(x[open_], y[open_], mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether x stands before y, and whether both are equal in `length` bytes."""
        same = self.equal(x, y, self.length)
        out = np.zeros(len(x), dtype=bool)
        other = np.flatnonzero(~same)
        n = self.extension(x[other], y[other])
        out[other] = self.data[x[other] + n] < self.data[y[other] + n]
        return out, same

    def sort(self, suffixes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of the suffixes by group, then bytes: a merge sort of all groups at once.
        Each suffix finds its place in the neighbouring run by binary search."""
        order = np.argsort(group, kind="stable")
        keys = group[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(keys)))
        width = 1
        while len(sizes) and width < sizes.max():
            big = np.flatnonzero(sizes > width)
            begin = np.repeat(first[big], sizes[big])
            inside = np.arange(len(begin)) - np.repeat(np.cumsum(sizes[big]) - sizes[big], sizes[big])
            size = np.repeat(sizes[big], sizes[big])
            pair = inside // (2 * width) * (2 * width)
            left = inside - pair < width
            other = np.where(left, pair + width, pair)
            low, high = np.minimum(other, size), np.minimum(other + width, size)
            own = suffixes[order[begin + inside]]
            base = low.copy()
            while len(open_ := np.flatnonzero(low < high)):
                mid = (low[open_] + high[open_]) // 2
                before, same = self.less(suffixes[order[begin[open_] + mid]], own[open_])
                before |= same & ~left[open_]  # equal ones keep their order
                low[open_[before]] = mid[before] + 1
                high[open_[~before]] = mid[~before]
            moved = np.empty(len(begin), dtype=np.int64)
            moved[:] = begin + pair + (inside - pair - np.where(left, 0, width)) + (low - base)
            fresh = order.copy()
            fresh[moved] = order[begin + inside]
            order = fresh
            width *= 2
        return order


def repeated_windows(data: np.ndarray, windows: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows (starts in `data`) equal another one of their group."""
    out = np.zeros(len(windows), dtype=bool)
    order = SuffixSorter(data, length).sort(windows, group)
    x, y = windows[order[:-1]], windows[order[1:]]
    near = np.flatnonzero(group[order[:-1]] == group[order[1:]])
    for first in range(0, len(near), 8192):
        k = near[first : first + 8192]
        # Verified byte by byte; what only shares its hash does not count.
        step = np.arange(length)
        same = (data[x[k][:, None] + step] == data[y[k][:, None] + step]).all(axis=1)
        out[order[k[same]]] = out[order[k[same] + 1]] = True
    return out


def look_at(rows: pa.Table, length: int) -> pa.Table:
    """chunk, runs for a cell of anchors with their surroundings."""
    around = rows.column("around").combine_chunks()
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in (p.as_buffer() for p in around)])]).astype(np.int64)
    data = np.frombuffer(b"".join(p.as_py() for p in around), dtype=np.uint8)
    at, start = rows.column("at").to_numpy().astype(np.int64), rows.column("start").to_numpy()
    sizes = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Equal windows have their anchor at the same place.
    _, own = np.unique(rows.column("own").to_numpy(), return_inverse=True)
    group = own[owner] * length + (at[owner] - inside)
    found = repeated_windows(data, offsets[owner] + inside, group, length)
    look = rows.column("look").to_numpy(zero_copy_only=False)
    found &= look[owner]
    chunk = rows.column("chunk").to_numpy()
    k = np.flatnonzero(found)
    out = []
    numbers = np.unique(chunk[owner[k]])
    for number in numbers.tolist():
        own_k = k[chunk[owner[k]] == number]
        place = start[owner[own_k]] + inside[own_k]
        out.append(_runs(place, place))
    return pa.table({"chunk": pa.array(numbers, pa.int64()), "runs": pa.array(out, pa.binary())})


def look_at_hot(hot: DataFrame, length: int) -> DataFrame:
    """chunk, runs for anchors that stand in very many places: equal windows are counted by
    two hashes, summed before the shuffle, and no task holds a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, start, look, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(around, dtype=np.uint8)
                place = np.arange(len(data) - length + 1)
                hashes = [stretch_hashes(prefix_hashes(data, p), place, place + length, p).view(np.int64) for p in (None, _SECOND)]
                columns = [*hashes, np.full(len(place), number), place + start, np.full(len(place), look)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "i", "chunk", "place", "look"])

    windows = hot.select("chunk", "start", "look", "around").mapInArrow(run, "h long, i long, chunk long, place long, look boolean")
    many = windows.groupBy("h", "i").agg(F.count("*").alias("n")).where("n > 1").select("h", "i")
    found = windows.where("look").join(many, ["h", "i"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).to_numpy()
            pairs = [np.array([p, p], dtype=np.int64).tobytes() for p in place]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pairs, pa.binary())], names=["chunk", "runs"])

    return found.select("chunk", "place").mapInArrow(joined, "chunk long, runs binary")


def cut_chunks(packed: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """id, n_bytes, spans (removed bytes of the document, end exclusive), kept."""
    grouped = runs.groupBy("chunk").agg(F.collect_list("runs").alias("runs"))
    rows = packed.select("chunk", "ids", "offsets", "data").join(grouped, "chunk", "left").select("ids", "offsets", "data", "runs")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = _unpacked(batch.column(1)[k].as_py(), batch.column(2)[k].as_py())
                found = np.frombuffer(b"".join(batch.column(3)[k].as_py() or []), dtype=np.int64).reshape(-1, 2)
                depth = np.zeros(len(chunk.data) + 1, dtype=np.int64)
                np.add.at(depth, found[:, 0], 1)
                np.add.at(depth, found[:, 1] + length, -1)
                gone = np.cumsum(depth[:-1]) > 0
                spans, kept = [], []
                for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True):
                    own = gone[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                    spans.append([{"start": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                    kept.append(chunk.data[a:b][~own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[k].values, pa.array(np.diff(chunk.offsets)), pa.array(spans, span), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "spans", "kept"],
                )

    fields = [T.StructField("id", packed.schema["ids"].dataType.elementType), *T.DataType.fromDDL("n_bytes long, spans array<struct<start:long,end:long>>, kept binary").fields]
    return rows.mapInArrow(run, T.StructType(fields))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """One row per row of `docs`: id_col, n_bytes, spans (maximal removed runs of bytes), kept
    (the bytes that stay, which may begin or end inside a character).

    A byte is removed if a string of `length` bytes that covers it also starts elsewhere, in
    the same document or another, judged on the input; matches never cross documents. Null and
    short texts lose nothing; of repeated rows all copies lose what they share. Other columns
    are not read; an empty table gives no rows.
    """
    python_ready(docs.sparkSession)
    packed = staged(pack_chunks(docs, id_col, text_col))
    total = packed.agg(F.sum("size")).first()[0] or 0
    # About two anchors for as many places as a window has room for one.
    bits = max(0, int(2 * total / (length - gram + 1) / BUCKET_ANCHORS)).bit_length()
    answers = sent_entries(packed, bits, length, gram).groupBy("bucket").applyInArrow(answer_bucket, "chunk long, bucket int, flags binary")
    found = staged(answered(packed, answers, bits, length, gram))
    places = found.where("own IS NOT NULL")
    hot_anchors = staged(places.groupBy("own").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("own"))
    size = places.agg(F.sum(F.octet_length("around"))).first()[0] or 0
    cells = max(1, -(-size // CELL_BYTES))
    cell = F.pmod(F.xxhash64("own"), F.lit(cells))
    cold = places
    runs = found.where("runs IS NOT NULL").select("chunk", "runs")
    if not hot_anchors.isEmpty():
        cold = places.join(hot_anchors, "own", "left_anti")
        runs = runs.unionByName(look_at_hot(places.join(hot_anchors, "own", "left_semi"), length))
    looked = cold.select("chunk", "own", "start", "at", "look", "around", cell.alias("cell")).groupBy("cell").applyInArrow(
        lambda t: look_at(t, length), "chunk long, runs binary"
    )
    out = cut_chunks(packed, runs.unionByName(looked), length)
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def op2_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
