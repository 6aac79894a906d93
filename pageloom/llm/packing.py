"""Best-fit packing of token sequences, certified by lower bounds.

Pieces are dealt at random to partitions of bounded size. Each is packed by best-fit
decreasing, and a lower bound from dual feasible functions says how many sequences it needs
at least; the same bound over the lengths of all pieces says it for the whole table. If the
partitions together meet that, nothing can be packed better. Otherwise there is a gap, even
where each partition is as good as it can be alone, and the partitions give up their least
filled sequences; those of several partitions meet, are packed again and bounded again, round
by round, until the bound is met or one partition has met all. A partition that would need
more sequences than it was given keeps what it was given.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table
from .tokenizing import WordTokenizer

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Pieces that one task packs; a fixed bound on its memory.
PART_PIECES = 50_000
# Least filled sequences that a partition gives up, with a gap and without, and partitions
# that meet.
LOOSE_BINS = 512
CERTIFIED_BINS = 64
MEETING = 8
# Eight to the power of it are more partitions than any table has.
ROUNDS = 12


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that pieces of these lengths need at least."""
    return bound_of_counts(*np.unique(lengths[lengths > 0].astype(np.int64), return_counts=True), capacity)


def bound_of_counts(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The same for `counts` pieces of each of the `sizes`, ascending: the best of the sums
    under dual feasible functions, the total among them."""
    if not len(sizes):
        return 0
    total = np.concatenate([[0], np.cumsum(sizes * counts)])
    number = np.concatenate([[0], np.cumsum(counts)])
    best = -(-int(total[-1]) // capacity)
    # Pieces below e count nothing, those above capacity - e count as whole sequences.
    e = np.unique(np.concatenate([[1], sizes[sizes <= capacity // 2]]))
    small, large = np.searchsorted(sizes, e), np.searchsorted(sizes, capacity - e, side="right")
    whole = number[-1] - number[large]
    best = max(best, int(np.max(whole - (-(total[large] - total[small]) // capacity))))
    # x -> floor((k + 1) x) / k, x itself where (k + 1) x is whole; in units of 1 / (k * capacity).
    for k in range(1, 101):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece. Among open sequences with room the fullest is taken; a bit
    mask over the room that sequences have left finds it."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n = 0, 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = mask >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            b = open_bins[room].pop()
            if not open_bins[room]:
                mask ^= 1 << room
        else:
            b, room, n = n, capacity, n + 1
        bins[k] = b
        room -= size
        if room:
            open_bins[room].append(b)
            mask |= 1 << room
    return bins


def _packed(pieces: pa.Table, round_: int, capacity: int) -> pa.Table:
    """Columns bin, offset, loose, part and round of one partition anew."""
    lengths = pieces.column("length").to_numpy().astype(np.int64)
    bins = best_fit_decreasing(lengths, capacity)
    n = int(bins.max(initial=-1)) + 1
    if round_:
        before = np.stack([pieces.column(c).to_numpy() for c in ("part", "bin")], axis=1)
        old, old_bins = np.unique(before, axis=0, return_inverse=True)
        if len(old) < n:
            bins, n = old_bins.reshape(-1), len(old)
    gap = n - lower_bound(lengths, capacity)
    order = np.argsort(bins, kind="stable")
    running = np.cumsum(lengths[order]) - lengths[order]
    first = np.searchsorted(bins[order], np.arange(n))
    offset = np.empty(len(bins), dtype=np.int64)
    offset[order] = running - running[first][bins[order]] if n else running
    fill = np.bincount(bins, weights=lengths, minlength=n)
    loose = np.zeros(n, dtype=bool)
    least = np.argsort(fill, kind="stable")[: LOOSE_BINS if gap else CERTIFIED_BINS]
    loose[least[fill[least] < capacity]] = True
    new = {
        "bin": pa.array(bins), "offset": pa.array(offset), "loose": pa.array(loose[bins]),
        "round": pa.array(np.full(len(bins), round_, dtype=np.int32)), "part": pieces.column("meet"),
    }
    return pa.table({c: new.get(c, pieces.column(c)) for c in pieces.column_names})


def tokenized_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Columns id, piece, start, length, crc, uid: the pieces of every document's ids and the
    end id. A null or empty text is the end id alone; uid is unique, also among repeated
    rows, and random, so that nothing in the data steers where a piece is packed."""
    python_ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer)
        task, row = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            take, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = words.ids(text.as_py() or "") + end
                for at in range(0, len(ids), 4 * capacity):
                    own = ids[at : at + 4 * capacity]
                    take.append(k)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            uid = np.arange(row, row + len(take), dtype=np.int64) + task
            row += len(take)
            columns = [batch.column(0).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)], pa.array(uid)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "crc", "uid"])

    long = T.LongType()
    schema = T.StructType([source.schema["id"], T.StructField("piece", T.IntegerType()), *[T.StructField(c, long) for c in ("start", "length", "crc", "uid")]])
    return source.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """`pieces` (columns uid and length, 1 to `capacity`, and any others) with sequence_id and
    offset. An empty table gives no rows; equal lengths are taken in any order."""
    python_ready(pieces.sparkSession)
    n = pieces.count()
    parts = max(1, -(-n // part_pieces))
    own = pieces.columns
    state = pieces.select(
        *own, *[F.lit(0).cast("long").alias(c) for c in ("bin", "offset", "part")],
        F.lit(True).alias("loose"), F.lit(0).alias("round"), F.pmod(F.xxhash64("uid"), F.lit(parts)).alias("meet"),
    )
    # One row per length, `capacity` at most.
    lengths = sorted((r["length"], r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect())
    sizes, counts = (np.array(x, dtype=np.int64) for x in (zip(*lengths, strict=True) if lengths else ((), ())))
    least = bound_of_counts(sizes, counts, capacity)
    finished: list[DataFrame] = []
    n_finished = round_ = 0
    while True:
        state = staged(state.groupBy("meet").applyInArrow(_packer(round_, capacity), state.schema))
        n_bins, parts = _standing(state)
        if n_finished + n_bins <= least or parts < 2 or round_ == ROUNDS:
            break
        kept = state.where("NOT loose")
        n_finished += _standing(kept)[0]
        finished.append(kept)
        meetings = -(-parts // MEETING)
        state = state.where("loose").withColumn("meet", F.pmod(F.xxhash64("part"), F.lit(meetings)))
        round_ += 1
    for rows in finished:
        state = state.unionByName(rows)
    sequence = F.shiftleft(F.shiftleft(F.col("round").cast("long"), 31) + F.col("part"), 24) + F.col("bin")
    return state.select(*own, sequence.alias("sequence_id"), "offset")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences of a packed table (columns sequence_id and length), and how many there must be
    at least: equal numbers prove the packing, else their difference is the gap that was left
    when the rounds ended. Counts of lengths, `capacity` rows at most, are all that is read."""
    lengths = sorted((r["length"], r["n"]) for r in packed.groupBy("length").agg(F.count("*").alias("n")).collect())
    sizes, counts = (np.array(x, dtype=np.int64) for x in (zip(*lengths, strict=True) if lengths else ((), ())))
    n = packed.groupBy("sequence_id").agg(F.lit(1)).count()
    return n, bound_of_counts(sizes, counts, capacity)


def _standing(state: DataFrame) -> tuple[int, int]:
    """Sequences; partitions with sequences that can be given up."""
    bins = state.groupBy("part", "bin").agg(F.max("loose").alias("loose"))
    parts = bins.groupBy("part").agg(F.count("*").alias("n"), F.max("loose").alias("loose"))
    row = parts.agg(F.sum("n"), F.count_if("loose")).first()
    return row[0] or 0, row[1]


def _packer(round_: int, capacity: int):
    return lambda rows: _packed(rows, round_, capacity)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset. All
    documents are packed; see `tokenized_pieces` for null, empty and repeated ones."""
    pieces = staged(tokenized_pieces(docs, id_col, text_col, **options))
    return pack(pieces, options.get("capacity", CAPACITY)).select(
        F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset"
    )


def op7_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
