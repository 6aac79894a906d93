"""Packing by Karmarkar-Karp multiway differencing: near-equal windows, then full ones.

A task tokenizes its documents and gathers pieces until they fill GROUP windows. Those are
dealt to windows by differencing: every piece starts as a partition of its own with one
window in use, and the two partitions of widest spread are merged again and again, the
fullest windows of one with the emptiest of the other, so that their imbalances cancel. The
windows come out nearly equal; whenever the fullest exceeds the capacity, the window count
rises by one and the pieces are dealt again.

Documents may be cut, so the room that is left in near-equal windows is filled: the windows
of fewest pieces are given up, and what they hold is cut to the gaps of the others, one cut a
gap. Of a group less than one window is left over, which joins the task's next group. What
the last groups of the tasks leave over is written with its token ids and meets in further
rounds, each of a sixty-fourth of the tokens of the one before, until one group is left; its
rest is cut to powers of two, which need no padding.

Documents never shuffle. A task holds one group, GROUP x capacity tokens, and the document
at hand.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table
from .tokenizing import WordTokenizer

CAPACITY = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Windows whose pieces are dealt together; a fixed bound on a task's memory.
GROUP = 64
# Longer texts are encoded in parts of about so many characters, cut at spaces.
PART_CHARS = 1 << 20
ID_BYTES = 4

# A piece: number of its document in the task, start, ids as bytes.
Piece = tuple[int, int, bytes]


def differencing(lengths: list[int], n: int) -> list[tuple[int, list[int]]]:
    """`n` windows at most, fullest first: the sum and the positions of the lengths in each."""
    # Windows as (sum, tree of positions); empty ones are left out.
    heap: list[tuple[int, int, list]] = [(-size, k, [(size, k)]) for k, size in enumerate(lengths)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        p, q = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = max(len(p) + len(q) - n, 0)
        a, b = len(p) - both, len(q) - both
        opposing = [(x + y, (u, v)) for (x, u), (y, v) in zip(p[a:], reversed(q[b:]), strict=True)]
        merged = sorted(p[:a] + q[:b] + opposing, key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == n else 0
        made += 1
        heapq.heappush(heap, (least - merged[0][0], made, merged))
    return [(total, _leaves(tree)) for total, tree in (heap[0][2] if heap else [])]


def _leaves(tree) -> list[int]:
    found, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo += x
        else:
            found.append(x)
    return found


def near_equal_windows(lengths: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """As few windows as differencing finds from the least possible count upwards."""
    n = -(-sum(lengths) // capacity)
    while True:
        windows = differencing(lengths, n)
        if not windows or windows[0][0] <= capacity:
            return windows
        n += 1


def full_windows(pieces: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows of exactly `capacity` tokens, and what is left over, which is less than that."""
    lengths = [len(ids) // ID_BYTES for _, _, ids in pieces]
    windows = near_equal_windows(lengths, capacity)
    full = sum(lengths) // capacity
    # Few pieces, so few documents are cut.
    windows.sort(key=lambda w: (w[0] == capacity, len(w[1]), w[0]))
    given_up, kept = windows[: len(windows) - full], windows[len(windows) - full :]
    loose = sorted((pieces[k] for _, own in given_up for k in own), key=lambda p: len(p[2]))
    filled = []
    for total, own in kept:
        window = [pieces[k] for k in own]
        window += _taken(loose, capacity - total)
        filled.append(window)
    return filled, loose


def _taken(loose: list[Piece], n: int) -> list[Piece]:
    """The next `n` tokens of `loose`, from its end; they are removed there."""
    taken = []
    while n:
        doc, start, ids = loose.pop()
        if len(ids) > n * ID_BYTES:
            loose.append((doc, start + n, ids[n * ID_BYTES :]))
            ids = ids[: n * ID_BYTES]
        n -= len(ids) // ID_BYTES
        taken.append((doc, start, ids))
    return taken


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """`pieces` as windows whose lengths are different powers of two."""
    total = sum(len(ids) // ID_BYTES for _, _, ids in pieces)
    return [_taken(pieces, 1 << bit) for bit in range(total.bit_length() - 1, -1, -1) if total >> bit & 1]


class _Rows:
    """Placed pieces of a task, as columns."""

    def __init__(self, schema: pa.Schema, first_sequence: int):
        self.schema, self.sequence = schema, first_sequence
        # Document number -> its id and number of tokens, while pieces of it are open.
        self.docs: dict[int, tuple[object, int]] = {}
        self.columns: list[list] = [[] for _ in schema]

    def add(self, piece: Piece, sequence: int | None, offset: int | None, keep_ids: bool = False) -> None:
        doc, start, ids = piece
        doc_id, doc_tokens = self.docs[doc]
        row = (doc_id, start, len(ids) // ID_BYTES, zlib.crc32(ids), doc_tokens, sequence, offset, ids if keep_ids else None)
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def window(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.add(piece, self.sequence, offset)
            offset += len(piece[2]) // ID_BYTES
        self.sequence += 1

    def flushed(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self.columns = [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _placed(docs: Iterable[tuple[int, object, int, list[Piece]]], rows: _Rows, capacity: int, group: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows of all documents (number, id, tokens, pieces). What is left over in the end is
    kept with its ids, or placed too, if this is the `last` group of all."""
    pool: list[Piece] = []
    tokens = 0
    for number, doc_id, doc_tokens, pieces in docs:
        rows.docs[number] = (doc_id, doc_tokens)
        for piece in pieces:
            n = len(piece[2]) // ID_BYTES
            if n == capacity:
                rows.window([piece])
                continue
            pool.append(piece)
            tokens += n
            if tokens >= group * capacity:
                windows, pool = full_windows(pool, capacity)
                for window in windows:
                    rows.window(window)
                tokens = sum(len(ids) // ID_BYTES for _, _, ids in pool)
        if len(rows.columns[0]) >= 4 * group:
            yield rows.flushed()
            still_open = {doc for doc, _, _ in pool}
            rows.docs = {k: v for k, v in rows.docs.items() if k in still_open}
    windows, pool = full_windows(pool, capacity)
    if last:
        windows += powers_of_two(pool)
    for window in windows:
        rows.window(window)
    for piece in pool:
        rows.add(piece, None, None, keep_ids=True)
    yield rows.flushed()


def _encoded(words: WordTokenizer, text: str) -> bytes:
    """Ids of a text of any length; the tokenizer drops spaces and joins nothing over them."""
    found, at = [], 0
    while len(text) - at > PART_CHARS:
        to = text.find(" ", at + PART_CHARS)
        if to < 0:
            break
        found.append(words.ids(text[at:to]))
        at = to
    found.append(words.ids(text[at:]))
    return b"".join(found)


def _first_sequence(round_: int, part: int) -> int:
    return ((round_ << 24) + part) << 31


_PLACE = ("start", "length", "crc", "doc_tokens", "sequence_id", "offset")


def pack_by_differencing(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP,
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    All documents are packed; a null or empty text is the end id alone, repeated rows and
    equal or null ids are documents of their own, an empty table gives no rows. Other columns
    of `docs` play no part, whatever their names. Texts longer than a window fill windows of
    their own; only their rest is dealt. Every sequence but the last few is full, and those
    have lengths of powers of two.
    """
    spark = docs.sparkSession
    python_ready(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    long = T.LongType()
    schema = T.StructType([source.schema["id"], *[T.StructField(c, long) for c in _PLACE], T.StructField("ids", T.BinaryType())])
    end = end_id.to_bytes(ID_BYTES, "little")
    step = capacity * ID_BYTES

    def pieces_of(words: WordTokenizer, batches: Iterator[pa.RecordBatch]):
        number = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = _encoded(words, text.as_py() or "") + end
                own = [(number, at // ID_BYTES, ids[at : at + step]) for at in range(0, len(ids), step)]
                yield number, doc_id.as_py(), len(ids) // ID_BYTES, own
                number += 1

    def from_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(arrow, _first_sequence(0, TaskContext.get().partitionId()))
        yield from _placed(pieces_of(WordTokenizer(tokenizer), batches), rows, capacity, group, False)

    def rest_packer(round_: int, last: bool):
        def run(key: tuple[pa.Scalar, ...], rest: pa.Table) -> pa.Table:
            rows = _Rows(arrow, _first_sequence(round_, key[0].as_py()))
            rest = rest.sort_by([("crc", "ascending"), ("start", "ascending"), ("length", "ascending")])
            columns = [rest.column(c).to_pylist() for c in ("id", "doc_tokens", "start", "ids")]
            found = ((k, i, n, [(k, start, ids)]) for k, (i, n, start, ids) in enumerate(zip(*columns, strict=True)))
            return pa.Table.from_batches(_placed(found, rows, capacity, group, last), arrow)

        return run

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    done, placed = [], staged(source.mapInArrow(from_texts, schema))
    round_ = 0
    while True:
        done.append(placed.where("sequence_id IS NOT NULL"))
        rest = placed.where("sequence_id IS NULL")
        tokens = rest.agg(F.sum("length")).first()[0]
        if not tokens:
            break
        round_ += 1
        parts = -(-tokens // (group * capacity))
        # Where a piece meets others follows from its ids, not from where it was read.
        meet = F.pmod(F.xxhash64("crc", "start", "doc_tokens", "id"), F.lit(parts)).alias("meet")
        packer = rest_packer(round_, parts == 1)
        placed = staged(rest.withColumn("meet", meet).groupBy("meet").applyInArrow(packer, schema))
    out = done[0]
    for rows in done[1:]:
        out = out.unionByName(rows)
    return out.select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_differencing(table(spark, sf_dir, "documents"))
