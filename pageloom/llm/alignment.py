"""Alignment of two tokenizers' ids over a corpus, with a fast path for equal tokens.

Tokenizer A merges bytes, tokenizer B merges characters with bytes to fall back on; over one
text both give the same bytes, cut differently. Where a token of each ends at one byte, the
text is cut into groups, and the last token of A there and the last of B are linked.

Identity map: for every A id the id of B with the same bytes, made once from the vocabularies.
Most groups are one such token on either side. Their counts are a vector as long as A's
vocabulary, added up in each task. Only links of irregular groups are counted as pairs, each
distinct pair of a task once, before they shuffle. (A link of two tokens of equal bytes always
is a group of its own: where both end and are as long, both begin.)

A document keeps its links as distinct numbers with multiplicities. Their corpus counts are
looked up in place: the vector of the identity map, the highest count of each B id, and the
pairs of the highest counts, LOOKUP_PAIRS at most, are broadcast; all are bounded by the
vocabularies or by that number. Only links of rarer pairs, the tail, are joined by a shuffle
of (document, pair, multiplicity).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table
from .tokenizing import tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
# Pairs that lookups send to every task: 12 bytes each.
LOOKUP_PAIRS = 1_000_000
# A pair is one number: the A id shifted by the bits of a B id.
B_BITS = 15
SPACE = "▁"
# Characters of text that are aligned together before their rows are handed on.
HANDED_ON = 8 << 20
# The faster library merges a pre-token in quadratic time; texts with longer runs go to the
# tokenizer file's own library.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


def visible_bytes() -> dict[str, int]:
    """Character -> byte of the byte-level spelling: printable Latin-1 bytes are themselves,
    the others follow from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabularies:
    """Bytes of every id of A and of B, and the identity map."""

    a: list[bytes]
    b: list[bytes]
    same: np.ndarray
    ranks: dict[bytes, int]


@lru_cache(maxsize=1)
def vocabularies(name_a: str, name_b: str) -> Vocabularies:
    import sentencepiece

    with open(tokenizer_path(name_a), encoding="utf-8") as file:
        tokenizer = json.load(file)
    vocabulary, byte_of = tokenizer["model"]["vocab"], visible_bytes()
    special = {t["content"] for t in tokenizer["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    # Special tokens are never made here and have no bytes.
    a = [b""] * (max([*vocabulary.values(), *(t["id"] for t in tokenizer["added_tokens"])]) + 1)
    for token, i in ranks.items():
        a[i] = token
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name_b))
    b = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
    assert len(b) <= 1 << B_BITS and len(a) <= 1 << (31 - B_BITS)
    by_bytes: dict[bytes, int] = {}
    for i in reversed(range(len(b))):
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i)):
            by_bytes[b[i]] = i
    for i in range(len(b)):
        if pieces.is_byte(i):
            by_bytes.setdefault(b[i], i)
    return Vocabularies(a, b, np.array([by_bytes.get(token, -1) for token in a], dtype=np.int32), ranks)


class Aligner:
    """Both tokenizers and what turns their ids into groups."""

    def __init__(self, name_a: str, name_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.words = vocabularies(name_a, name_b)
        a, b = self.words.a, self.words.b
        # Ids of this vocabulary are ranks of merges, so the faster library gives the same ids
        # (held against the file's own library in the tests). No special tokens.
        self.quick_a = tiktoken.Encoding(name_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.words.ranks, special_tokens={})
        self.whole_a = Tokenizer.from_file(tokenizer_path(name_a))
        self.whole_a.encode_special_tokens = True
        self.encode_b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name_b))
        self.length_a = np.array([len(t) for t in a], dtype=np.int64)
        self.length_b = np.array([len(t) for t in b], dtype=np.int64)
        # Spelling of an id within its group and at the end of it.
        self.spelled = np.array(
            [*[f"{i}," for i in range(len(a))], *[f"{i}|" for i in range(len(a))],
             *[f"{i}," for i in range(len(b))], *[f"{i};" for i in range(len(b))]], dtype=object,
        )

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A over a space and the text, and of B over the text, which adds the space;
        None where one of them does not give the bytes back."""
        if not text:
            return None
        spaced = f" {text}"
        want = spaced.encode()
        if LONG_RUN.search(text):
            a = self.whole_a.encode(spaced, add_special_tokens=False).ids
        else:
            a = self.quick_a.encode_ordinary(spaced)
        b = self.encode_b.encode(text)
        if b"".join(map(self.words.a.__getitem__, a)) != want or b"".join(map(self.words.b.__getitem__, b)) != want:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the last token of A and of B in each group."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        _, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        return last_a, last_b

    def digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """Of all groups, written `a1,a2|b1;a3|b2,b3`."""
        n_a, n_b = len(self.length_a), len(self.length_b)
        spelled_a, spelled_b = a.copy(), b + 2 * n_a
        spelled_a[last_a] += n_a
        spelled_b[last_b] += n_b
        # Each token of A comes after the B tokens of all groups before, and B's after A's.
        first_b = np.concatenate([[0], last_b[:-1] + 1])
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + first_b[group_a]] = spelled_a
        order[np.arange(len(b)) + last_a[group_b] + 1] = spelled_b
        return hashlib.sha256("".join(self.spelled[order].tolist())[:-1].encode()).hexdigest()

    def row(self, text: str | None) -> tuple:
        """n_a, n_b, n_groups, digest; distinct A ids of identity links and their numbers;
        distinct irregular pairs and theirs."""
        found = self.ids(text or "")
        if found is None:
            return 0, 0, 0, "", *[np.zeros(0, np.int32)] * 4
        a, b = found
        last_a, last_b = self.groups(a, b)
        linked_a, linked_b = a[last_a], b[last_b]
        equal = self.words.same[linked_a] == linked_b
        same, n_same = np.unique(linked_a[equal].astype(np.int32), return_counts=True)
        pair = (linked_a[~equal] << B_BITS | linked_b[~equal]).astype(np.int32)
        pair, n_pair = np.unique(pair, return_counts=True)
        return len(a), len(b), len(last_a), self.digest(a, b, last_a, last_b), same, n_same.astype(np.int32), pair, n_pair.astype(np.int32)


_NUMBERS = ("n_a", "n_b", "n_groups")
_LINKS = ("same", "n_same", "pair", "n_pair")
_LISTS = T.ArrayType(T.IntegerType(), False)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int32)]), pa.int32()))


def _flat(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten())


def _row_of(column) -> np.ndarray:
    """For each entry of a list column the row that it is in."""
    lengths = np.asarray(column.value_lengths())
    return np.repeat(np.arange(len(lengths)), lengths)


def aligned(docs: DataFrame, id_col: str, text_col: str, name_a: str, name_b: str) -> DataFrame:
    """One row per document: id, numbers, digest and links as distinct numbers with
    multiplicities (see `Aligner.row`)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(name_a, name_b)
        for batch in batches:
            start = 0
            while start < len(batch):
                rows, size, stop = [], 0, start
                while stop < len(batch) and size < HANDED_ON:
                    text = batch.column(1)[stop].as_py()
                    rows.append(aligner.row(text))
                    size += len(text or "")
                    stop += 1
                numbers, digests = list(zip(*rows, strict=True)), [r[3] for r in rows]
                columns = [pa.array(c, pa.int64()) for c in numbers[:3]] + [pa.array(digests, pa.string())]
                columns += [_lists(list(c)) for c in numbers[4:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *columns], names=["id", *_NUMBERS, "digest", *_LINKS])
                start = stop

    fields = [source.schema["id"], *[T.StructField(c, T.LongType()) for c in _NUMBERS], T.StructField("digest", T.StringType())]
    return source.mapInArrow(run, T.StructType([*fields, *[T.StructField(c, _LISTS) for c in _LINKS]]))


def identity_counts(rows: DataFrame, n_a: int) -> np.ndarray:
    """How many identity links each A id has; a vector per task, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_a, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0)), weights=_flat(batch.column(1)), minlength=n_a).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["a", "n"])

    counts = rows.select("same", "n_same").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))
    vector = np.zeros(n_a, dtype=np.int64)
    for r in counts.collect():  # one row per id of the vocabulary at most
        vector[r["a"]] = r["n"]
    return vector


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n: how many links of irregular groups each pair has. A task sends a pair once for
    every LOOKUP_PAIRS distinct ones that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, waiting = [], [], 0

        def added():
            key, at = np.unique(np.concatenate([*pairs, np.zeros(0, np.int32)]), return_inverse=True)
            n = np.concatenate([*counts, np.zeros(0, np.int64)])
            return key, np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)

        for batch in batches:
            pairs.append(_flat(batch.column(0)))
            counts.append(_flat(batch.column(1)).astype(np.int64))
            waiting += len(pairs[-1])
            if waiting >= LOOKUP_PAIRS:
                key, n = added()
                pairs, counts, waiting = [key], [n], len(key) // 2
                if len(key) >= LOOKUP_PAIRS:
                    yield _counted(key, n)
                    pairs, counts, waiting = [], [], 0
        yield _counted(*added())

    def _counted(key, n):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(n)], names=["pair", "n"])

    return rows.select("pair", "n_pair").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def least_looked_up(pairs: DataFrame, most: int) -> int:
    """The least power of two such that `most` pairs at most have that count or more."""
    sizes = pairs.groupBy((F.length(F.bin("n")) - 1).alias("bit")).agg(F.count("*").alias("n"))
    least, total = (1 << 63) - 1, 0
    for r in sorted(sizes.collect(), reverse=True):  # 64 rows at most
        total += r["n"]
        if total > most:
            return least
        least = 1 << r["bit"]
    return 1


@dataclass(frozen=True)
class Lookup:
    """Corpus counts: of identity links by A id and whether that is the highest of their B id;
    of the pairs looked up, sorted, the same."""

    same: np.ndarray
    same_best: np.ndarray
    pair: np.ndarray
    count: np.ndarray
    best: np.ndarray


def _looked_up(rows: DataFrame, lookup) -> DataFrame:
    """`rows` with n_best and count_sum of the links that the lookup holds, and the pairs that
    it does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lookup.value
        for batch in batches:
            column = {c: batch.column(batch.schema.names.index(c)) for c in _LINKS}
            n_best, count_sum = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            same, n = _flat(column["same"]), _flat(column["n_same"]).astype(np.int64)
            at = _row_of(column["same"])
            np.add.at(count_sum, at, known.same[same] * n)
            np.add.at(n_best, at, known.same_best[same] * n)
            pair, n, at = _flat(column["pair"]), _flat(column["n_pair"]).astype(np.int64), _row_of(column["pair"])
            place = np.searchsorted(known.pair, pair)
            held = np.zeros(len(pair), dtype=bool)
            inside = place < len(known.pair)
            held[inside] = known.pair[place[inside]] == pair[inside]
            np.add.at(count_sum, at[held], known.count[place[held]] * n[held])
            np.add.at(n_best, at[held], known.best[place[held]] * n[held])
            rare, rare_n, ends = pair[~held], n[~held], np.bincount(at[~held], minlength=len(batch))
            offsets = pa.array(np.concatenate([[0], np.cumsum(ends)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (rare, rare_n)]
            own = [batch.column(batch.schema.names.index(c)) for c in ("uid", "id", *_NUMBERS, "digest")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n_best), pa.array(count_sum), *lists], names=["uid", "id", *_NUMBERS, "digest", "n_best", "count_sum", "rare", "n_rare"])

    long = T.LongType()
    schema = T.StructType(
        [rows.schema["uid"], rows.schema["id"], *[T.StructField(c, long) for c in _NUMBERS], T.StructField("digest", T.StringType()),
         T.StructField("n_best", long), T.StructField("count_sum", long), T.StructField("rare", _LISTS), T.StructField("n_rare", _LISTS)]
    )
    return rows.mapInArrow(run, schema)


def align_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, identity links, irregular pairs), all from whole texts.

    Documents: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row
    for each row of `docs`. Texts that are null, empty, or that one of the tokenizers does not
    give back byte for byte have no tokens: zeros and an empty digest. Repeated rows count each
    time, ids may be null or equal, other columns play no part, an empty table gives no rows.
    Identity links: a, b, n; pairs: a, b, n, whose bytes differ.
    """
    spark = docs.sparkSession
    python_ready(spark)
    words = vocabularies(tokenizer_a, tokenizer_b)
    rows = staged(aligned(docs, id_col, text_col, tokenizer_a, tokenizer_b).withColumn("uid", F.monotonically_increasing_id()))
    same = identity_counts(rows, len(words.a))
    pairs = staged(pair_counts(rows))
    # The highest count of a link to each B id, bounded by the vocabulary.
    best = np.zeros(len(words.b), dtype=np.int64)
    np.maximum.at(best, words.same[words.same >= 0], same[words.same >= 0])
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    for r in pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect():
        best[r["b"]] = max(best[r["b"]], r["n"])

    least = least_looked_up(pairs, LOOKUP_PAIRS)
    frequent = pairs.where(F.col("n") >= least).toArrow()  # LOOKUP_PAIRS rows at most
    pair, count = (np.asarray(frequent.column(c).combine_chunks()) for c in ("pair", "n"))
    order = np.argsort(pair)
    pair, count = pair[order], count[order]
    mapped = np.maximum(words.same, 0)
    lookup = Lookup(same, same == best[mapped], pair, count, count == best[pair & ((1 << B_BITS) - 1)])
    out = _looked_up(rows, spark.sparkContext.broadcast(lookup))
    if least > 1:
        out = _with_rare(staged(out), pairs.where(F.col("n") < least), best)
    documents = out.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", F.col("digest").alias("groups_sha256")
    )
    a_id = F.shiftright("pair", B_BITS)
    used = [(int(a), int(words.same[a]), int(same[a])) for a in np.flatnonzero(same)]
    return documents, spark.createDataFrame(used, "a int, b int, n long"), pairs.select(a_id.alias("a"), b_id.alias("b"), "n")


def _with_rare(rows: DataFrame, pairs: DataFrame, best: np.ndarray) -> DataFrame:
    """`rows` (written) with the links of rarer pairs added, which are joined by a shuffle."""
    tops = rows.sparkSession.createDataFrame([(k, int(n)) for k, n in enumerate(best)], "b int, top long")  # the vocabulary
    pairs = pairs.withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1)).join(F.broadcast(tops), "b")
    links = rows.select("uid", F.inline(F.arrays_zip("rare", "n_rare"))).withColumnRenamed("rare", "pair")
    joined = links.join(pairs, "pair")
    rare = joined.groupBy("uid").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("n_rare")).otherwise(0)).cast("long").alias("rare_best"),
        F.sum(F.col("n") * F.col("n_rare")).alias("rare_sum"),
    )
    added = rows.drop("rare", "n_rare").join(rare, "uid", "left")
    more = {c: (F.col(c) + F.coalesce(F.col(r), F.lit(0))).alias(c) for c, r in (("n_best", "rare_best"), ("count_sum", "rare_sum"))}
    return added.withColumns(more)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"))[0]
