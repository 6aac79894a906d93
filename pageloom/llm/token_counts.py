"""Token counts that follow edits: segment trees over the pre-tokens of each document.

A byte-level tokenizer cuts a text into pre-tokens and merges within them only, so a text has
as many tokens as its pre-tokens together. A document keeps its pre-tokens in leaves of LEAF
each (their characters and tokens) below a binary tree of sums. After edits, cutting starts
again at the leaf before an edit and goes on until a cut falls on an old leaf's border behind
it; from there on the old leaves hold. Only the sums above changed leaves are added anew.

How far left a cut may depend on what follows: a pre-token is fixed once two characters
behind its end are (a run of white space gives its last character away; a contraction has
three), and cutting does not look back. So the leaf to start at is the last one that begins
two characters or more before the edit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import sum_before
from .common import free_name, python_ready, table
from .tokenizing import PieceCounter

LEAF = 32
# A leaf that edits made larger than this has its tree built anew.
LARGEST_LEAF = 8 * LEAF
TOKENIZER = "byte_bpe_50k.tiktoken"
LOOK_BEHIND = 2
STATE = "struct<chars:array<int>,pieces:array<int>,tree:array<bigint>>"
EDITS = "array<struct<start:int,end:int,text:string>>"

Count = Callable[[str], int]


class SegmentTree:
    """Leaves (characters, pre-tokens) and a heap of token sums, root first at 1."""

    def __init__(self, chars: list[int], pieces: list[int], tokens: list[int]):
        self.chars, self.pieces = chars, pieces
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.tree = [0] * self.size + tokens + [0] * (self.size - len(tokens))
        for k in range(self.size - 1, 0, -1):
            self.tree[k] = self.tree[2 * k] + self.tree[2 * k + 1]

    @classmethod
    def of(cls, text: str, counter: PieceCounter) -> SegmentTree:
        found = counter.pieces(text)
        n = np.array([len(p) for p in found], dtype=np.int64)
        t = np.array([counter.tokens(p) for p in found], dtype=np.int64)
        begins = np.arange(0, len(found), LEAF)
        sums = [np.add.reduceat(x, begins).tolist() if len(found) else [] for x in (n, t)]
        return cls(sums[0], [min(LEAF, len(found) - b) for b in begins.tolist()], sums[1])

    @classmethod
    def stored(cls, state: dict) -> SegmentTree:
        out = cls.__new__(cls)
        out.chars, out.pieces, out.tree = list(state["chars"]), list(state["pieces"]), list(state["tree"])
        out.size = len(out.tree) // 2
        return out

    def state(self) -> dict:
        return {"chars": self.chars, "pieces": self.pieces, "tree": self.tree}

    @property
    def total(self) -> int:
        return self.tree[1]

    def put(self, leaf: int, chars: int, pieces: int, tokens: int) -> None:
        """A leaf's new contents, and the sums above it."""
        self.chars[leaf], self.pieces[leaf] = chars, pieces
        k = self.size + leaf
        change = tokens - self.tree[k]
        while k and change:
            self.tree[k] += change
            k //= 2

    def edit(self, text: str, edits: list[tuple[int, int, str]], counter: PieceCounter) -> tuple[str, int]:
        """Apply edits (start, end, replacement, by start and apart from each other) to `text`;
        the new text and how many pre-tokens were encoded."""
        if not edits:
            return text, 0
        if not self.chars:
            self.chars, self.pieces, self.tree, self.size = [0], [0], [0, 0], 1
        out, done = [], 0
        for start, end, new in edits:
            out += [text[done:start], new]
            done = end
        after = "".join([*out, text[done:]])
        borders = np.concatenate([[0], np.cumsum(self.chars)])
        encoded, shift, k, first_free = 0, 0, 0, 0
        while k < len(edits):
            start, end, new = edits[k]
            leaf = max(first_free, int(np.searchsorted(borders, max(0, start - LOOK_BEHIND), side="right")) - 1)
            # Of empty leaves at that border the first, so that none of them is left behind.
            leaf = min(leaf, len(self.chars) - 1)
            begin = int(borders[leaf]) + shift
            fixed, shift, k = end, shift + len(new) - (end - start), k + 1
            at, n, tokens, last = begin, 0, 0, None
            for piece in counter.pieces_from(after, begin):
                at += len(piece)
                n += 1
                tokens += counter.tokens(piece)
                # Edits that this piece, or what it was cut by, has come to.
                while k < len(edits) and at - shift + LOOK_BEHIND > edits[k][0]:
                    fixed, shift, k = edits[k][1], shift + len(edits[k][2]) - (edits[k][1] - edits[k][0]), k + 1
                old = at - shift
                if old >= fixed:
                    border = int(np.searchsorted(borders, old))
                    if border < len(borders) and borders[border] == old and border > leaf:
                        last = border
                        break
            if last is None:  # the text ends here
                last = len(self.chars)
            encoded += n
            self.put(leaf, at - begin, n, tokens)
            for other in range(leaf + 1, last):
                self.put(other, 0, 0, 0)
            first_free = last
        if max(self.pieces) > LARGEST_LEAF:
            fresh = SegmentTree.of(after, counter)
            self.chars, self.pieces, self.tree, self.size = fresh.chars, fresh.pieces, fresh.tree, fresh.size
        return after, encoded


def apart(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits in order, clipped to the text; one that begins inside the one before is dropped."""
    out: list[tuple[int, int, str]] = []
    rows = [e for e in edits or [] if e and e["start"] is not None and e["end"] is not None]
    for e in sorted(rows, key=lambda e: (e["start"], e["end"])):
        start = min(max(e["start"], 0), length)
        end = min(max(e["end"], start), length)
        if not out or start >= out[-1][1]:
            out.append((start, end, e["text"] or ""))
    return out


def _struct(name: str, ddl: str) -> T.StructField:
    return T.StructField(name, T.DataType.fromDDL(ddl))


_ARROW_STATE = pa.struct([("chars", pa.list_(pa.int32())), ("pieces", pa.list_(pa.int32())), ("tree", pa.list_(pa.int64()))])


def with_counts(docs: DataFrame, text_col: str = "text", state_col: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """`docs` with `state_col`: the segment tree of each text (STATE), its number of tokens at
    tree[1]. Null and empty texts have no leaves and 0 tokens. Rows, also repeated ones, and
    other columns pass through; an empty table gives no rows. `state_col` must be free in
    `docs`, in any case of letters."""
    refuse_taken(docs, state_col)
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            states = [SegmentTree.of(t.as_py() or "", counter).state() for t in texts]
            yield batch.append_column(state_col, pa.array(states, _ARROW_STATE))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, _struct(state_col, STATE)]))


def after_edits(
    counted: DataFrame, edits_col: str = "edits", text_col: str = "text", state_col: str = "tokens", tokenizer: str = TOKENIZER
) -> DataFrame:
    """The rows of `with_counts` after their edits (EDITS: code points, end exclusive): text
    and state are the new ones; added columns old_tokens, encoded (pre-tokens encoded anew).

    Null edits are none; edits are clipped to the text, and one that begins inside the one
    before it is dropped; a null text with edits counts as an empty one. Rows, also repeated
    ones, and other columns pass through; the two added names must be free."""
    refuse_taken(counted, "old_tokens", "encoded")
    python_ready(counted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer)
        for batch in batches:
            names = batch.schema.names
            texts, states, old, encoded = [], [], [], []
            columns = [batch.column(names.index(c)) for c in (text_col, state_col, edits_col)]
            for text, state, edits in zip(*columns, strict=True):
                text, tree = text.as_py(), SegmentTree.stored(state.as_py())
                old.append(tree.total)
                todo = apart(edits.as_py(), len(text or ""))
                after, n = tree.edit(text or "", todo, counter)
                texts.append(after if todo else text)
                states.append(tree.state())
                encoded.append(n)
            batch = batch.set_column(names.index(text_col), text_col, pa.array(texts, pa.string()))
            batch = batch.set_column(names.index(state_col), state_col, pa.array(states, _ARROW_STATE))
            yield batch.append_column("old_tokens", pa.array(old, pa.int64())).append_column("encoded", pa.array(encoded, pa.int64()))

    return counted.mapInArrow(run, T.StructType([*counted.schema.fields, T.StructField("old_tokens", T.LongType()), T.StructField("encoded", T.LongType())]))


def refuse_taken(df: DataFrame, *names: str) -> None:
    taken = {c.lower() for c in df.columns}
    if found := [n for n in names if n.lower() in taken]:
        raise ValueError(f"there already is a column {', '.join(found)}")


def masking_edits(docs: DataFrame, text_col: str = "text", tag_col: str = "source", edits_col: str = "edits") -> DataFrame:
    """`docs` with `edits_col` (EDITS): the tag in brackets is put before the text, and `[NUM]`
    for every run of four digits or more. A null text gets the tag alone, a null tag is empty.
    Rows and other columns pass through; `edits_col` must be free in `docs`."""
    refuse_taken(docs, edits_col)
    runs, gaps, before = (free_name(docs, f"_{n}") for n in ("runs", "gaps", "before"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn(runs, F.regexp_extract_all(text, F.lit("[0-9]{4,}"), F.lit(0)))
    out = out.withColumn(gaps, F.transform(F.split(text, F.lit("[0-9]{4,}"), F.lit(-1)), F.length))
    out = out.withColumn(before, sum_before(F.zip_with(runs, F.slice(gaps, F.lit(1), F.size(runs)), lambda d, g: F.length(d) + g)))

    def edit(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("text"))

    def mask(run: Column, k: Column) -> Column:
        start = F.col(before)[k] + F.col(gaps)[k]
        return edit(start, start + F.length(run), F.lit("[NUM]"))

    tag = edit(F.lit(0), F.lit(0), F.concat(F.lit("["), F.coalesce(F.col(tag_col), F.lit("")), F.lit("] ")))
    return out.withColumn(edits_col, F.concat(F.array(tag), F.transform(runs, mask))).drop(runs, gaps, before)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, and again after two edits to each: its source is put before
    it, and every run of four or more digits is masked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    counted = with_counts(masking_edits(docs), "text", "tokens")
    edited = after_edits(counted)
    return edited.select(
        "doc_id",
        F.col("old_tokens").alias("n_tokens"),
        F.size("edits").cast("long").alias("n_edits"),
        F.col("tokens.tree")[1].alias("n_tokens_after"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("text_after_sha256"),
        F.col("encoded").alias("n_encoded"),
    )
