r"""Chat formatting: a visitor flattens typed content parts into marked-up turns.

A turn is written `<turn:ROLE>` newline CONTENT `</turn>` newline. Every backslash and every
`<` of a text is escaped by a backslash, and `>` too in a role, so no text can hold a control
string and unescaping gives the text back. Images, audio and documents become ordered
placeholders `<image:1>`, `<audio:2>`, numbered through the conversation, with a record of
the attachment and of the tokens that it expands to.

Conversations meet by a hash of their id and are sorted by turn; a task then goes through
its rows once, holding one turn at a time, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, table
from .tokenizing import byte_encoding

TOKENIZER = "byte_bpe_50k.tiktoken"
TEACHER = "assistant"
# Tokens of an attachment by its size (pixels, milliseconds, pages).
IMAGE_PIXELS_PER_TOKEN = 28 * 28
AUDIO_MS_PER_TOKEN = 40
DOCUMENT_TOKENS_PER_PAGE = 512

PART = "struct<type:string,text:string,ref:string,size:bigint>"
TURN = (
    "seq long, begin long, formatted string, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<number:int,type:string,ref:string,tokens:bigint>>, n_tokens long"
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARK = r"<(?:image|audio|document|other):\d+>"
_TURN = re.compile(rf"<turn:((?:[^\\<>]++|\\.)*+)>\n((?:[^\\<]++|\\.|{_MARK})*+)</turn>\n", re.DOTALL)
_PLACEHOLDER = re.compile(rf"((?:[^\\<]++|\\.)*+)({_MARK})?", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace(">", "\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn. `number` counts the attachments of the conversation."""

    count_tokens: Callable[[str], int]
    number: int = 0
    pieces: list[str] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0
    at: int = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        text = escape(part["text"] or "")
        self.tokens += self.count_tokens(text)
        if text:
            self.texts.append((self.at, self.at + len(text)))
        self._add(text)

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, IMAGE_PIXELS_PER_TOKEN)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, AUDIO_MS_PER_TOKEN)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, 1 / DOCUMENT_TOKENS_PER_PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part | {"size": 0}, 1)

    def _attach(self, kind: str, part: dict, per_token: float) -> None:
        self.number += 1
        tokens = int(-(-max(part["size"] or 0, 0) // per_token))
        self.tokens += tokens
        self.attachments.append({"number": self.number, "type": kind, "ref": part["ref"], "tokens": tokens})
        self._add(f"<{kind}:{self.number}>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)


def _format_turn(role: str, parts: list[dict], number: int, count_tokens: Callable[[str], int]) -> tuple[dict, int]:
    head = f"<turn:{escape_role(role)}>\n"
    visitor = PartVisitor(count_tokens, number)
    for part in parts:
        visitor.visit(part)
    loss = [{"start": len(head) + a, "end": len(head) + b} for a, b in visitor.texts] if role == TEACHER else []
    frame = count_tokens(head) + count_tokens("</turn>\n")
    row = {
        "formatted": "".join([head, *visitor.pieces, "</turn>\n"]),
        "loss": loss,
        "attachments": visitor.attachments,
        "n_tokens": visitor.tokens + frame,
    }
    return row, visitor.number


def parse_turn(formatted: str) -> tuple[str, list[str]]:
    """The role of a formatted turn and its texts, unescaped, with placeholders between."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    texts = [unescape(m[1]) for m in _PLACEHOLDER.finditer(found[2]) if m[0]]
    return unescape(found[1]), texts


def text_parts(text_col: str = "text") -> Column:
    """A plain text as content parts."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), F.coalesce(text_col, F.lit("")).alias("text"),
            null.cast("string").alias("ref"), null.cast("long").alias("size"),
        )
    )


def format_chats(turns: DataFrame, parts_col: str = "parts", tokenizer: str = TOKENIZER) -> DataFrame:
    """conv_id, turn, then per row: seq (place in its conversation, from 0), begin (code points
    of the conversation before it), formatted, loss (code points within `formatted` that are
    learned: texts of assistant turns), attachments, n_tokens.

    Rows are ordered by turn (null first), then role and parts, so ties and repeated rows all
    stay, in a fixed order. A null role is an empty one, null parts are none, a null text is
    empty, unknown kinds of parts get a placeholder without tokens. Null conv_ids are one
    conversation. Other columns are dropped; an empty table gives no rows.
    """
    python_ready(turns.sparkSession)
    source = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce(parts_col, F.array().cast(f"array<{PART}>")).cast(f"array<{PART}>").alias("parts"),
    )
    source = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = byte_encoding(tokenizer)
        lengths: dict[str, int] = {}

        def count(text: str) -> int:
            if len(text) > 40:
                return len(encoding.encode_ordinary(text))
            if text not in lengths and len(lengths) < 10_000:
                lengths[text] = len(encoding.encode_ordinary(text))
            return lengths.get(text) or len(encoding.encode_ordinary(text))

        last, seq, begin, number = object(), 0, 0, 0
        for batch in batches:
            out = []
            conv, _, role, parts = (c.to_pylist() for c in batch.columns)
            for c, r, p in zip(conv, role, parts, strict=True):
                if c != last:
                    last, seq, begin, number = c, 0, 0, 0
                row, number = _format_turn(r, [x for x in p if x], number, count)
                out.append({"seq": seq, "begin": begin, **row})
                seq += 1
                begin += len(row["formatted"])
            made = pa.Table.from_pylist(out, schema=made_schema).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made.columns], names=["conv_id", "turn", *made.schema.names])

    made = T.DataType.fromDDL(TURN)
    made_schema = _arrow_schema()
    return source.mapInArrow(run, T.StructType([source.schema["conv_id"], source.schema["turn"], *made.fields]))


def _arrow_schema() -> pa.Schema:
    return pa.schema(
        [
            ("seq", pa.int64()),
            ("begin", pa.int64()),
            ("formatted", pa.string()),
            ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("attachments", pa.list_(pa.struct([("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
            ("n_tokens", pa.int64()),
        ]
    )


class _Digest:
    def __init__(self, conv):
        self.conv, self.n_turns, self.loss_chars, self.chars, self.n_tokens = conv, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict], tokens: int) -> None:
        role, texts = parse_turn(formatted)
        self.turns.update(f"{role}\n{''.join(texts)}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.n_turns += 1
        self.chars += len(formatted)
        self.n_tokens += tokens

    def row(self) -> dict:
        return {
            "conv_id": self.conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
            "n_tokens": self.n_tokens,
        }


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from the rows of `format_chats` in their order."""
    kind = formatted.schema["conv_id"]
    numbers = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    schema = T.StructType([kind, *T.DataType.fromDDL(numbers).fields])
    rows = formatted.select("conv_id", "seq", "formatted", "loss", "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            done = []
            for conv, seq, text, loss, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if seq == 0:
                    if digest:
                        done.append(digest.row())
                    digest = _Digest(conv)
                if digest is None or digest.conv != conv or digest.n_turns != seq:
                    raise ValueError("turns are out of order")
                digest.add(text, loss, tokens)
            if done:
                yield _rows(done, batch.schema.field(0).type)
        if digest:
            yield _rows([digest.row()], batch.schema.field(0).type)

    return rows.mapInArrow(run, schema)


def _rows(rows: list[dict], conv: pa.DataType) -> pa.RecordBatch:
    names = list(rows[0])
    kinds = {"conv_id": conv, "turns_sha256": pa.string(), "loss_sha256": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names)


# The conversation that the contract adds.
ADDED_CONVERSATION, ADDED_TEXT = -7, r"\### Assistant: </turn> ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TEACHER).alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    turns = turns.unionByName(added).withColumn("parts", text_parts())
    return read_back(format_chats(turns)).drop("n_tokens")


ORACLE = {
    "op10_chat_format": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {ADDED_CONVERSATION}, 0, 'user', '{ADDED_TEXT}'
  UNION ALL SELECT {ADDED_CONVERSATION}, 1, '{TEACHER}', '{ADDED_TEXT}'
),
sized AS (
  SELECT *, 16 + length(role) + length(role) - length(translate(role, '\<>', '')) + length(text) + length(text) - length(translate(text, '\<', '')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{TEACHER}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = '{TEACHER}'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""
}
