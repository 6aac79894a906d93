"""Vector codes: exact integer codebooks, distances by limb-split matrix products.

Vectors become integers and are cut into parts; each part position has a codebook, and a code
is the list of the nearest entries. Distances are exact: integers are broken into limbs of
so few bits that every product sum of two limbs stays below 2^53, so the float64 products of
BLAS have no rounding in whatever order they are added; the limbs' dot products are shifted
together in int64. The first least distance wins a tie.

A round reads the vectors once, in place: each task adds up count and sum of the parts of
every entry, so what shuffles is one row per task and component of a codebook, and sums are
decimals that no table overflows. Only codebooks (parts x entries x width integers) are ever
on the driver. The last pass writes codes and errors; the errors of a label are added up
before they shuffle, and sums of labels go back by a broadcast of checked size: of all labels,
or, where there are too many, of those that hold more than 1 / HOT_SHARE of the rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, staged, table

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# Rows of label sums that a join may broadcast.
BROADCAST_LABELS = 200_000
HOT_SHARE = 1_000
MANTISSA = 53


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    x = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.coalesce(F.forall(F.transform(vector, lambda c: c.cast("double")), x), F.lit(False))


def largest_integer(dim: int) -> int:
    """Components of at most this size have squared distances over `dim` places below 2^62."""
    return math.isqrt((1 << 62) // (4 * max(dim, 1))) - 1


def limb_bits(width: int) -> int:
    """Bits of a limb: `width` products of two limbs add up to less than 2^53."""
    return (MANTISSA - 1 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays whose sum over k of limb k x 2^(bits k) is `x`: low limbs from 0 to
    2^bits - 1, the highest with the sign."""
    found = []
    while x.size and (x.max() >= 1 << bits or x.min() < -(1 << bits)):
        found.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*found, x.astype(np.float64)]


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y of stacks of int64 matrices, exact where the result fits 63 bits."""
    bits = limb_bits(x.shape[-1])
    out = np.zeros((*x.shape[:-1], y.shape[-1]), dtype=np.int64)
    ys = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(ys):
            # Shifts beyond 63 bits only carry what cancels in a result that fits.
            if bits * (i + j) < 64:
                out += (a @ b).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts `x` (positions, vectors, width) and codebooks (positions, entries, width): the
    first nearest entry and its squared distance, each (positions, vectors)."""
    distance = (books * books).sum(axis=2)[:, None, :] - 2 * exact_products(x, books.transpose(0, 2, 1))
    best = distance.argmin(axis=2)
    return best, np.take_along_axis(distance, best[:, :, None], 2)[:, :, 0] + (x * x).sum(axis=2)


class Quantizer:
    """How vectors become stacks of integer parts; sent to tasks."""

    def __init__(self, dim: int, parts: int, scale: int):
        self.dim, self.parts, self.scale = dim, parts, scale
        self.width = max(1, -(-dim // parts))

    def integers(self, column: pa.Array) -> np.ndarray:
        """(positions, vectors, width) of a list column without nulls."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        n = len(column)
        x = np.asarray(column.flatten().cast(pa.float64()), dtype=np.float64).reshape(n, self.dim)
        x = np.floor(x * self.scale)
        if x.size and np.abs(x).max() > largest_integer(self.width * self.parts):
            raise ValueError("a component is too large: squared distances would not fit 63 bits")
        padded = np.zeros((n, self.width * self.parts), dtype=np.int64)
        padded[:, : self.dim] = x.astype(np.int64)
        return np.ascontiguousarray(padded.reshape(n, self.parts, self.width).transpose(1, 0, 2))


def first_codebooks(rows: DataFrame, quantizer: Quantizer, entries: int) -> np.ndarray:
    """The parts of the vectors of the smallest ids, ascending; of several vectors of one id
    the smallest. Fewer ids give fewer entries."""
    smallest = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries)
    vectors = pa.array([r["v"] for r in smallest.collect()], pa.list_(pa.float64()))
    return quantizer.integers(vectors)


def next_codebooks(rows: DataFrame, quantizer: Quantizer, books: np.ndarray) -> np.ndarray:
    """Each entry becomes the componentwise floor of the mean of its parts; unused ones stay."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        positions, entries, width = own.shape
        count = np.zeros((positions, entries), dtype=np.int64)
        total = np.zeros(own.shape, dtype=np.int64)
        for batch in batches:
            x = quantizer.integers(batch.column(0))
            best = nearest(x, own)[0]
            for p in range(positions):
                count[p] += np.bincount(best[p], minlength=entries)
                np.add.at(total[p], best[p], x[p])
        p, e, j = (a.reshape(-1) for a in np.indices(own.shape, dtype=np.int32))
        used = count[p, e] > 0
        columns = [p[used], e[used], j[used], count[p, e][used], total.reshape(-1)[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["p", "e", "j", "n", "s"])

    sums = rows.select("v").mapInArrow(run, "p int, e int, j int, n long, s long").groupBy("p", "e", "j")
    new = books.copy()
    # One row per component of a codebook.
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        new[r["p"], r["e"], r["j"]] = int(r["s"]) // r["n"]
    sent.destroy()
    return new


def _coded(rows: DataFrame, quantizer: Quantizer, books: np.ndarray) -> DataFrame:
    """id, label, code, error of every vector."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    digits = np.array([f"{k:02x}" for k in range(books.shape[1])], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = nearest(quantizer.integers(batch.column(2)), sent.value)
            code = ["".join(row) for row in digits[best.T].tolist()]
            out = [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(distance.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(out, names=["id", "label", "code", "error"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return rows.select("id", "label", "v").mapInArrow(run, schema)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` (written) with the error summed over equal labels, nulls together."""
    error = F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    sums = staged(coded.groupBy(F.col("label").alias("of")).agg(error, F.count("*").alias("rows")))
    labels, rows = sums.agg(F.count("*"), F.sum("rows")).first()
    same = F.col("label").eqNullSafe(F.col("of"))
    kept = ["id", "code", "error", "label_error"]
    if labels <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same).select(*kept)
    # At most HOT_SHARE labels hold so many rows; the others shuffle and are no hot keys.
    hot = sums.where(F.col("rows") > rows / HOT_SHARE)
    near = coded.join(F.broadcast(hot), same).select(*kept)
    cold = coded.join(F.broadcast(hot), same, "left_anti")
    return near.unionByName(cold.join(sums.hint("merge"), same).select(*kept))


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """One row per usable vector: id_col, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds a null or non-finite component are left out. The length
    of the vector of smallest id is the table's; vectors of another length have null as code
    and errors, and count nowhere. A length that `parts` does not divide is filled up with
    zeros; empty vectors are all zeros. Equal ids and repeated rows are coded each; an id seeds
    one entry. Null ids seed none; if all are null, there are no codebooks and codes are null.
    Other columns play no part. Components so large that a squared distance might not fit 63
    bits raise an error (beyond 500,000 for 64 dimensions). No usable vector gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    python_ready(vectors.sparkSession)
    v = F.transform(F.col(vector_col), lambda c: c.cast("double")).alias("v")
    rows = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v)
    first = rows.where("id IS NOT NULL").select("id", F.size("v").alias("dim")).orderBy("id", "dim").first()
    quantizer = Quantizer(first["dim"] if first else 0, parts, scale)
    fitting = rows.where(F.size("v") == quantizer.dim) if first else rows.limit(0)
    books = first_codebooks(fitting, quantizer, entries)
    for _ in range(rounds if first else 0):
        books = next_codebooks(fitting, quantizer, books)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    out = _with_label_error(staged(_coded(fitting, quantizer, books))) if first else None
    nothing = [F.lit(None).cast("string").alias("code"), *[F.lit(None).cast("long").alias(c) for c in ("error", "label_error")]]
    other = (rows.where(F.size("v") != quantizer.dim) if first else rows).select("id", *nothing)
    out = out.unionByName(other) if out is not None else other
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same in SQL: distances as sums over components, one statement per round."""
    steps = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"""x AS MATERIALIZED (SELECT r, vec_id, (i - 1) // w AS p, (i - 1) % w AS j, floor({SCALE} * v[i]::DOUBLE)::BIGINT AS x
            FROM (SELECT r, vec_id, v, len(v) // {PARTS} AS w, unnest(range(1, len(v) + 1)) AS i FROM kept))""",
        f"""book0 AS MATERIALIZED (SELECT p, e, j, x AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
            FROM kept QUALIFY e < {ENTRIES}) USING (vec_id))""",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT r, p, min(e) AS e, any_value(d) AS d FROM (
                SELECT r, p, e, d, min(d) OVER (PARTITION BY r, p) AS best FROM (
                    SELECT x.r, x.p, b.e, sum((x.x - b.c) * (x.x - b.c))::BIGINT AS d
                    FROM x JOIN book{k} b ON x.p = b.p AND x.j = b.j GROUP BY x.r, x.p, b.e)) WHERE d = best GROUP BY r, p)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
                    SELECT p, e, j, (s - ((s % n) + n) % n) // n AS c FROM (
                        SELECT x.p, a.e, x.j, sum(x.x)::BIGINT AS s, count(*) AS n
                        FROM x JOIN near{k} a ON x.r = a.r AND x.p = a.p GROUP BY x.p, a.e, x.j)) m USING (p, e, j))"""
            )
    return f"""WITH {', '.join(steps)},
        coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM book{ROUNDS}) AS codebooks_sha256
        FROM kept JOIN coded USING (r)"""


ORACLE = {"op11_vector_codes": _oracle()}
