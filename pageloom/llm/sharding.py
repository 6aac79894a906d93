"""Minimax contiguous sharding: the smallest capacity that fits, and cuts below it.

Documents of equal text form one atomic group; groups stand in the order of the digest of
their text. A shard is a contiguous run of groups, so a document's shard follows from
comparing its digest with the cuts: no join brings the decision back to the rows.

The smallest feasible capacity is found by binary search, each capacity being checked by
filling greedily. The driver never sees the groups. It sees a summary of the ordered sizes:
sums by digest prefix, a fixed number of ranges. The greedy check is run on it twice, once
with cuts at known places only (what it finds is feasible) and once with cuts wherever a
range might allow them (what fails is infeasible). While the two differ, the ranges that lie
where a cut may fall are split by longer prefixes, a fixed number of ranges per pass, until
both agree on the capacity: the exact minimum over the atomic groups.

Greedy cuts at the least capacity leave the last shards empty when one group is larger than
a fair share. The cuts are therefore drawn back to the fair share of what is left wherever
the rest still fits: the largest shard stays the same, the others become even.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, text_bytes, text_key

N_SHARDS = 40
ROW_BYTES = 16
# Ranges that one pass may bring to the driver; a hexadecimal digit splits one in 16.
SUMMARY_RANGES = 1 << 14
# Rows of a shard that one task numbers.
SLOT_ROWS = 20_000


@dataclass(frozen=True)
class Range:
    """Groups whose digest begins with `prefix`: total size, smallest and largest digest."""

    prefix: str
    size: int
    first: str
    last: str

    @property
    def whole(self) -> bool:
        return self.first == self.last


class Profile:
    """Running sizes at the ends of the ranges, and what lies within a range."""

    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges, key=lambda r: r.first)
        self.ends = [0]
        for r in self.ranges:
            self.ends.append(self.ends[-1] + r.size)
        self.total = self.ends[-1]

    def known_cut(self, limit: int) -> int:
        """The last known place for a cut at or before `limit`."""
        return self.ends[bisect_right(self.ends, limit) - 1]

    def possible_cut(self, limit: int) -> int:
        """The last place for a cut at or before `limit` that the summary does not exclude."""
        i = bisect_right(self.ends, limit) - 1
        inside = i < len(self.ranges) and not self.ranges[i].whole
        return limit if inside else self.ends[i]

    def greedy(self, capacity: int, shards: int, cut, start: int = 0) -> list[int] | None:
        """Where filling to `capacity` cuts; None if more than `shards` are needed."""
        places = []
        while start < self.total:
            if len(places) == shards:
                return None
            end = cut(start + capacity)
            if end <= start:
                return None
            places.append(end)
            start = end
        return places

    def least(self, shards: int, cut) -> int:
        """The smallest capacity with which greedy filling needs `shards` at most."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, cut) is None:
                low = mid + 1
            else:
                high = mid
        return low

    def undecided(self, low: int, high: int, shards: int) -> list[int]:
        """Ranges that hold more than one group and in which a cut may fall with a
        capacity between `low` and `high`."""
        found: set[int] = set()
        least = most = 0
        for _ in range(shards):
            least, most = self.known_cut(least + low), self.possible_cut(min(most + high, self.total))
            a, b = bisect_right(self.ends, least) - 1, bisect_left(self.ends, most)
            found.update(i for i in range(a, min(b, len(self.ranges))) if not self.ranges[i].whole)
        return sorted(found)


def summarize(groups: DataFrame, digits: int) -> list[Range]:
    """Sums by the first `digits` digits of the digest; partly summed before the shuffle."""
    rows = (
        groups.groupBy(F.substring("key", 1, digits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.min("key").alias("first"), F.max("key").alias("last"))
        .collect()
    )
    return [Range(r["prefix"], r["size"], r["first"], r["last"]) for r in rows]


def profile(sized: DataFrame, shards: int) -> tuple[Profile, int]:
    """A profile fine enough to tell the least capacity, and that capacity."""
    digits = 1
    while 16 ** (digits + 1) <= SUMMARY_RANGES:
        digits += 1
    ranges = summarize(sized, digits)
    while True:
        seen = Profile(ranges)
        low, high = seen.least(shards, seen.possible_cut), seen.least(shards, seen.known_cut)
        if low == high:
            return seen, high
        finer = [seen.ranges[i] for i in seen.undecided(low, high, shards)]
        # The largest first: a pass splits as many as its summary has room for.
        finer = sorted(finer, key=lambda r: -r.size)[: SUMMARY_RANGES // 16]
        by_length: dict[int, list[str]] = {}
        for r in finer:
            by_length.setdefault(len(r.prefix), []).append(r.prefix)
        taken = {r.prefix for r in finer}
        ranges = [r for r in seen.ranges if r.prefix not in taken]
        for length, prefixes in by_length.items():
            # Each range in about as many parts as there is room for.
            more = 1
            while len(prefixes) * 16 ** (more + 1) <= SUMMARY_RANGES and length + more < 64:
                more += 1
            part = sized.where(F.substring("key", 1, length).isin(prefixes))
            ranges += summarize(part, min(length + more, 64))


def fair_share(sizes: list[int], shards: int) -> float:
    """What a shard would hold if all were even, apart from ranges that fill one or more alone."""
    left, total = shards, sum(sizes)
    for size in sorted(sizes, reverse=True):
        if left == 1 or size <= total / left:
            break
        left, total = left - 1, total - size
    return total / left


def even_cuts(seen: Profile, capacity: int, shards: int) -> list[int]:
    """Cuts at known places: no shard above `capacity`, each as near to the fair share of
    what is left as the rest allows, and none empty while there are ranges."""
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        start = seen.ends[at]
        most = bisect_right(seen.ends, start + capacity) - 1
        fair = start + fair_share([r.size for r in seen.ranges[at:]], left)
        i = bisect_left(seen.ends, fair)
        if i > 0 and fair - seen.ends[i - 1] <= seen.ends[min(i, len(seen.ends) - 1)] - fair:
            i -= 1
        low, high = min(max(i, at + 1), most), most
        while low < high:  # the nearest from there on with which the rest fits
            mid = (low + high) // 2
            if seen.greedy(capacity, left - 1, seen.known_cut, seen.ends[mid]) is None:
                low = mid + 1
            else:
                high = mid
        at = low
        cuts.append(seen.ends[at])
    return cuts


def shard_of(key: Column, seen: Profile, cuts: list[int]) -> Column:
    """The number of cuts before `key`."""
    firsts = [seen.ranges[i].first if (i := bisect_left(seen.ends, c)) < len(seen.ranges) else None for c in cuts]
    passed = [F.when(key >= F.lit(f), 1).otherwise(0) for f in firsts if f is not None]
    return reduce(lambda a, b: a + b, passed, F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id_col, size, key, text_crc32, shard, slot: one row per row of `docs`.

    Equal texts share a shard; a null text counts as an empty one; an empty table gives no
    rows; repeated rows and ids are kept, each with a slot of its own; other columns of
    `docs`, whatever their names, are not read. If there are fewer groups than shards, some
    shards stay empty.
    """
    text = F.col(text_col)
    sized = staged(
        docs.select(
            F.col(id_col).alias("id"),
            (text_bytes(text) + ROW_BYTES).alias("size"),
            F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8")).alias("crc"),
            text_key(text).alias("key"),
        )
    )
    n = sized.count()
    if n:
        seen, capacity = profile(sized, shards)
        shard = shard_of(F.col("key"), seen, even_cuts(seen, capacity, shards))
    else:
        shard = F.lit(0)
    return with_slots(sized.withColumn("shard", shard), max(1, n // (shards * SLOT_ROWS))).select(
        F.col("id").alias(id_col), "size", "key", F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def with_slots(rows: DataFrame, parts: int) -> DataFrame:
    """Gapless numbers within each shard. A shard is numbered in `parts` parts, so that one
    large shard or group of copies is not one task's work; a table of counts, one row per
    shard and part, says where each part begins."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "key"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "id", "size"))
    return (
        rows.withColumn("inside", inside)
        .join(starts, ["shard", "part"])
        .withColumn("slot", (F.col("before") + F.col("inside") - 1).cast("long"))
    )


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 under the law `bytes`."""
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
