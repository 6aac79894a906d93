"""Running state over an array that stays inside its row (no shuffle, no window)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Work on blocks so that a page with 100,000 links does not copy its accumulator
# 100,000 times.
_BLOCK = 256
# Up to so many values it is cheaper to add up those before each than to carry a state along.
_FEW = 32


def _running(values: Column, first: Column, measure: Callable[[Column], Column]) -> Column:
    """Sum of the measures of all elements before each element, and of all of them."""
    zero = F.struct(first.alias("total"), F.array(first).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + measure(x)
        return F.struct(total.alias("total"), F.concat(acc["out"], F.array(total)).alias("out"))

    return F.aggregate(values, zero, step, lambda acc: acc["out"])


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often the body names it. (A fold over
    nothing hands its start on as it is; `transform` would copy it, with all it holds.)"""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def _blocks(values: Column) -> Column:
    last = F.greatest((F.size(values) - 1) / _BLOCK, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))


def scan(values: Column, first: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """`first` combined with all values up to each; a short array, since every step copies
    what it has so far."""
    empty = F.struct(first.alias("total"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        total = combine(acc["total"], x)
        return F.struct(total.alias("total"), F.concat(acc["out"], F.array(total)).alias("out"))

    return F.aggregate(values, empty, step, lambda acc: acc["out"])


def running(values: Column, first: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """The same for an array of any length, for an associative `combine` of integers that
    leaves a value as it is when it is combined with `first`."""
    def in_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, first, lambda a, x: combine(a, x)))
        starts = F.concat(F.array(first), scan(totals, first, combine))
        return bound(starts, lambda s: F.flatten(F.transform(blocks, lambda b, i: scan(b, F.get(s, i), combine))))

    return F.when(F.size(values) <= _BLOCK, scan(values, first, combine)).otherwise(bound(_blocks(values), in_blocks))


def sum_before(values: Column, measure: Callable[[Column], Column] = lambda x: x) -> Column:
    """The sum of the (integer) measures before each position; one more entry at the
    end holds the total."""
    blocks = _blocks(values)
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + measure(x)))
    starts = _running(sums, F.lit(0), lambda x: x)
    # Each block ends with its total, which is the first entry of the next one.
    in_blocks = F.flatten(
        F.zip_with(
            blocks,
            F.slice(starts, F.lit(1), F.size(blocks)),
            lambda b, s: F.slice(_running(b, s, measure), F.lit(1), F.size(b)),
        )
    )
    long = F.concat(in_blocks, F.array(F.element_at(starts, -1)))
    short = _running(values, F.lit(0), measure)
    few = bound(
        F.transform(values, measure),
        lambda m: F.transform(F.sequence(F.lit(0), F.size(m)), lambda i: F.aggregate(F.slice(m, F.lit(1), i), F.lit(0), lambda a, x: a + x)),
    )
    n = F.size(values)
    return F.when(n.between(0, _FEW), few).when(n <= _BLOCK, short).otherwise(long)
