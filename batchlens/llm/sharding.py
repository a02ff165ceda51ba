"""Shards of a table by a keyed permutation of its global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.operators.positions import number_rows

HALF_ROUNDS = 8
# Steps of a cycle tried before the exact bound is: see ``permuted``.
SHORT_WALK = 64


def _round_value(half: Column, number: int, seed: int, size: int) -> Column:
    return F.pmod(F.xxhash64(half, F.lit(number), F.lit(seed)), F.lit(size).cast("long"))


def _feistel(row: Column, wide: int, high: int, seed: int) -> Column:
    """A permutation of 0 .. wide * high - 1: a Feistel network on the two digits."""
    left, right = F.floor(row / F.lit(wide).cast("long")), row % F.lit(wide).cast("long")
    left = left.cast("long")
    for number in range(HALF_ROUNDS):
        if number % 2:
            right = (right + _round_value(left, number, seed, wide)) % F.lit(wide).cast("long")
        else:
            left = (left + _round_value(right, number, seed, high)) % F.lit(high).cast("long")
    return left * F.lit(wide).cast("long") + right


def _unfeistel(place: Column, wide: int, high: int, seed: int) -> Column:
    left = F.floor(place / F.lit(wide).cast("long")).cast("long")
    right = place % F.lit(wide).cast("long")
    for number in reversed(range(HALF_ROUNDS)):
        if number % 2:
            right = F.pmod(right - _round_value(left, number, seed, wide), F.lit(wide).cast("long"))
        else:
            left = F.pmod(left - _round_value(right, number, seed, high), F.lit(high).cast("long"))
    return left * F.lit(wide).cast("long") + right


def _walked(value: Column, rows: int, step) -> Column:
    """Walk the cycle of ``value`` until it is below ``rows``.

    The domain has fewer than sqrt(rows) + 1 values too many, and a cycle meets
    each of them once at most, so that many steps always suffice; but few start
    outside, and of those hardly one needs more than ``SHORT_WALK``.
    """
    longest = math.isqrt(max(rows, 1)) + 2

    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            start,
            lambda at, _: F.when(at < rows, at).otherwise(step(at)),
        )

    short = walk(value, min(longest, SHORT_WALK))
    if longest > SHORT_WALK:
        short = F.when(short < rows, short).otherwise(walk(short, longest))
    return F.when(value < rows, value).otherwise(short)


def _domain(rows: int) -> tuple[int, int]:
    wide = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return wide, max(1, -(-rows // wide))


def permuted(row: Column, rows: int, seed: int = 0) -> Column:
    """The place of row number ``row`` in a keyed shuffle of 0 .. rows - 1."""
    wide, high = _domain(rows)
    return _walked(
        _feistel(row, wide, high, seed), rows, lambda v: _feistel(v, wide, high, seed)
    )


def unpermuted(place: Column, rows: int, seed: int = 0) -> Column:
    """The row number at ``place``: the inverse of ``permuted``."""
    wide, high = _domain(rows)
    return _walked(
        _unfeistel(place, wide, high, seed), rows, lambda v: _unfeistel(v, wide, high, seed)
    )


def shard_rows(
    df: DataFrame, shards: int, order: list[str], seed: int = 0
) -> DataFrame:
    """Add ``shard`` and ``slot`` to the rows of ``df``.

    Row numbers follow ``order``; number ``i`` goes to place ``p = permuted(i)``,
    shard ``p % shards``, slot ``p // shards``. So shards differ by one row at
    most, slots have no gaps, and shard and slot of any row follow from its
    number, the row count and the seed. The same table and seed give the same
    shards on every run and cluster.

    NULLs sort first, equal rows take neighbouring numbers, an empty table gives
    none. Columns called ``shard`` or ``slot`` are replaced. Pass slim rows: all
    columns of ``df`` are sorted along.
    """
    slim = df.drop("shard", "slot", "__row")
    numbered = number_rows(slim, order, "__row")
    rows = numbered.count()
    place = numbered.withColumn("__place", permuted(F.col("__row"), rows, seed))
    count = F.lit(shards).cast("long")
    return place.select(
        *slim.columns,
        (F.col("__place") % count).cast("int").alias("shard"),
        F.floor(F.col("__place") / count).cast("long").alias("slot"),
    )
