"""Running values along an order inside each key, for keys of any size.

A window function sends all rows of a key to one task. That is right while a
key is small and wrong once a single key holds a large part of the table. So
``find_long_keys`` counts the rows per key first (a narrow, pre-aggregated job)
and ``by_length`` runs a flow twice: over the ordinary keys with plain windows,
and over the long ones, if there are any, in blocks. There rows are cut into
range-partitioned blocks, each block is scanned on its own, and one summary row
per block carries the state into the next blocks. ``deal_by_key`` makes as many
partitions of the ordinary keys as their rows need.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlens.session import ensure_checkpoint_dir

ROWS_PER_BLOCK = 1_000_000
# Rows of ordinary keys a task should sort.
ROWS_PER_TASK = 200_000
# Hot keys are sent to all executors up to so many bytes of key values, and the
# state carried between blocks up to so many rows of fixed width.
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 100_000
_BLOCK = "_block"


@dataclass(frozen=True)
class Running:
    kind: str
    value: Column


def previous(value: Column) -> Running:
    """Value of the row before. Pass a struct: NULL means there is no such row."""
    return Running("previous", value)


def following(value: Column) -> Running:
    """Value of the row after. Pass a struct: NULL means there is no such row."""
    return Running("following", value)


def running_sum(value: Column) -> Running:
    """Sum up to and including this row."""
    return Running("sum", value)


def running_max(value: Column) -> Running:
    """Maximum up to and including this row."""
    return Running("max", value)


def coming_min(value: Column) -> Running:
    """Minimum from this row on."""
    return Running("coming_min", value)


def last_seen(value: Column) -> Running:
    """Latest non-NULL value up to and including this row."""
    return Running("last_seen", value)


def next_seen(value: Column) -> Running:
    """Earliest non-NULL value from this row on."""
    return Running("next_seen", value)


@dataclass(frozen=True)
class LongKeys:
    """Keys with more than ``max_rows`` rows; ``frame`` holds them as
    ``_long_<key>`` with their ``_rows``."""

    frame: DataFrame
    keys: Sequence[str]
    n_keys: int
    n_rows: int
    max_rows: int
    n_bytes: int = 0

    @property
    def n_blocks(self) -> int:
        return math.ceil(self.n_rows / self.max_rows)

    def marked(self) -> DataFrame:
        """The keys, broadcast only while they are small."""
        return F.broadcast(self.frame) if self.n_bytes <= BROADCAST_BYTES else self.frame

    def matches(self, df: DataFrame) -> Column:
        pairs = [df[k].eqNullSafe(F.col(f"_long_{k}")) for k in self.keys]
        return reduce(lambda a, b: a & b, pairs)

    def rows_of(self, df: DataFrame) -> DataFrame:
        return df.join(self.marked(), self.matches(df), "left_semi")

    def rest_of(self, df: DataFrame) -> DataFrame:
        return df.join(self.marked(), self.matches(df), "left_anti")


def find_long_keys(
    df: DataFrame, keys: Sequence[str], max_rows: int | None = None
) -> LongKeys | None:
    """Count rows per key now; None when every key fits in one task, that is in
    ``max_rows`` (by default ``ROWS_PER_BLOCK``)."""
    max_rows = max_rows or ROWS_PER_BLOCK
    long_rows = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > max_rows)
    )
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(16))
    n_keys, n_rows, n_bytes = long_rows.agg(
        F.count(F.lit(1)), F.sum("_rows"), F.sum(key_bytes.cast("long"))
    ).first()
    if not n_keys:
        return None
    ensure_checkpoint_dir(df.sparkSession)
    frame = long_rows.select(*[F.col(k).alias(f"_long_{k}") for k in keys], "_rows").checkpoint()
    return LongKeys(frame, tuple(keys), n_keys, n_rows, max_rows, n_bytes)


def deal_by_key(df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """Rows dealt out by ``keys`` over as many partitions as their number needs
    (counts them now), so that what a task sorts does not grow with the table.

    Windows over ``keys`` that follow take no shuffle of their own. A table that
    gives each slot at most a task's rows is left to those. A key is never
    split: for long ones see ``by_length``.
    """
    needed = math.ceil(df.count() / (rows_per_task or ROWS_PER_TASK))
    if needed <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(needed, *keys)


def by_length(
    long: LongKeys | None, run: Callable[..., DataFrame], *frames: DataFrame
) -> DataFrame:
    """``run(None, *frames)``, or where there are long keys the union of that over
    the rows of the other keys and ``run(long, *frames)`` over their own rows."""
    if long is None:
        return run(None, *frames)
    ordinary = run(None, *[long.rest_of(f) for f in frames])
    return ordinary.unionByName(run(long, *[long.rows_of(f) for f in frames]))


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    long: LongKeys | None = None,
    keep_blocks: bool = False,
    **columns: Running,
) -> DataFrame:
    """Add running ``columns``. ``order`` must be a total order within a key.

    With ``long`` the rows of ``df`` are those of long keys and go by blocks.
    ``keep_blocks`` leaves the block numbers in, for a further scan of the same
    rows or some of them in the same order.
    """
    if long is None:
        return _windowed(df, keys, order, columns)
    blocks = df if _BLOCK in df.columns else _in_blocks(df, keys, order, long)
    local = _windowed(blocks, [*keys, _BLOCK], order, columns)
    carried = _carried(blocks, keys, order, columns)
    small = long.n_keys + long.n_blocks <= BROADCAST_ROWS and long.n_bytes <= BROADCAST_BYTES
    if small and all(_fixed_width(carried.schema[f"_c_{n}"].dataType) for n in columns):
        carried = F.broadcast(carried)
    on = [local[k].eqNullSafe(F.col(f"_c_{k}")) for k in [*keys, _BLOCK]]
    joined = local.join(carried, reduce(lambda a, b: a & b, on), "left")
    merged = {
        name: _merge(running.kind, F.col(name), F.col(f"_c_{name}"))
        for name, running in columns.items()
    }
    kept = [c for c in blocks.columns if keep_blocks or c != _BLOCK]
    return joined.select(*kept, *[c.alias(n) for n, c in merged.items()])


def _fixed_width(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_fixed_width(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))


def _in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], long: LongKeys
) -> DataFrame:
    """Number the blocks in order.

    Range bounds are sampled afresh by every evaluation, so the blocks are
    written to the checkpoint folder before anything is computed from them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return (
        df.repartitionByRange(long.n_blocks, *keys, *order)
        .withColumn(_BLOCK, F.spark_partition_id())
        .checkpoint()
    )


def _windowed(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, Running]
) -> DataFrame:
    ahead = Window.partitionBy(*keys).orderBy(*order)
    so_far = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def coming(name: str) -> Column:
        # Skipping NULLs ahead is linear; a frame that shrinks from row to row is not.
        later = F.expr(f"lead(`_v_{name}`) IGNORE NULLS").over(ahead)
        return F.coalesce(F.col(f"_v_{name}"), later)

    back = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    over = {
        "previous": lambda v: F.lag(v).over(ahead),
        "following": lambda v: F.lead(v).over(ahead),
        "sum": lambda v: F.sum(v).over(so_far),
        "max": lambda v: F.max(v).over(so_far),
        "coming_min": lambda v: F.min(v).over(
            back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        "last_seen": lambda v: F.last(v, ignorenulls=True).over(so_far),
    }
    named = [r.value.alias(f"_v_{n}") for n, r in columns.items() if r.kind == "next_seen"]
    source = df.select("*", *named) if named else df
    return source.select(
        *df.columns,
        *[
            (coming(n) if r.kind == "next_seen" else over[r.kind](r.value)).alias(n)
            for n, r in columns.items()
        ],
    )


def _carried(
    blocks: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, Running]
) -> DataFrame:
    """Per (key, block): the state its neighbouring blocks hand over."""
    at = F.struct(*order)
    whole = {
        "previous": lambda v: F.max_by(v, at),
        "following": lambda v: F.min_by(v, at),
        "sum": F.sum,
        "max": F.max,
        "coming_min": F.min,
        "last_seen": lambda v: F.max_by(v, F.when(v.isNotNull(), at)),
        "next_seen": lambda v: F.min_by(v, F.when(v.isNotNull(), at)),
    }
    per_block = blocks.groupBy(*keys, _BLOCK).agg(
        *[whole[r.kind](r.value).alias(f"_c_{n}") for n, r in columns.items()]
    )
    ahead = Window.partitionBy(*keys).orderBy(_BLOCK)
    back = Window.partitionBy(*keys).orderBy(F.desc(_BLOCK))
    before = (Window.unboundedPreceding, -1)
    across = {
        "previous": lambda c: F.lag(c).over(ahead),
        "following": lambda c: F.lead(c).over(ahead),
        "sum": lambda c: F.sum(c).over(ahead.rowsBetween(*before)),
        "max": lambda c: F.max(c).over(ahead.rowsBetween(*before)),
        "coming_min": lambda c: F.min(c).over(back.rowsBetween(*before)),
        "last_seen": lambda c: F.last(c, ignorenulls=True).over(ahead.rowsBetween(*before)),
        "next_seen": lambda c: F.last(c, ignorenulls=True).over(back.rowsBetween(*before)),
    }
    return per_block.select(
        *[F.col(k).alias(f"_c_{k}") for k in [*keys, _BLOCK]],
        *[across[r.kind](F.col(f"_c_{n}")).alias(f"_c_{n}") for n, r in columns.items()],
    )


def _merge(kind: str, local: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.when(local.isNull(), carried).otherwise(local + F.coalesce(carried, F.lit(0)))
    if kind == "max":
        return F.greatest(local, carried)
    if kind == "coming_min":
        return F.least(local, carried)
    return F.coalesce(local, carried)
