"""Row numbers of a whole table without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.sources.scratch import written


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Add the row number (from 0) in ``order``, of any orderable columns.

    A sort deals rows to ranges and numbers them inside each; the written ranges
    are counted, and each gets the rows before it. Rows alike in ``order`` are
    parted by a hash of their other columns and then arbitrarily, so that no single value
    fills a range: numbers are unique, and which of equal rows gets which is
    open. NULLs come first.
    """
    rest = [c for c in df.columns if c not in order]
    ties = [F.xxhash64(*rest)] if rest else []
    ranged = df.sort(*order, *ties, F.monotonically_increasing_id())
    placed = written(ranged.withColumn("__at", F.monotonically_increasing_id()), "rows")
    block = F.shiftright("__at", 33)
    counts = placed.groupBy(block.alias("__of")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "__of", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first")
    )
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per sorted range, which is a partition of the sort.
    joined = placed.join(F.broadcast(first), block == F.col("__of"))
    return joined.select(*df.columns, (F.col("__first") + inside).alias(name))
