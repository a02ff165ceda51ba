"""Dealing rows out by what they weigh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.sources.scratch import written


def with_weight_before(df: DataFrame, order: list[str], weight: Column, name: str = "weight_before") -> DataFrame:
    """Add the sum of ``weight`` over the rows before each row in ``order``.

    A sort deals rows to ranges, which are written; sums run inside a range, and
    each range gets that of the ranges before. Rows alike in ``order`` are parted
    by a hash of their other columns. NULL weights count as 0.
    """
    rest = [c for c in df.columns if c not in order]
    ties = [F.xxhash64(*rest)] if rest else []
    ranged = df.withColumn("__w", F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)).cast("long"))
    ranged = ranged.sort(*order, *ties, F.monotonically_increasing_id())
    placed = written(ranged.withColumn("__at", F.monotonically_increasing_id()), "weighed")
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    # A row per sorted range, which is a partition of the sort.
    earlier = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(F.col("__range").alias("__of")).agg(F.sum("__w").alias("__sum"))
    sums = sums.select("__of", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(F.broadcast(sums), F.col("__range") == F.col("__of"))
    before = F.col("__first") + F.coalesce(F.sum("__w").over(inside), F.lit(0))
    return joined.select(*df.columns, before.alias(name), "__w")


def deal_by_weight(df: DataFrame, key: str, weight: Column, partitions: int) -> DataFrame:
    """``df`` in ``partitions`` partitions of nearly equal weight, in order of ``key``.

    No partition weighs more than its share and one row: rows whose weight begins
    inside the same share go together. A retried task deals them the same way.
    """
    weighed = written(with_weight_before(df, [key], weight, "__before"), "dealt")
    total = weighed.agg(F.sum("__w")).first()[0] or 0
    share = max(1, -(-total // partitions))
    part = F.least(F.floor(F.col("__before") / share), F.lit(partitions - 1)).cast("int")
    return weighed.repartitionById(partitions, part).select(*df.columns)
