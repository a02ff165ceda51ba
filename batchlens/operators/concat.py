"""Ordered concatenation of the texts of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.operators.ordered import LongKeys, running_sum, with_running


def concat_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    long: LongKeys | None = None,
    max_chars: int | None = None,
    **others: Column,
) -> DataFrame:
    """``(*keys, part, <text>, *others)``: the texts of each group joined in order.

    ``others`` are further aggregates. Each group is one row, part 0, whatever
    its size. With ``max_chars`` it is cut into parts: a row belongs to the part
    in which its first character lies, so the parts, in ascending order and put
    end to end, are the whole text, and none grows past the bound by more than
    one row. ``long`` says that these are rows of long groups; it changes only
    how their positions are computed.
    """
    part = F.lit(0).cast("long")
    placed = df
    if max_chars is not None:
        chars = F.coalesce(F.length(text), F.lit(0)).cast("long")
        placed = with_running(df, keys, order, long, _upto=running_sum(chars))
        part = F.floor((F.col("_upto") - chars) / max_chars)
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    joined = F.array_join(F.transform(rows, lambda r: r["_text"]), "")
    return placed.groupBy(*keys, part.alias("part")).agg(
        joined.alias(text), *[c.alias(n) for n, c in others.items()]
    )
