"""Contiguous chunks of a table by position, and putting pieces together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.operators.positions import number_rows


def number_chunks_by_key(df: DataFrame, key: str, chunk_rows: int = 4096) -> DataFrame:
    """Add ``chunk_no``: rows in order of ``key``, cut every ``chunk_rows`` rows.

    The key may be of any orderable type, repeat and be NULL (NULLs first); which
    of equal rows comes first is open.
    """
    numbered = number_rows(df, [key], "_row")
    return numbered.select(*df.columns, F.floor(F.col("_row") / chunk_rows).alias("chunk_no"))


def union_chunks(pieces: list[DataFrame]) -> DataFrame:
    """Scored pieces as one table, columns matched by name."""
    return reduce(DataFrame.unionByName, pieces)
