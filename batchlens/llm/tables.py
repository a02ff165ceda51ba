"""Small helpers for tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.sources.scratch import new_folder, written

__all__ = ["BROADCAST_ROWS", "by_bytes", "crc_mod", "documents", "new_folder", "small_side", "written"]

# Small tables that tasks look things up in go to every executor up to this many
# rows; beyond it the same lookup is an ordinary join.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for the small side of a join, broadcast only if ``rows`` is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def by_bytes(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of the column ``text``; a longer text is not cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        places = (np.cumsum(sizes) - 1).clip(0) // most
        bounds = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(sizes)]
        yield from (batch.slice(a, b - a) for a, b in pairwise(bounds) if a < b)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = columns or ("doc_id", "text")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*wanted)
