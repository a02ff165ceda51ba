"""Counts over a finished generation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4


def token_totals(generations: DataFrame) -> DataFrame:
    """One row: estimated input and output tokens (characters / 4) and rows.

    NULL texts add nothing to the sums but are counted; an empty table gives
    NULL sums and 0.
    """
    return generations.agg(
        (F.sum(F.length("text")) / CHARS_PER_TOKEN).alias("input_tokens"),
        (F.sum(F.length("generated")) / CHARS_PER_TOKEN).alias("output_tokens"),
        F.count(F.lit(1)).alias("total_ct"),
    )


def batch_report(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows and characters per partition, as the scoring tasks will see them."""
    return (
        df.select(F.spark_partition_id().alias("partition"), F.length(text).alias("_chars"))
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_chars").alias("chars"))
    )
