"""Left joins that keep unmatched rows and survive a hot key on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.operators.ordered import LongKeys

def left_join(
    source: DataFrame,
    right: DataFrame,
    key: str,
    long: LongKeys | None = None,
) -> DataFrame:
    """``source LEFT JOIN right`` on ``key``; repeated right keys multiply rows.

    A key that is hot in ``source`` is split by AQE. AQE cannot split the right
    side of a left join, so keys that are hot there (``long``, from
    ``find_long_keys(right, [key])``) are joined apart: the right rows of each are
    spread over salts, as many as its number of rows needs, and its source rows
    repeated for each of them. Such keys all have matches, so for them the left
    join is an inner join. NULL matches nothing and is never hot: its source rows
    stay with the ordinary ones.
    """
    if long is None:
        return source.join(right, key, "left")
    hot = long.marked().where(F.col(f"_long_{key}").isNotNull())
    sizes = hot.select(
        F.col(f"_long_{key}").alias("_hot"), F.ceil(F.col("_rows") / long.max_rows).alias("_salts")
    )
    sized = lambda df: df.join(sizes, df[key] == F.col("_hot"), "left")
    marked = sized(source)
    # From the row and its partition: the same on a retry, and apart for copies.
    mixed = F.xxhash64(F.spark_partition_id(), *right.columns)
    salted = sized(right).where("_hot IS NOT NULL").withColumn("_salt", F.pmod(mixed, F.col("_salts")))
    repeated = marked.where("_hot IS NOT NULL").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    )
    matched = repeated.drop("_hot", "_salts").join(
        salted.drop("_hot", "_salts"), [key, "_salt"]
    ).drop("_salt")
    rest = marked.where("_hot IS NULL").drop("_hot", "_salts")
    return rest.join(long.rest_of(right), key, "left").unionByName(matched)


def join_media(
    files: DataFrame,
    transcription: DataFrame,
    diarization: DataFrame,
    key: str = "file_ids",
    long_transcription: LongKeys | None = None,
    long_diarization: LongKeys | None = None,
) -> DataFrame:
    """File rows with their transcription and diarization, NULL where missing."""
    with_text = left_join(
        files, transcription.select(key, "transcription"), key, long_transcription
    )
    return left_join(
        with_text, diarization.select(key, "diarization"), key, long_diarization
    ).select(key, "file_name", "file_path", "transcription", "diarization")
