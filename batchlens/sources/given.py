"""The given tables in the shape of the flows' inputs.

No audio or pictures exist among them, so scripts (texts) stand in for speech
and embedding vectors for waveforms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.operators.ordered import LongKeys, following, with_running
from batchlens.sources.tables import image_path

IMAGE_BASE = "/images/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text)``"""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text)``"""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as speech: ``(file_ids, segment_id, start, label, value, text)``."""
    # Event times carry no zone and count as UTC, whatever the session's zone.
    day = F.unix_date(F.to_date("ts")).cast("long")
    minutes = (day * 24 + F.hour("ts")) * 60 + F.minute("ts")
    micros = (F.date_part(F.lit("SECOND"), "ts") * 1_000_000).cast("long")
    seconds = minutes * 60_000_000 + micros
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("file_ids"),
        F.col("event_id").alias("segment_id"),
        (seconds / F.lit(1e6)).alias("start"),
        F.col("event_type").alias("label"),
        "value",
        F.col("props").alias("text"),
    )


def segments(speech: DataFrame) -> DataFrame:
    """Raw speaker segments, one row each: an event speaks for ``value`` seconds."""
    return speech.select(
        "file_ids",
        "segment_id",
        "start",
        (F.col("start") + F.col("value")).alias("end"),
        "label",
    )


def chunks(
    speech: DataFrame, long: LongKeys | None = None, cut_short: bool = True
) -> DataFrame:
    """Transcript chunks, one row each: like the segments, by default cut short by
    the next one so that ends never decrease. A file's last chunk has no end."""
    after = with_running(
        speech,
        ["file_ids"],
        ["start", "segment_id"],
        long,
        _after=following(F.struct("start")),
    )
    spoken = F.col("start") + F.col("value")
    if cut_short:
        spoken = F.least(spoken, F.col("_after.start"))
    end = F.when(F.col("_after").isNotNull(), spoken)
    return after.select(
        "file_ids", F.col("segment_id").alias("chunk_id"), "text", "start", end.alias("end")
    )


def audio_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_path, file_name, file_ids)``: more files than have been transcribed."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/audio/"), "c_mktsegment", F.lit("/"), "c_name", F.lit(".mp3")).alias(
            "file_path"
        ),
        F.concat("c_name", F.lit(".mp3")).alias("file_name"),
        F.col("c_custkey").alias("file_ids"),
    )


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_ids, script)`` for the recogniser."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_ids"), F.col("text").alias("script")
    )


def overheard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_ids, script)`` for the diarizer: fewer files, other boundaries."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("file_ids"), F.col("html").alias("script")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(product_id, Category, Gender, Image, file_path)``"""
    image = F.concat(F.col("p_name"), F.lit(".jpg"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Gender"),
        image.alias("Image"),
        image_path(IMAGE_BASE, F.col("p_type"), F.col("p_brand"), image).alias("file_path"),
    )


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_ids, sampling_rate, samples)`` at one of four common rates."""
    rates = F.array(F.lit(8000), F.lit(16000), F.lit(22050), F.lit(44100))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("file_ids"),
        F.get(rates, F.pmod(F.col("label"), F.lit(4))).alias("sampling_rate"),
        F.col("embedding").alias("samples"),
    )
