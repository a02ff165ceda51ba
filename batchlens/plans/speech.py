"""Audio files to attributed transcripts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from batchlens.functions.media import align, chunks_from_text, turns_from_text, turns_of
from batchlens.operators.backends import Backend, Recognition, Speakers
from batchlens.operators.joins import join_media
from batchlens.operators.models import diarize, transcribe
from batchlens.operators.ordered import find_long_keys
from batchlens.plans.partitions import AUDIO_JOB, JobSize, cap_arrow_batches, rows_per_call, spread
from batchlens.sources.tables import write_table


def transcriptions(
    files: DataFrame,
    input_col: str,
    backend: Backend,
    options: Recognition = Recognition(),
    size: JobSize | None = AUDIO_JOB,
) -> DataFrame:
    """Input columns plus ``transcription`` (timed chunks)."""
    cap_arrow_batches(files.sparkSession, rows_per_call(size))
    return transcribe(
        spread(files, size), input_col, backend, options, batch_rows=rows_per_call(size)
    )


def diarizations(
    files: DataFrame,
    input_col: str,
    backend: Backend,
    options: Speakers = Speakers(),
    size: JobSize | None = AUDIO_JOB,
) -> DataFrame:
    """Input columns plus ``diarization`` (speaker turns)."""
    cap_arrow_batches(files.sparkSession, rows_per_call(size))
    raw = diarize(
        spread(files, size), input_col, backend, options, batch_rows=rows_per_call(size)
    )
    return raw.withColumn("diarization", turns_of(F.col("segments"))).drop("segments")


def attributed(joined: DataFrame) -> DataFrame:
    """Add ``mergedTranscriptionDiarization`` to the rows of ``join_media``, NULL
    where one of the two is missing. Either may be nested or JSON text."""

    def nested(name: str, parse: Callable[[Column], Column]) -> Column:
        is_text = isinstance(joined.schema[name].dataType, StringType)
        return parse(F.col(name)) if is_text else F.col(name)

    merged = align(
        nested("transcription", chunks_from_text), nested("diarization", turns_from_text)
    )
    return joined.withColumn("mergedTranscriptionDiarization", merged)


def merge_tables(
    spark: SparkSession,
    files: str,
    transcription: str,
    diarization: str,
    final: str,
    fmt: str | None = None,
) -> None:
    """Join the tables of the two model branches to the files and overwrite
    ``final`` with the attributed transcripts. The branches are independent jobs;
    that they meet as tables keeps a retry here from calling a model again."""
    heard, voices = spark.table(transcription), spark.table(diarization)
    joined = join_media(
        spark.table(files),
        heard,
        voices,
        long_transcription=find_long_keys(heard, ["file_ids"]),
        long_diarization=find_long_keys(voices, ["file_ids"]),
    )
    write_table(attributed(joined), final, fmt)
