"""Scoring: one model call per batch of rows, one model per task."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from batchlens.functions.media import CHUNKS, SEGMENTS, join_candidates
from batchlens.operators.backends import (
    Backend,
    Captioning,
    Recognition,
    Sampling,
    Speakers,
)
from batchlens.plans.partitions import ARROW_BATCH_ROWS


def apply_model(
    df: DataFrame,
    input_col: str,
    output_col: str,
    backend: Backend,
    options: Any,
    returns: str,
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """Add ``output_col``, the model's output for ``input_col``; NULL stays NULL.

    The backend is made once per task, on the first batch, and called with at
    most ``batch_rows`` inputs. The column counts as nondeterministic, so Spark
    calls the model once per row even where the output is filtered on. For the
    same reason a filter written after this step is not moved before it: filter
    first. ``count()`` alone drops the column and calls no model.
    """

    arrow_type = to_arrow_type(DataType.fromDDL(returns))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = None
        for batch in batches:
            model = model or backend()
            inputs = batch.to_pylist()
            answers: list[Any] = [None] * len(inputs)
            present = [i for i, value in enumerate(inputs) if value is not None]
            for start in range(0, len(present), batch_rows):
                places = present[start : start + batch_rows]
                outputs = model([inputs[i] for i in places], options)
                if len(outputs) != len(places):
                    raise ValueError(
                        f"the model gave {len(outputs)} outputs for {len(places)} inputs"
                    )
                for place, output in zip(places, outputs):
                    answers[place] = output
            yield pa.array(answers, arrow_type)

    # asNondeterministic changes the function in place, hence a new one per call.
    scored = F.arrow_udf(score, returns).asNondeterministic()
    return df.withColumn(output_col, scored(F.col(input_col)))


def candidates(
    df: DataFrame,
    input_col: str,
    output_col: str,
    backend: Backend,
    sampling: Sampling,
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """``output_col array<string>``: ``sampling.n`` answers per prompt."""
    return apply_model(
        df, input_col, output_col, backend, sampling, "array<string>", batch_rows
    )


def generate(
    df: DataFrame,
    input_col: str,
    output_col: str,
    backend: Backend,
    sampling: Sampling,
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """``output_col string``: the answers to each prompt, joined by a blank."""
    answered = candidates(df, input_col, "_candidates", backend, sampling, batch_rows)
    return answered.withColumn(output_col, join_candidates(F.col("_candidates"))).drop(
        "_candidates"
    )


def transcribe(
    df: DataFrame,
    input_col: str,
    backend: Backend,
    options: Recognition = Recognition(),
    output_col: str = "transcription",
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """Speech to timed chunks (``CHUNKS``)."""
    return apply_model(df, input_col, output_col, backend, options, CHUNKS, batch_rows)


def diarize(
    df: DataFrame,
    input_col: str,
    backend: Backend,
    options: Speakers = Speakers(),
    output_col: str = "segments",
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """Speech to raw speaker segments (``SEGMENTS``), to be collapsed into turns."""
    return apply_model(df, input_col, output_col, backend, options, SEGMENTS, batch_rows)


def caption(
    df: DataFrame,
    input_col: str,
    backend: Backend,
    options: Captioning = Captioning(),
    output_col: str = "caption",
    batch_rows: int = ARROW_BATCH_ROWS,
) -> DataFrame:
    """Picture path to a description."""
    return apply_model(df, input_col, output_col, backend, options, "string", batch_rows)
