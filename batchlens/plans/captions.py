"""Product pictures to captions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from batchlens.operators.backends import Backend, Captioning
from batchlens.operators.models import caption
from batchlens.plans.partitions import (
    ARROW_BATCH_ROWS,
    IMAGE_CALLS,
    JobSize,
    cap_arrow_batches,
    rows_per_call,
    spread,
)
from batchlens.sources.tables import bounded


def captions(
    pictures: DataFrame,
    backend: Backend,
    options: Captioning = Captioning(),
    size: JobSize | None = IMAGE_CALLS,
    key: str | None = None,
    rows: int | None = None,
    input_col: str = "file_path",
) -> DataFrame:
    """Input columns plus ``caption``, for all pictures or the first ``rows`` by ``key``.

    ``input_col`` is what the model gets: a path it opens, or with
    ``sources.media.attach_media`` the content itself. The model gets
    ``rows_per_call`` pictures at once, a task as many calls as its rows need."""
    chosen = pictures if rows is None else bounded(pictures, key, rows)
    rows_at_once = rows_per_call(size)
    cap_arrow_batches(pictures.sparkSession, max(rows_at_once, ARROW_BATCH_ROWS))
    return caption(spread(chosen, size), input_col, backend, options, batch_rows=rows_at_once)
