"""Speaker turns: consecutive segments of one speaker become one turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.operators.ordered import (
    LongKeys,
    following,
    previous,
    running_sum,
    with_running,
)


def speaker_turns(
    segments: DataFrame,
    key: str = "file_ids",
    order: Sequence[str] = ("start", "segment_id"),
    long: LongKeys | None = None,
) -> DataFrame:
    """``(key, turn, speaker, start, end)`` from one row per raw segment.

    A turn starts with the first segment of its run and ends where the next run
    starts; the last turn ends with the last raw segment. ``segments`` holds
    ``key``, ``label``, ``start``, ``end`` and the ``order`` columns; ``long`` says
    that these are rows of long files (see ``ordered.by_length``).

    Only run heads and the last row of a file matter for the result, so the
    other rows are dropped before the second scan; both scans share one shuffle
    and one sort.
    """
    slim = segments.select(key, *dict.fromkeys([*order, "label", "start", "end"]))
    near = with_running(
        slim,
        [key],
        order,
        long,
        keep_blocks=True,
        _before=previous(F.struct(F.col("label"))),
        _after=following(F.struct(F.lit(1))),
    )
    head = F.col("_before").isNull() | ~F.col("_before.label").eqNullSafe(F.col("label"))
    marked = near.withColumn("_head", head).where(F.col("_head") | F.col("_after").isNull())
    edges = marked.drop("_before", "_after")
    turns = with_running(
        edges,
        [key],
        order,
        long,
        turn=running_sum(F.col("_head").cast("long")),
        _next=following(F.struct("_head", "start", "end")),
    ).where("_head")
    end = (
        F.when(F.col("_next").isNull(), F.col("end"))
        .when(F.col("_next._head"), F.col("_next.start"))
        .otherwise(F.col("_next.end"))
    )
    return turns.select(
        key,
        (F.col("turn") - 1).alias("turn"),
        F.col("label").alias("speaker"),
        "start",
        end.alias("end"),
    )
