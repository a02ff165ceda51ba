"""Prompts to a generation table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from batchlens.operators.backends import SERVER_SAMPLING, Backend, Sampling
from batchlens.operators.models import generate
from batchlens.operators.totals import token_totals
from batchlens.plans.partitions import (
    TEXT_JOB,
    JobSize,
    cap_arrow_batches,
    rows_per_call,
    spread,
)
from batchlens.sources.tables import write_table


def generations(
    prompts: DataFrame,
    backend: Backend,
    sampling: Sampling = SERVER_SAMPLING,
    size: JobSize | None = TEXT_JOB,
) -> DataFrame:
    """``(id, text, generated)``: prompts dealt out over the planned partitions
    and answered. Only the two prompt columns are shuffled.

    ``size=None`` answers the prompts where they lie, without a shuffle. That is
    right for a table with many more splits than the cluster has slots.
    """
    slim = prompts.select("id", "text")
    rows = rows_per_call(size)
    cap_arrow_batches(prompts.sparkSession, rows)
    return generate(spread(slim, size), "text", "generated", backend, sampling, rows)


def generate_table(
    prompts: DataFrame,
    table: str,
    backend: Backend,
    sampling: Sampling = SERVER_SAMPLING,
    size: JobSize | None = TEXT_JOB,
    fmt: str | None = None,
) -> DataFrame:
    """Overwrite ``table`` with the generations and give their token totals, which
    are read back from it: no prompt is answered twice."""
    write_table(generations(prompts, backend, sampling, size), table, fmt)
    return token_totals(prompts.sparkSession.table(table))
