"""How many partitions a scoring job gets."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JobSize:
    """``workers`` that must all have work, the rows one task should take, and the
    rows a model gets at once, by default all of a task's."""

    workers: int
    rows_per_task: int
    rows_per_call: int | None = None


# The three job shapes and the Arrow batch bound.
TEXT_JOB = JobSize(workers=4, rows_per_task=1024)
AUDIO_JOB = JobSize(workers=2, rows_per_task=4096)
IMAGE_JOB = JobSize(workers=1, rows_per_task=32)
ARROW_BATCH_ROWS = 512
# Pictures go to the model as few at once as in ``IMAGE_JOB``, but a task makes
# many calls: starting a task costs more than 32 pictures of a large table.
IMAGE_CALLS = JobSize(workers=1, rows_per_task=1024, rows_per_call=IMAGE_JOB.rows_per_task)

# Media weigh far more than text: their batches are bounded by bytes too.
ARROW_BATCH_BYTES = 64 * 1024 * 1024


def partition_count(rows: int, size: JobSize) -> int:
    """At least one partition per worker, and no more than a task's rows in each."""
    return max(size.workers, math.ceil(rows / size.rows_per_task))


def partition_plan(df: DataFrame, workload: str, size: JobSize) -> DataFrame:
    """The same as one row: ``(workload, total_rows, num_partitions)``."""
    needed = F.ceil(F.col("total_rows") / size.rows_per_task)
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(workload).alias("workload"),
        "total_rows",
        F.greatest(F.lit(size.workers).cast("long"), needed).alias("num_partitions"),
    )


def spread(df: DataFrame, size: JobSize | None) -> DataFrame:
    """Deal rows out over the planned partitions (counts the rows now); None
    leaves them where they lie.

    Round robin balances model work whatever the keys look like. Spark sorts rows
    before dealing them out, so a retried task deals them the same way.
    """
    return df if size is None else df.repartition(partition_count(df.count(), size))


def rows_per_call(size: JobSize | None) -> int:
    return ARROW_BATCH_ROWS if size is None else size.rows_per_call or size.rows_per_task


def cap_arrow_batches(
    spark: SparkSession, rows: int = ARROW_BATCH_ROWS, size: int = ARROW_BATCH_BYTES
) -> None:
    """Bound the rows and bytes of an Arrow batch of the session. Spark reads this
    when a query starts to run, so call it before the action; the flows do."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
