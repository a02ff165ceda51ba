"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder for intermediate data and return it.

    The cluster names the folder in ``spark.checkpoint.dir``. Where that is unset
    and none was set on the context, a session on one machine gets a temporary
    folder; on a cluster that would lose data, so there the name is required.
    """
    context = spark.sparkContext
    in_use = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if in_use is None:
        if not named and re.match(r"local(\[|$)", context.master):
            named = tempfile.mkdtemp(prefix="batchlens-")
        if not named:
            raise ValueError("name a folder all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(named)
        in_use = context.getCheckpointDir()
    return named or in_use
