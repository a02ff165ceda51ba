"""Batch inference over Spark tables: prompts in, model answers out, and the
DataFrame work on both sides of the model call."""

import sys

from pyspark import cloudpickle

# Scoring functions travel to the executors inside the task, so a cluster needs
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
