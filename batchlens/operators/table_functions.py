"""Speech models as table functions: a row per chunk or segment, never a nested cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.udtf import UserDefinedTableFunction

from batchlens.operators.backends import Backend, Recognition, Speakers
from batchlens.plans.partitions import ARROW_BATCH_ROWS

# Rows a task holds before it hands them on.
ROWS_OUT = 10_000


def scored_rows(
    backend: Backend,
    options: Any,
    returns: str,
    row: Callable[[Any], tuple],
    key: str = "file_ids",
    input_col: str = "script",
    batch_rows: int = ARROW_BATCH_ROWS,
) -> UserDefinedTableFunction:
    """A function of a table with ``key`` and ``input_col``: per input and element
    of the model's output one row of the key, the element's position and
    ``row(element)``; ``returns`` names them all.

    The table stays as it is partitioned. The backend is made once per task and
    called with at most ``batch_rows`` inputs. It may give an iterator for an
    input, of which only ``ROWS_OUT`` elements are held at a time, so the output
    for one recording may be of any length. A NULL input, a NULL output and an
    empty one give no rows; repeated inputs are scored each; other columns are
    left alone.
    """
    schema = to_arrow_schema(StructType.fromDDL(returns))

    class Scored:
        def __init__(self) -> None:
            self._model = None

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            self._model = self._model or backend()
            inputs = [
                pair
                for pair in zip(batch.column(key).to_pylist(), batch.column(input_col).to_pylist(), strict=True)
                if pair[1] is not None
            ]
            for start in range(0, len(inputs), batch_rows):
                some = inputs[start : start + batch_rows]
                outputs = self._model([value for _, value in some], options)
                if len(outputs) != len(some):
                    raise ValueError(f"the model gave {len(outputs)} outputs for {len(some)} inputs")
                yield from self._rows(some, outputs)

        def _rows(self, inputs: list[tuple], outputs: list) -> Iterator[pa.RecordBatch]:
            every = (
                (name, position, *row(element))
                for (name, _), elements in zip(inputs, outputs, strict=True)
                for position, element in enumerate(elements if elements is not None else ())
            )
            while held := list(islice(every, ROWS_OUT)):
                columns = zip(*held, strict=True)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return F.arrow_udtf(Scored, returnType=returns)


def transcriber(
    backend: Backend,
    options: Recognition = Recognition(),
    key: str = "file_ids",
    key_type: str = "bigint",
    input_col: str = "script",
) -> UserDefinedTableFunction:
    """``(key, chunk, text, start, end)`` per timed chunk; see ``scored_rows``."""

    def row(chunk: dict) -> tuple:
        start, end = chunk["timestamp"]
        return chunk["text"], start, end

    returns = f"`{key}` {key_type}, chunk int, text string, start double, `end` double"
    return scored_rows(backend, options, returns, row, key, input_col)


def diarizer(
    backend: Backend,
    options: Speakers = Speakers(),
    key: str = "file_ids",
    key_type: str = "bigint",
    input_col: str = "script",
) -> UserDefinedTableFunction:
    """``(key, position, start, end, track, label)`` per raw segment; see ``scored_rows``."""

    def row(element: dict) -> tuple:
        span = element["segment"]
        return span["start"], span["end"], element["track"], element["label"]

    returns = f"`{key}` {key_type}, position int, start double, `end` double, track string, label string"
    return scored_rows(backend, options, returns, row, key, input_col)
