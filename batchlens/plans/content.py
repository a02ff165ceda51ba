"""Scoring what is in media files."""

from __future__ import annotations

import io
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import ExitStack
from typing import Any, BinaryIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.operators.backends import Backend
from batchlens.operators.models import apply_model
from batchlens.plans.partitions import cap_arrow_batches
from batchlens.sources.media import attach_media
from batchlens.sources.ranges import RANGE_BYTES, store_of

# Files a model is given at once.
FILES_PER_CALL = 16


def content_scores(
    files: DataFrame,
    media: DataFrame,
    backend: Backend,
    options: Any,
    returns: str,
    output_col: str = "score",
    files_per_call: int = FILES_PER_CALL,
    memory_bytes: int | None = None,
) -> DataFrame:
    """``files(file_path, …)`` with the model's answer to the content of their file.

    ``media`` are the files as ``media_files`` reads them with an inline bound; a
    file that is not there, or beyond the bound, gives NULL. Contents are bytes all
    the way to the model and go no further; Arrow batches are bounded by bytes.

    With ``memory_bytes`` files of any size are scored, all that ``media`` has. The
    model gets each as an open binary file that holds its whole content; a task
    reads by path what was not read inline. Files given at once have so many bytes
    together, and a larger one is given alone, from a temporary file. A store that
    pyarrow does not know raises an error there.
    """
    cap_arrow_batches(files.sparkSession, files_per_call)
    if memory_bytes is not None:
        to_read = F.when(F.col("content").isNull(), F.col("file_path"))
        given = media.withColumn("content", F.struct("content", to_read.alias("path"), "length"))
        on_files = _on_files(backend, memory_bytes)
        # Answers are attached, so that contents stay in the tasks that read them.
        answers = apply_model(given, "content", "content", on_files, options, returns, files_per_call)
        return attach_media(files, answers).withColumnRenamed("content", output_col).drop("length")
    attached = attach_media(files, media)
    scored = apply_model(attached, "content", output_col, backend, options, returns, files_per_call)
    return scored.drop("content", "length")


def _by_bytes(contents: list[dict], most: int) -> Iterator[list[dict]]:
    """Neighbours that have ``most`` bytes together, or one that has more."""
    some: list[dict] = []
    room = most
    for content in contents:
        if some and content["length"] > room:
            yield some
            some, room = [], most
        some.append(content)
        room -= content["length"]
    if some:
        yield some


def _whole(content: dict, memory_bytes: int) -> BinaryIO:
    if content["content"] is not None:
        return io.BytesIO(content["content"])
    store, inner, _ = store_of(content["path"])
    # Zero would mean no bound.
    file = tempfile.SpooledTemporaryFile(max_size=max(1, memory_bytes))
    with store.open_input_file(inner) as source:
        shutil.copyfileobj(source, file, RANGE_BYTES)
    file.seek(0)
    return file


def _on_files(backend: Backend, memory_bytes: int) -> Backend:
    """A backend for ``{content, path, length}``, whose model gets open files."""

    def make():
        model = backend()

        def run(contents: list[dict], options: Any) -> list[Any]:
            answers: list[Any] = []
            for some in _by_bytes(contents, memory_bytes):
                with ExitStack() as opened:
                    outputs = model([opened.enter_context(_whole(c, memory_bytes)) for c in some], options)
                if len(outputs) != len(some):
                    raise ValueError(f"the model gave {len(outputs)} outputs for {len(some)} inputs")
                answers += outputs
            return answers

        return run

    return make
