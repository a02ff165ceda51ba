"""Media files."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.operators.models import apply_model
from batchlens.sources.ranges import store_of


def media_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    max_inline_bytes: int | None = None,
    nested: bool = False,
) -> DataFrame:
    """``(file_path, file_name, length, content)`` of the files in ``folder``, with
    ``nested`` also of those in folders below it.

    With ``max_inline_bytes`` the content of files up to that size is read and
    larger ones carry NULL, for the task to open by path. Without it no file is
    opened at all.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", nested)
    files = reader.option("pathGlobFilter", pattern).load(folder)
    named = [
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
    ]
    nothing = F.lit(None).cast("binary").alias("content")
    if max_inline_bytes is None:
        return files.select(*named, nothing).unionByName(_empty_files(spark, files, None))
    # The size test is pushed into the scan, so large files are never read.
    small = files.where(F.col("length") <= max_inline_bytes).select(*named, "content")
    large = files.where(F.col("length") > max_inline_bytes).select(*named, nothing)
    return small.unionByName(large).unionByName(_empty_files(spark, files, b""))


def _empty_files(spark: SparkSession, files: DataFrame, content: bytes | None) -> DataFrame:
    """Files that are listed but have nothing to read: Spark's scan leaves them out."""
    listed = spark.createDataFrame(
        [(re.sub("^([A-Za-z][A-Za-z0-9+.-]*:)///", r"\1/", unquote(f)),) for f in files.inputFiles()], "file_path string"
    )
    found = files.select(F.col("path").alias("_path"))
    return listed.join(found, F.col("file_path") == F.col("_path"), "left_anti").select(
        "file_path",
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        F.lit(0).cast("long").alias("length"),
        F.lit(content).cast("binary").alias("content"),
    )


def _qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as the paths in it begin."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/") + "/"


def openable(spark: SparkSession, folder: str) -> bool:
    """Whether tasks can open the files of ``folder`` by path: pyarrow knows its store."""
    try:
        store_of(_qualified(spark, folder))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def with_entries(files: DataFrame, folder: str) -> DataFrame:
    """``media_files`` with ``entry_path`` and ``entry_name`` of what they belong to
    in ``folder``: the file itself, or the folder there that it lies below."""
    base = _qualified(files.sparkSession, folder)
    path = F.col("file_path")
    first = F.element_at(F.split(F.substring(path, len(base) + 1, 1 << 30), "/"), 1)
    inside = path.startswith(base)
    return files.withColumns({
        "entry_path": F.when(inside, F.concat(F.lit(base), first)).otherwise(path),
        "entry_name": F.when(inside, first).otherwise(F.col("file_name")),
    })


def attach_media(files: DataFrame, media: DataFrame) -> DataFrame:
    """``files`` with ``length`` and ``content`` of their file, NULL where it is
    not there. Paths match whether or not they name a file system."""

    def plain(path: Column) -> Column:
        return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/+", "/")

    found = media.select(plain(F.col("file_path")).alias("_path"), "length", "content")
    return files.join(found, plain(F.col("file_path")) == F.col("_path"), "left").drop("_path")


def opened_ends() -> Callable[[list[str], int], list[dict]]:
    """Backend: length and the first and last bytes of files opened by path.

    Only those bytes are read, however large the file is. A store that pyarrow
    does not know raises an error.
    """
    from pyarrow import fs

    def opened(path: str):
        scheme, host, inner = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/]*)?(/.*)", path, re.S).groups()
        if scheme in (None, "file"):
            return fs.LocalFileSystem().open_input_file(inner)
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        store, root = fs.FileSystem.from_uri(f"{scheme}:{host or '//'}/")
        return store.open_input_file(root.rstrip("/") + inner)

    def run(paths: list[str], size: int) -> list[dict]:
        found = []
        for path in paths:
            with opened(path) as file:
                length = file.size()
                least = min(size, length)
                found.append(
                    {"n_bytes": length, "head": file.read_at(least, 0), "tail": file.read_at(least, length - least)}
                )
        return found

    return run


def file_ends(files: DataFrame, size: int = 4) -> DataFrame:
    """``media_files`` without their content, with ``n_bytes``, ``head`` and
    ``tail``: bytes that can be read, and the first and last ``size`` of them.

    They come from the content where it was read; other files are opened by path
    in the task. Contents go no further than this: tasks get paths and ends only.
    """
    content = F.col("content")
    tail = F.when(
        F.octet_length(content) > size, F.substr(content, F.octet_length(content) - size + 1, F.lit(size))
    ).otherwise(content)
    slim = files.select(
        *[c for c in files.columns if c != "content"],
        F.octet_length(content).cast("long").alias("_n"),
        F.substr(content, F.lit(1), F.lit(size)).alias("_head"),
        tail.alias("_tail"),
        F.when(content.isNull(), F.col("file_path")).alias("_open"),
    )
    ends = apply_model(slim, "_open", "_ends", opened_ends, size, "n_bytes bigint, head binary, tail binary")
    return ends.select(
        *[c for c in files.columns if c != "content"],
        F.coalesce("_n", "_ends.n_bytes").alias("n_bytes"),
        F.coalesce("_head", "_ends.head").alias("head"),
        F.coalesce("_tail", "_ends.tail").alias("tail"),
    )
