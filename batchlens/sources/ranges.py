"""Media files of any size as rows of bounded byte ranges: a data source.

``spark.read.format("media_ranges")`` lists a folder and deals files out to tasks:
small ones together, large ones in ranges. Every row holds one range, so memory is
bounded by ``range_bytes`` however large a file is; empty files have one empty
range. Tasks open files themselves, with the file systems pyarrow knows; for
other stores ``media_files`` reads whole files through Spark.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

RANGE_BYTES = 8 * 1024 * 1024
TASK_BYTES = 128 * 1024 * 1024
# What opening a file costs, in bytes that could be read meanwhile.
OPEN_BYTES = 1024 * 1024
SCHEMA = "file_path string, file_name string, length bigint, part int, first_byte bigint, content binary"
_STORE = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/]*)?(/.*)", re.S)
# Names under which Hadoop knows stores that pyarrow calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_of(path: str):
    """``(file system, path in it, what to put before such paths)``."""
    from pyarrow import fs

    found = _STORE.fullmatch(path)
    if found is None:
        raise ValueError(f"an absolute path expected, got {path}")
    scheme, host, inner = found.groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), inner, f"{scheme}:" if scheme else ""
    system, root = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{host or '//'}/")
    return system, root.rstrip("/") + inner, f"{scheme}:{host or ''}"


@dataclass
class Ranges(InputPartition):
    """Ranges of files: path, length, part, first byte, bytes."""

    rows: list[tuple[str, int, int, int, int]]


def ranges_of(path: str, length: int, range_bytes: int) -> list[tuple[str, int, int, int, int]]:
    starts = range(0, max(length, 1), range_bytes)
    return [(path, length, part, at, min(range_bytes, length - at)) for part, at in enumerate(starts)]


def dealt(files: list[tuple[str, int]], range_bytes: int, task_bytes: int) -> list[Ranges]:
    """Ranges of one file after another, as many to a task as ``task_bytes`` allow."""
    tasks: list[Ranges] = []
    room = 0
    for path, length in files:
        for row in ranges_of(path, length, range_bytes):
            cost = row[4] + (OPEN_BYTES if row[2] == 0 else 0)
            if not tasks or cost > room:
                tasks.append(Ranges([]))
                room = task_bytes
            tasks[-1].rows.append(row)
            room -= cost
    return tasks


class _Reader(DataSourceReader):
    def __init__(self, folder: str, pattern: str, range_bytes: int, task_bytes: int):
        self.folder, self.pattern = folder, pattern
        self.range_bytes, self.task_bytes = range_bytes, task_bytes

    def partitions(self) -> list[Ranges]:
        from pyarrow import fs

        system, inner, before = store_of(self.folder)
        listed = system.get_file_info(fs.FileSelector(inner))
        found = [
            (before + f.path, f.size)
            for f in listed
            if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.pattern)
        ]
        return dealt(sorted(found), self.range_bytes, self.task_bytes) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        names = ["file_path", "file_name", "length", "part", "first_byte", "content"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        path, file = None, None
        try:
            for own, length, part, at, size in partition.rows:
                if own != path:
                    if file is not None:
                        file.close()
                    system, inner, _ = store_of(own)
                    path, file = own, system.open_input_file(inner)
                content = file.read_at(size, at)
                if len(content) != size:
                    raise OSError(f"{own} has become shorter while it was read")
                row = (own, own.rsplit("/", 1)[-1], length, part, at, content)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)
        finally:
            if file is not None:
                file.close()


class MediaRanges(DataSource):
    """Options: ``path``, ``pattern`` (all files), ``rangeBytes``, ``taskBytes``."""

    @classmethod
    def name(cls) -> str:
        return "media_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(
            self.options["path"],
            self.options.get("pattern", "*"),
            int(self.options.get("rangeBytes", RANGE_BYTES)),
            int(self.options.get("taskBytes", TASK_BYTES)),
        )


def media_ranges(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    range_bytes: int = RANGE_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """``(file_path, file_name, length, part, first_byte, content)``: every file in
    ``folder`` whole, put end to end by ``part``."""
    spark.dataSource.register(MediaRanges)
    reader = spark.read.format(MediaRanges.name()).option("pattern", pattern)
    return reader.option("rangeBytes", range_bytes).option("taskBytes", task_bytes).load(folder)


def file_sums(ranges: DataFrame) -> DataFrame:
    """``(file_path, file_name, length, n_bytes, n_parts, head, tail)`` per file from
    its ranges; ``n_bytes`` counts what was read. Contents meet nowhere."""
    size = F.octet_length("content").cast("long")
    ends = F.when(size > 0, F.col("part"))
    return ranges.groupBy("file_path", "file_name").agg(
        F.max("length").alias("length"),
        F.sum(size).alias("n_bytes"),
        F.count(F.lit(1)).alias("n_parts"),
        F.min_by(F.substring("content", 1, 4), ends).alias("head"),
        F.max_by(F.substring("content", -4, 4), ends).alias("tail"),
    )
