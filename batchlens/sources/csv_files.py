"""CSV files read by the names in their headers."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def listed(spark: SparkSession, path: str) -> list[str]:
    """The files Spark would read."""
    return sorted(spark.read.text(path).inputFiles())


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file in any store Spark reads, and no more of it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.open(where)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def header_of(line: str, sep: str = ",") -> tuple[str, ...]:
    return tuple(next(csv.reader([line.removeprefix("﻿")], delimiter=sep)))


def read_by_header(
    spark: SparkSession, path: str, columns: list[str], sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)`` of the CSV files at ``path``, all values strings.

    Columns are found by their names in each file's own header, whatever their
    order and whatever others there are; a file without one of them, or with one
    of them twice, is refused before anything is read. Names are compared as they
    are. Lines with more or fewer values than the header are no rows: they come
    as ``bad(file_path, line)``. Files without a header line hold nothing. No pass
    is spent on types: of each file only the first line is read beforehand.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in listed(spark, path):
        line = first_line(spark, file)
        if line is None:
            continue
        header = header_of(line, sep)
        for name in columns:
            if header.count(name) != 1:
                raise ValueError(f"{file} has column {name} {header.count(name)} times: {list(header)}")
        by_header.setdefault(header, []).append(file)
    if not by_header:
        rows = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return spark.createDataFrame([], rows), spark.createDataFrame([], "file_path string, line string")
    parts = [_parsed(_lines(spark, files), header, sep) for header, files in by_header.items()]
    good = [
        p.where("_v._bad IS NULL").select(*[F.col(f"_v._c{h.index(c)}").alias(c) for c in columns])
        for p, h in zip(parts, by_header, strict=True)
    ]
    bad = [p.where("_v._bad IS NOT NULL").select("file_path", "line") for p in parts]
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines as they are, but for the first one of each file."""
    whole = {"header": True, "enforceSchema": True, "sep": "\x01", "quote": ""}
    lines = spark.read.schema("line string").options(**whole).csv([unquote(f) for f in files])
    return lines.select("line", F.col("_metadata.file_path").alias("file_path"))


def _parsed(lines: DataFrame, header: tuple[str, ...], sep: str) -> DataFrame:
    # By place, as names may be empty or repeat among the columns not asked for.
    fields = ", ".join([*[f"_c{i} string" for i in range(len(header))], "_bad string"])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return lines.withColumn("_v", F.from_csv("line", F.lit(fields), options))
