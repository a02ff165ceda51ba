"""Replacing a table without a moment in which its rows can be lost.

Overwriting in place deletes the old files first, so a job that dies while writing
leaves nothing. Here every write goes to a folder of its own; the table is pointed
at it once all rows are known to be there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """Location and provider of the table; empty if there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name IN ('Location', 'Provider')")
    return {r.col_name: r.data_type for r in rows.collect()}


def _default_base(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions"


def replace_table(
    df: DataFrame, name: str, fmt: str = "parquet", base: str | None = None, keep: int = 1
) -> str:
    """Make ``df`` the whole content of table ``name`` and return its new folder.

    ``df`` is written below ``base`` (by default in the warehouse), read back and
    counted against the rows that went in; a difference fails the job. Where the
    columns and the format are the same, the table is then switched by a single change of its
    location. Changed columns need the entry to be made anew: readers may miss the
    table for that moment, the data of neither version is touched. Until the
    switch readers see the old rows, whatever becomes of the job. ``keep`` older
    versions stay for readers that have begun; folders of broken writes go too.
    A table of this name that was written otherwise has to be dropped first.
    """
    spark = df.sparkSession
    home = f"{(base or _default_base(spark)).rstrip('/')}/{name}"
    table = _described(spark, name)
    before = table.get("Location")
    if before is not None and f"/{name}/v-" not in before:
        raise ValueError(f"{name} is not kept in versions: drop it first")
    # Sorted names follow the order of writing.
    number = 1 + (int(before.rsplit("v-", 1)[1].split("-")[0]) if before else 0)
    folder = f"{home}/v-{number:08d}-{uuid.uuid4().hex}"
    went = Observation()
    df.observe(went, F.count(F.lit(1)).alias("n")).write.format(fmt).save(folder)
    back = spark.read.format(fmt).schema(df.schema).load(folder)
    there = back.count()
    if there != went.get["n"]:
        raise RuntimeError(f"{went.get['n']} rows were written to {folder}, {there} are there")
    _switch(spark, name, fmt, folder, back, table)
    _retire(spark, home, folder, before, keep)
    return folder


def _switch(spark: SparkSession, name: str, fmt: str, folder: str, rows: DataFrame, table: dict[str, str]) -> None:
    if table:
        now = spark.table(name)
        alike = [(f.name, f.dataType) for f in now.schema] == [(f.name, f.dataType) for f in rows.schema]
        if alike and table["Provider"].lower() == fmt.lower():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{folder}'")


def _retire(spark: SparkSession, home: str, current: str, before: str | None, keep: int) -> None:
    """Delete all but the current version and the ``keep`` before it."""
    if is_remote():
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(home)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted((s.getPath().getName() for s in files.listStatus(path)), reverse=True)
    now, last = (f.rsplit("/", 1)[1] if f else "" for f in (current, before))
    older = [v for v in versions if v <= last]
    for v in versions:
        if v != now and v not in older[:keep]:
            files.delete(jvm.org.apache.hadoop.fs.Path(f"{home}/{v}"), True)

