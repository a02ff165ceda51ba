"""Tables in and out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIO_FILES = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_ids", T.LongType()),
    ]
)
# Fixed value: where a product's picture lies below the base folder.
IMAGE_FOLDER = "Images/images_with_product_ids/"


def read_products(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, every column a string. The columns are given, so no
    pass over the data is spent on inferring them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(path)


def image_path(base: str, category: Column, gender: Column, image: Column) -> Column:
    """Path of a product picture; NULL when any part is NULL."""
    return F.concat(
        F.lit(base), category, F.lit("/"), gender, F.lit("/"), F.lit(IMAGE_FOLDER), image
    )


def bounded(df: DataFrame, key: str, rows: int = 1000) -> DataFrame:
    """The first ``rows`` rows by ``key``: the same rows on every run."""
    return df.orderBy(key).limit(rows)


def write_table(
    df: DataFrame, name: str, fmt: str | None = None, path: str | None = None
) -> None:
    """Overwrite the whole table. ``fmt`` defaults to the session's format."""
    writer = df.write.mode("overwrite")
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def keep(df: DataFrame) -> DataFrame:
    """Persist an output that is read more than once. For scored tables prefer
    ``write_table`` and reading back: lost cache blocks are scored again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
