"""Speaker turns from JSON text of which parts may be broken."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turns_from_variant(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, turn, speaker, start, end, problem)``, one row per element of a list.

    Unlike ``media.turns_from_text``, where one bad element voids the file, each
    element stands for itself: ``problem`` is ``element`` where its start or end
    is missing or no number (what can be read is kept), NULL where it is sound.
    Text that is no JSON list gives one row without turn whose problem is
    ``text``; what follows a list is passed over. NULL and empty lists give no
    rows; nothing is shuffled.
    """
    spark = df.sparkSession
    parsed = df.where(F.col(text).isNotNull()).select(
        F.col(key).alias("__key"), F.try_parse_json(F.col(text)).alias("__any")
    )
    is_list = F.coalesce(F.startswith(F.schema_of_variant("__any"), F.lit("ARRAY")), F.lit(False))
    lists = parsed.select("__key", is_list.alias("__list"), F.when(is_list, F.col("__any")).alias("__v"))
    elements = lists.lateralJoin(spark.tvf.variant_explode_outer(F.col("__v").outer())).where(
        ~F.col("__list") | F.col("pos").isNotNull()
    )
    rows = elements.select(
        F.col("__key").alias(key),
        F.col("pos").alias("turn"),
        F.try_variant_get("value", "$.speaker", "string").alias("speaker"),
        F.try_variant_get("value", "$.segment.start", "double").alias("start"),
        F.try_variant_get("value", "$.segment.end", "double").alias("end"),
        "__list",
    )
    broken = F.col("start").isNull() | F.col("end").isNull()
    problem = F.when(~F.col("__list"), "text").when(broken, "element")
    return rows.withColumn("problem", problem).drop("__list")
