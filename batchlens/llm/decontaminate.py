"""Words of training documents that repeat benchmark passages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.tables import BROADCAST_ROWS, small_side, written
from batchlens.llm.words import folded_words

WINDOW = 13


def _hashes(words: str, size: int) -> Column:
    """One hash per run of ``size`` words; none where there are fewer."""
    n = F.size(words)
    return F.when(
        n >= size,
        F.transform(
            F.sequence(F.lit(0), n - size),
            lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, size, hash, words)``, one row per distinct window of each item."""
    worded = items.select(F.col(item).cast("string").alias("item"), folded_words(F.col(text)).alias("w"))
    worded = worded.where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    at = worded.select(
        "item", size.alias("size"), F.explode_outer(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("p"), "w"
    )
    return at.select("item", "size", F.slice("w", F.col("p"), F.col("size")).alias("words")).distinct()


def find_hits(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, __mark, start, size, items)``: occurrences of item windows.

    The hashed windows of the items go to every executor, at most
    ``BROADCAST_ROWS`` of them at a time: a larger benchmark is taken in blocks,
    each with a scan of its own, and so is each window size in use (13 and the
    lengths of shorter items). A matching hash is verified word by word in the
    join. The words of a document stay beside its windows inside one generated
    stage, so only hits are ever written out as rows. ``__mark`` is a hash of the
    text, which tells apart different texts under one id.
    """
    windows = written(item_windows(items), "benchmark-windows")
    counts = windows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()
    worded = docs.select(
        F.col(key).alias("__key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__mark"),
        folded_words(F.col(text)).alias("__w"),
    )
    found = []
    for size, n in sorted((r["size"], r["n"]) for r in counts):
        # The outer form: before a plain explode Spark filters by the array's size,
        # which computes the array a second time, and its words for each element.
        at = worded.withColumn("__h", _hashes("__w", size)).select(
            "__key", "__mark", "__w", F.posexplode_outer("__h").alias("__start", "__hash")
        )
        lookup = (
            windows.where(F.col("size") == size)
            .groupBy("words")
            .agg(F.collect_set("item").alias("__items"))
            .withColumn("__probe", F.xxhash64(*[F.get("words", F.lit(j)) for j in range(size)]))
        )
        blocks = -(-n // BROADCAST_ROWS)
        for block in range(blocks):
            part = lookup.where(F.pmod("__probe", F.lit(blocks)) == block) if blocks > 1 else lookup
            same = (F.col("__hash") == F.col("__probe")) & (
                F.slice("__w", F.col("__start") + 1, size) == F.col("words")
            )
            found.append(
                at.join(F.broadcast(part), same).select(
                    F.col("__key").alias(key),
                    "__mark",
                    F.col("__start").alias("start"),
                    F.lit(size).alias("size"),
                    F.col("__items").alias("items"),
                )
            )
    if not found:
        kind = docs.schema[key].dataType.simpleString()
        schema = f"{key} {kind}, __mark bigint, start int, size int, items array<string>"
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document ``(key, __mark, n_words, n_hit, item_ids)``.

    ``n_hit`` counts words inside any occurrence of a window; ``item_ids`` are
    the items with such windows, as sorted strings. NULL and empty texts have no
    words; items without words match nothing; without items nothing is hit; other
    columns do not matter.
    Repeated rows each get a row. Item windows found in a document (few) meet in
    one row per document, bounded by the document's length.
    """
    hits = find_hits(docs, items, key, text)
    per_doc = hits.groupBy(F.col(key).alias("__k"), F.col("__mark").alias("__m")).agg(
        F.collect_set(F.struct("start", "size")).alias("__at"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__ids"),
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform("__at", lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1))
        )
    )
    slim = per_doc.select("__k", "__m", F.size(covered).alias("__hit"), "__ids")
    base = docs.select(
        key,
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__mark"),
        F.size(folded_words(F.col(text))).cast("long").alias("n_words"),
    )
    return base.join(
        slim, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m")), "left"
    ).select(
        key,
        "__mark",
        "n_words",
        F.coalesce("__hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without contaminated documents, all columns kept.

    Only the ids of contaminated documents are joined to the texts.
    """
    judged = contamination(docs, items, key, text)
    found = written(
        judged.where(is_contaminated(F.col("n_hit"), F.col("n_words")))
        .select(F.col(key).alias("__k"), F.col("__mark").alias("__m"))
        .distinct(),
        "contaminated",
    )
    marked = docs.withColumn("__mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return marked.join(
        small_side(found, found.count()),
        F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m")),
        "left_anti",
    ).select(*docs.columns)


def without_hit_words(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with hit words taken out of the texts, which then are the words
    left, folded and joined by a space; untouched texts stay as they are."""
    hits = find_hits(docs, items, key, text)
    spans = hits.groupBy(F.col(key).alias("__k"), F.col("__mark").alias("__m")).agg(
        F.array_distinct(
            F.flatten(
                F.transform(
                    F.collect_set(F.struct("start", "size")),
                    lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1),
                )
            )
        ).alias("__hit")
    )
    marked = docs.withColumn("__mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = marked.join(
        spans, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m")), "left"
    )
    places = F.sequence(F.lit(0), F.size("__w") - 1)
    left = F.array_except(places, F.col("__hit"))
    rest = F.array_join(F.transform(left, lambda i: F.get("__w", i)), " ")
    worded = joined.withColumn("__w", F.when(F.col("__hit").isNotNull(), folded_words(F.col(text))))
    return worded.withColumn(text, F.when(F.col("__hit").isNull(), F.col(text)).otherwise(rest)).select(
        *docs.columns
    )
