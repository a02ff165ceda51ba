"""The queries of this package over the given tables, and SQL for some of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm import bpe_trie, decontaminate, jaccard, language, lm, minhash, phrases, pii, quality, repair, sharding, substrings, token_files
from batchlens.llm.oracle import ORACLE
from batchlens.llm.tables import crc_mod, documents
from batchlens.llm.vocabulary import default_path

SHARDS = 24
SECRET = "a key that is kept apart from the data"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    slim = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    placed = sharding.shard_rows(slim, SHARDS, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir), SECRET)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_texts(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = quality.judge(documents(spark, sf_dir, "doc_id", "lang", "text"), labels)
    return judged.select("doc_id", *quality.FEATURES, "kept")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.through_files(documents(spark, sf_dir), default_path())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(documents(spark, sf_dir), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    models = language.train(docs.where(~held_out).select("lang", "text"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.identify(rows, models)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.digests(documents(spark, sf_dir), default_path())


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    docs = documents(spark, sf_dir).select("doc_id", held_out.alias("held_out"), "text")
    return lm.score(docs, ~F.col("held_out"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir, "lang", "text"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report, lines = repair.repair(repair.damage(rows))
    return repair.digests(report, lines).withColumnRenamed("conv", "conv_id")


def queries() -> dict:
    return {name: q for name, q in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
