"""Wiring of the queries to the given tables, and their SQL counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
# For the Python workers of a session that is started after this.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.functions import media, prompts, variants
from batchlens.functions import sql as sql_functions
from batchlens.operators import audio, backends, chat, chunks, models, totals
from batchlens.operators.align import align_chunks, align_turns
from batchlens.operators.joins import join_media
from batchlens.operators.ordered import LongKeys, by_length, deal_by_key, find_long_keys
from batchlens.operators.table_functions import diarizer, transcriber
from batchlens.operators.turns import speaker_turns
from batchlens.operators.weights import deal_by_weight
from batchlens.plans import captions as caption_flow
from batchlens.plans import content, partitions, speech, text_generation
from batchlens.sources import given, media as media_source, ranges, synthetic, versions
from batchlens.sources import tables
from batchlens.sources.csv_files import read_by_header
from batchlens.sources.scratch import new_folder
from oracle_queries import ORACLE

try:
    from batchlens.llm import queries as training_data
    import corpus_pipeline
except ModuleNotFoundError as missing:
    # The package is optional; an error inside it is not passed over.
    if not str(missing.name).startswith(("batchlens.llm", "corpus_pipeline")):
        raise
    training_data = None

SYSTEM = "Answer in one sentence."
# Larger media files are opened by path, and read in ranges of this size.
INLINE_BYTES = 4 << 20
RANGE_BYTES = 1 << 20
# Bytes of files that a model's task holds; larger files go through its disk. Where
# tasks cannot open files, Spark reads them, up to what a cell may hold.
CONTENT_BYTES = 64 << 20
CELL_BYTES = 1 << 30


def _rows_of(df: DataFrame, kept: list[str], array: Column, position: str) -> DataFrame:
    """One row per element ``_e`` of a computed array.

    The outer form, since before a plain explode Spark puts a filter on the
    array's size, which computes the array a second time.
    """
    rows = df.select(*kept, F.posexplode_outer(array).alias(position, "_e"))
    return rows.where(F.col(position).isNotNull())


def _llama_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return given.documents(spark, sf).select(
        "id", prompts.llama(F.lit(SYSTEM), F.col("text")).alias("text")
    )


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    return given.documents(spark, sf).select("id", synthetic.question(F.col("id")).alias("text"))


def _brief_chatml(spark: SparkSession, sf: str) -> DataFrame:
    ask = synthetic.question(
        F.col("id"), spell=synthetic.SPELL_BRIEFLY, define=synthetic.DEFINE_BRIEFLY
    )
    return given.documents(spark, sf).select(
        "id", prompts.chatml(F.lit(SYSTEM), ask).alias("text")
    )


def _generations(spark: SparkSession, sf: str) -> DataFrame:
    return text_generation.generations(_llama_prompts(spark, sf), backends.rule_text)


def q_prompt_synth(spark: SparkSession, sf: str) -> DataFrame:
    return _questions(spark, sf)


def q_prompt_llama(spark: SparkSession, sf: str) -> DataFrame:
    return _llama_prompts(spark, sf)


def q_prompt_mistral(spark: SparkSession, sf: str) -> DataFrame:
    return given.documents(spark, sf).select("id", prompts.mistral(F.col("text")).alias("text"))


def q_prompt_chatml(spark: SparkSession, sf: str) -> DataFrame:
    return given.documents(spark, sf).select(
        "id", prompts.chatml(F.lit(SYSTEM), F.col("text")).alias("text")
    )


def q_prompt_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_prompts(given.table(spark, sf, "conversations"))


def q_prompt_chat_parts(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_prompts(given.table(spark, sf, "conversations"), max_chars=200)


def q_partition_plan(spark: SparkSession, sf: str) -> DataFrame:
    plans = [
        partitions.partition_plan(given.documents(spark, sf), "text", partitions.TEXT_JOB),
        partitions.partition_plan(given.audio_files(spark, sf), "audio", partitions.AUDIO_JOB),
        partitions.partition_plan(given.products(spark, sf), "image", partitions.IMAGE_JOB),
    ]
    return chunks.union_chunks(plans)


def q_generate(spark: SparkSession, sf: str) -> DataFrame:
    return _generations(spark, sf)


def q_generate_questions(spark: SparkSession, sf: str) -> DataFrame:
    return text_generation.generations(
        _questions(spark, sf), backends.rule_text, backends.BATCH_SAMPLING
    )


def q_generate_chatml(spark: SparkSession, sf: str) -> DataFrame:
    return text_generation.generations(
        _brief_chatml(spark, sf), backends.rule_text, backends.LONG_SAMPLING
    )


def q_generations_scan(spark: SparkSession, sf: str) -> DataFrame:
    _generations(spark, sf).createOrReplaceTempView("generations")
    return spark.sql("SELECT * FROM generations")


def q_join_candidates(spark: SparkSession, sf: str) -> DataFrame:
    answered = models.candidates(
        _questions(spark, sf), "text", "candidates", backends.rule_text, backends.Sampling(n=2)
    )
    return answered.select("id", media.join_candidates(F.col("candidates")).alias("generated"))


def q_token_totals(spark: SparkSession, sf: str) -> DataFrame:
    return totals.token_totals(_generations(spark, sf))


def q_write_table(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "generations")
    tables.write_table(_generations(spark, sf), "batchlens_generations", "parquet", path)
    return spark.table("batchlens_generations")


def q_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    base = new_folder(spark, "versions")
    versions.replace_table(_generations(spark, sf).limit(0), "batchlens_versions", base=base)
    versions.replace_table(_generations(spark, sf), "batchlens_versions", base=base)
    return spark.table("batchlens_versions")


def q_batch_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions of nearly equal characters: none has more than its share and a row."""
    docs, n = given.documents(spark, sf), partitions.TEXT_JOB.workers * 4
    dealt = deal_by_weight(docs, "id", F.length("text"), n)
    bounds = docs.agg((F.ceil(F.sum(F.length("text")) / n) + F.max(F.length("text"))).alias("bound"))
    report = totals.batch_report(dealt).agg(
        F.count(F.lit(1)).alias("n_partitions"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("chars").alias("chars"),
        F.max("chars").alias("most"),
    )
    # A row on either side.
    both = report.join(F.broadcast(bounds))
    return both.select("n_partitions", "n_rows", "chars", (F.col("most") <= F.col("bound")).alias("even"))


def q_batch_report(spark: SparkSession, sf: str) -> DataFrame:
    size = partitions.TEXT_JOB
    dealt = partitions.spread(given.documents(spark, sf), size)
    # Round robin starts anew for each input partition, so a partition may get a
    # row more or less from each.
    even = F.max("n_rows") <= size.rows_per_task + spark.sparkContext.defaultParallelism
    return totals.batch_report(dealt).agg(
        F.count(F.lit(1)).alias("n_partitions"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("chars").alias("chars"),
        even.alias("even"),
    )


def q_chunk_plan(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.number_chunks_by_key(given.documents(spark, sf).select("id"), "id")


def q_union_chunks(spark: SparkSession, sf: str) -> DataFrame:
    def scored(piece: str, rows: DataFrame) -> DataFrame:
        answered = models.generate(
            rows, "text", "generated", backends.rule_text, backends.BATCH_SAMPLING
        )
        return answered.select(F.lit(piece).alias("piece"), "id", "generated")

    return chunks.union_chunks(
        [
            scored("documents", given.documents(spark, sf)),
            scored("benchmark", given.benchmark(spark, sf)),
        ]
    )


def _per_file(run: Callable[..., DataFrame], spark: SparkSession, sf: str) -> DataFrame:
    def dealt(long: LongKeys | None, events: DataFrame) -> DataFrame:
        # Long files go by blocks, which are dealt out by ranges.
        return run(long, events if long else deal_by_key(events, ["file_ids"]))

    events = given.events(spark, sf)
    return by_length(find_long_keys(events, ["file_ids"]), dealt, events)


def _turns(long: LongKeys | None, events: DataFrame) -> DataFrame:
    return speaker_turns(given.segments(events), long=long)


def _aligned(long: LongKeys | None, events: DataFrame) -> DataFrame:
    chunk_rows = given.chunks(events, long)
    return align_chunks(_turns(long, events), chunk_rows, long=long, ends_ascend=True)


def _aligned_turns(long: LongKeys | None, events: DataFrame) -> DataFrame:
    return align_turns(_aligned(long, events), long=long)


def q_speaker_turns(spark: SparkSession, sf: str) -> DataFrame:
    return _per_file(_turns, spark, sf)


def q_align_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _per_file(_aligned, spark, sf)


def _aligned_any_order(long: LongKeys | None, events: DataFrame) -> DataFrame:
    # Uncut speaking times overlap now and then, so that chunk ends may fall.
    chunk_rows = given.chunks(events, long, cut_short=False)
    return align_chunks(_turns(long, events), chunk_rows, long=long)


def q_align_any_order(spark: SparkSession, sf: str) -> DataFrame:
    return _per_file(_aligned_any_order, spark, sf)


def q_align_turns(spark: SparkSession, sf: str) -> DataFrame:
    return _per_file(_aligned_turns, spark, sf)


def _chunk_rows(heard: DataFrame) -> DataFrame:
    return _rows_of(heard, ["file_ids"], F.col("transcription"), "chunk").select(
        "file_ids",
        "chunk",
        F.col("_e.text").alias("text"),
        F.get("_e.timestamp", F.lit(0)).alias("start"),
        F.get("_e.timestamp", F.lit(1)).alias("end"),
    )


def _segment_rows(raw: DataFrame) -> DataFrame:
    return _rows_of(raw, ["file_ids"], F.col("segments"), "position").select(
        "file_ids",
        "position",
        F.col("_e.segment.start").alias("start"),
        F.col("_e.segment.end").alias("end"),
        F.col("_e.track").alias("track"),
        F.col("_e.label").alias("label"),
    )


def _transcripts(spoken: DataFrame) -> DataFrame:
    return speech.transcriptions(spoken, "script", backends.script_reader()).drop("script")


def _diarizations(overheard: DataFrame) -> DataFrame:
    speakers = backends.script_speakers("<")
    return speech.diarizations(overheard, "script", speakers).drop("script")


def q_transcribe(spark: SparkSession, sf: str) -> DataFrame:
    return _chunk_rows(_transcripts(given.spoken(spark, sf)))


def q_transcribe_windows(spark: SparkSession, sf: str) -> DataFrame:
    options = backends.Recognition(window_seconds=5)
    spoken = given.spoken(spark, sf)
    return _chunk_rows(
        speech.transcriptions(spoken, "script", backends.windowed_reader, options)
    )


def q_diarize(spark: SparkSession, sf: str) -> DataFrame:
    raw = models.diarize(
        given.overheard(spark, sf), "script", backends.script_speakers("<")
    )
    return _segment_rows(raw)


def q_transcribe_function(spark: SparkSession, sf: str) -> DataFrame:
    spark.udtf.register("transcribed", transcriber(backends.script_reader()))
    spoken = partitions.spread(given.spoken(spark, sf), partitions.AUDIO_JOB)
    spoken.createOrReplaceTempView("spoken")
    return spark.sql("SELECT file_ids, chunk, text, start, `end` FROM transcribed(TABLE(spoken))")


def q_diarize_function(spark: SparkSession, sf: str) -> DataFrame:
    speakers = diarizer(backends.script_speakers("<"))
    return speakers(given.overheard(spark, sf).asTable())


def q_diarize_bounds(spark: SparkSession, sf: str) -> DataFrame:
    bounds = backends.Speakers(at_least=2, at_most=3)
    speakers = backends.script_speakers("<")
    return _segment_rows(
        models.diarize(given.overheard(spark, sf), "script", speakers, bounds)
    )


def _turn_rows(df: DataFrame) -> DataFrame:
    return _rows_of(df, ["file_ids"], F.col("diarization"), "turn").select(
        "file_ids",
        "turn",
        F.col("_e.speaker").alias("speaker"),
        F.col("_e.segment.start").alias("start"),
        F.col("_e.segment.end").alias("end"),
    )


def q_diarize_turns(spark: SparkSession, sf: str) -> DataFrame:
    return _turn_rows(_diarizations(given.overheard(spark, sf)))


def q_turns_json(spark: SparkSession, sf: str) -> DataFrame:
    return _diarizations(given.overheard(spark, sf)).select(
        "file_ids", media.to_text(F.col("diarization")).alias("diarization")
    )


def q_parse_media_json(spark: SparkSession, sf: str) -> DataFrame:
    text = q_turns_json(spark, sf)
    return _turn_rows(
        text.select("file_ids", media.turns_from_text(F.col("diarization")).alias("diarization"))
    )


def q_parse_media_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Turns from text with two bad elements in every third file and every third broken."""
    bad = '[7,{"speaker":"x","segment":{"start":"soon","end":1.0}}'
    text, rest = F.col("diarization"), F.pmod("file_ids", F.lit(3))
    planted = F.when(text == "[]", F.lit(bad + "]")).otherwise(
        F.concat(F.lit(bad + ","), F.expr("substr(diarization, 2)"))
    )
    damaged = F.when(rest == 0, planted).when(rest == 1, F.concat(F.lit("{"), text)).otherwise(text)
    files = q_turns_json(spark, sf).select("file_ids", damaged.alias("diarization"))
    return variants.turns_from_variant(files, "file_ids", "diarization")


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    spoken, overheard = given.spoken(spark, sf), given.overheard(spark, sf)
    return join_media(
        given.audio_files(spark, sf),
        _transcripts(spoken),
        _diarizations(overheard),
        long_transcription=find_long_keys(spoken, ["file_ids"]),
        long_diarization=find_long_keys(overheard, ["file_ids"]),
    )


def q_media_join(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf).select(
        "file_ids",
        "file_name",
        "file_path",
        F.when(F.col("transcription").isNotNull(), F.size("transcription")).alias("n_chunks"),
        F.when(F.col("diarization").isNotNull(), F.size("diarization")).alias("n_turns"),
    )


def _sql_views(spark: SparkSession, sf: str) -> None:
    sql_functions.register(spark)
    given.audio_files(spark, sf).createOrReplaceTempView("audio_files")
    _transcripts(given.spoken(spark, sf)).createOrReplaceTempView("transcriptions")
    _diarizations(given.overheard(spark, sf)).createOrReplaceTempView("diarizations")


def q_sql_prompts(spark: SparkSession, sf: str) -> DataFrame:
    sql_functions.register(spark)
    given.documents(spark, sf).createOrReplaceTempView("asked")
    return spark.sql(
        f"""SELECT id, llama_prompt('{SYSTEM}', text) AS llama, mistral_prompt(text) AS mistral,
                   chatml_prompt('{SYSTEM}', text) AS chatml FROM asked"""
    )


def q_sql_token_totals(spark: SparkSession, sf: str) -> DataFrame:
    sql_functions.register(spark)
    _generations(spark, sf).createOrReplaceTempView("generations")
    return spark.sql(
        """SELECT n_tokens(sum(length(text))) AS input_tokens,
                  n_tokens(sum(length(generated))) AS output_tokens, count(*) AS total_ct
           FROM generations"""
    )


def q_sql_media_join(spark: SparkSession, sf: str) -> DataFrame:
    _sql_views(spark, sf)
    return spark.sql(
        """SELECT f.file_ids, f.file_name, f.file_path,
                  CASE WHEN t.transcription IS NOT NULL THEN size(t.transcription) END AS n_chunks,
                  CASE WHEN d.diarization IS NOT NULL THEN size(d.diarization) END AS n_turns
           FROM audio_files f
           LEFT JOIN transcriptions t ON t.file_ids = f.file_ids
           LEFT JOIN diarizations d ON d.file_ids = f.file_ids"""
    )


def q_sql_media_final_turns(spark: SparkSession, sf: str) -> DataFrame:
    _sql_views(spark, sf)
    return spark.sql(
        """SELECT file_ids, position, m.speaker, m.text, get(m.timestamp, 0) AS start, get(m.timestamp, 1) AS `end`
           FROM (SELECT f.file_ids, align_by_turn(t.transcription, d.diarization) AS merged
                 FROM audio_files f
                 JOIN transcriptions t ON t.file_ids = f.file_ids
                 JOIN diarizations d ON d.file_ids = f.file_ids)
           LATERAL VIEW posexplode(merged) AS position, m"""
    )


def q_media_final(spark: SparkSession, sf: str) -> DataFrame:
    return speech.attributed(_joined(spark, sf)).select(
        "file_ids",
        "file_name",
        F.posexplode_outer("mergedTranscriptionDiarization").alias("position", "m"),
    ).select(
        "file_ids",
        "file_name",
        "position",
        F.col("m.speaker").alias("speaker"),
        F.col("m.text").alias("text"),
        F.get("m.timestamp", F.lit(0)).alias("start"),
        F.get("m.timestamp", F.lit(1)).alias("end"),
    )


def q_media_final_turns(spark: SparkSession, sf: str) -> DataFrame:
    merged = media.align_by_turn(F.col("transcription"), F.col("diarization"))
    return _rows_of(_joined(spark, sf), ["file_ids"], merged, "position").select(
        "file_ids",
        "position",
        F.col("_e.speaker").alias("speaker"),
        F.col("_e.text").alias("text"),
        F.get("_e.timestamp", F.lit(0)).alias("start"),
        F.get("_e.timestamp", F.lit(1)).alias("end"),
    )


def q_media_path(spark: SparkSession, sf: str) -> DataFrame:
    return given.products(spark, sf).select("product_id", "file_path")


def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["product_id", "Category", "Gender", "Image"]
    path = new_folder(spark, "products-csv")
    products = given.products(spark, sf).select(columns)
    products.write.mode("overwrite").option("header", True).csv(path)
    return tables.read_products(spark, path, columns)


def q_csv_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """Files with their columns in two orders, one with a column more."""
    path = new_folder(spark, "products-csv")
    products = given.products(spark, sf)
    odd = F.col("product_id") % 2 == 1
    one = products.where(odd).select("Image", "product_id", "Gender", "Category")
    two = products.where(~odd).select("Category", "file_path", "Gender", "product_id", "Image")
    for part in (one, two):
        part.write.mode("append").option("header", True).csv(path)
    rows, _ = read_by_header(spark, path, ["product_id", "Category", "Gender", "Image"])
    return rows


def q_bounded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return tables.bounded(given.products(spark, sf), "product_id", 1000)


def q_caption(spark: SparkSession, sf: str) -> DataFrame:
    return caption_flow.captions(given.products(spark, sf), backends.path_caption)


def q_media_scan(spark: SparkSession, sf: str) -> DataFrame:
    files = media_source.media_files(spark, sf, "*.parquet", max_inline_bytes=INLINE_BYTES)
    return media_source.file_ends(files).select(
        "file_name",
        (F.col("n_bytes") == F.col("length")).alias("whole"),
        F.col("head").cast("string").alias("opens_with"),
        F.col("tail").cast("string").alias("closes_with"),
    )


def q_media_ranges(spark: SparkSession, sf: str) -> DataFrame:
    files = ranges.media_ranges(spark, sf, "*.parquet", RANGE_BYTES)
    return ranges.file_sums(files).select(
        "file_name",
        (F.col("n_bytes") == F.col("length")).alias("whole"),
        F.col("head").cast("string").alias("opens_with"),
        F.col("tail").cast("string").alias("closes_with"),
    )


def q_media_content(spark: SparkSession, sf: str) -> DataFrame:
    """What a model makes of the content of the given tables' files, whole and of any
    size; a table that is a folder of files gets their sum."""

    def files(bound: int | None) -> DataFrame:
        found = media_source.media_files(spark, sf, "*.parquet", max_inline_bytes=bound, nested=True)
        return media_source.with_entries(found, sf).where(F.col("entry_name").endswith(".parquet"))

    scored = content.content_scores(
        files(None).select("entry_path", "entry_name", "file_path"),
        files(None if media_source.openable(spark, sf) else CELL_BYTES),
        backends.table_rows, None, "bigint", "n_rows", memory_bytes=CONTENT_BYTES,
    )
    # A part of a table's rows is not given out as all of them.
    whole = F.when(F.count("n_rows") == F.count(F.lit(1)), F.sum("n_rows"))
    counted = scored.groupBy("entry_path", "entry_name").agg(whole.alias("n_rows"))
    return counted.select(F.col("entry_name").alias("file_name"), "n_rows")


def q_audio_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Waveforms in rows of 20 samples, prepared as if each were one row."""
    n = 20
    at = F.sequence(F.lit(0), F.greatest(F.size("samples") - 1, F.lit(0)), F.lit(n))
    waves = given.waveforms(spark, sf)
    rows = waves.select("file_ids", "sampling_rate", "samples", F.explode(at).alias("first_sample")).withColumn(
        "samples", F.slice("samples", F.col("first_sample") + 1, F.lit(n))
    )
    ready = audio.prepare_rows(rows)
    kept = ["file_ids", "sampling_rate", "first_sample"]
    return _rows_of(ready, kept, F.col("samples"), "j").select(
        "file_ids",
        "sampling_rate",
        (F.col("first_sample") + F.col("j")).cast("int").alias("j"),
        F.round(F.col("_e") * 32767).cast("long").alias("level"),
    )


def q_audio_prepare(spark: SparkSession, sf: str) -> DataFrame:
    ready = audio.prepare_blocks(given.waveforms(spark, sf))
    kept = ["file_ids", "sampling_rate", "first_sample"]
    return _rows_of(ready, kept, F.col("samples"), "j").select(
        "file_ids",
        "sampling_rate",
        (F.col("first_sample") + F.col("j")).cast("int").alias("j"),
        F.round(F.col("_e") * 32767).cast("long").alias("level"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Documents to prompts, answered on planned partitions, and totalled."""
    return q_token_totals(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name[2:]: q for name, q in globals().items() if name.startswith("q_")}
    if training_data is not None:
        found |= training_data.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE)
    if training_data is not None:
        found |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
