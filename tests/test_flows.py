"""The three flows from input table to output table."""

import pytest
from pyspark.sql import functions as F

from batchlens.functions.media import to_text
from batchlens.operators import backends
from batchlens.plans import captions, speech, text_generation
from batchlens.plans.partitions import JobSize
from batchlens.sources.synthetic import synthetic_prompts
from batchlens.sources.tables import AUDIO_FILES, write_table

import rules


def test_prompts_to_totals(spark):
    prompts = synthetic_prompts(spark, 300)
    totals = text_generation.generate_table(prompts, "flow_generations", backends.rule_text).first()
    rows = spark.table("flow_generations").collect()
    assert totals.total_ct == len(rows) == 300
    assert totals.input_tokens == sum(len(r.text) for r in rows) / 4
    assert totals.output_tokens == sum(len(r.generated) for r in rows) / 4
    where_they_lie = text_generation.generations(prompts, backends.rule_text, size=None)
    assert sorted(where_they_lie.collect()) == sorted(rows)


@pytest.mark.parametrize("as_text", [False, True])
def test_speech_to_attributed_transcripts(spark, as_text):
    scripts = {
        1: "hello there\nyes\nwell then\nbye",
        2: "one\ntwo\nsix\nfour",
        3: "never diarized",
    }
    files = spark.createDataFrame(
        [(f"/a/{i}.mp3", f"{i}.mp3", i) for i in [*scripts, 4]], AUDIO_FILES
    )
    said = spark.createDataFrame(list(scripts.items()), "file_ids long, script string")
    write_table(files, "flow_files")
    heard = speech.transcriptions(said, "script", backends.script_reader())
    voices = speech.diarizations(
        said.where("file_ids < 3"), "script", backends.script_speakers(" "), backends.Speakers(at_most=2)
    )
    if as_text:
        heard = heard.withColumn("transcription", to_text(F.col("transcription")))
        voices = voices.withColumn("diarization", to_text(F.col("diarization")))
    write_table(heard, "flow_heard")
    write_table(voices, "flow_voices")
    speech.merge_tables(spark, "flow_files", "flow_heard", "flow_voices", "flow_final")
    final = {r.file_ids: r for r in spark.table("flow_final").collect()}
    assert set(final) == {1, 2, 3, 4}
    assert final[3].mergedTranscriptionDiarization is None
    assert final[4].mergedTranscriptionDiarization is None
    for f in (1, 2):
        def timed(separator):
            return backends._timed(scripts[f], separator)

        chunks = timed("\n")
        turns = rules.turns_of([(a, b, len(t) % 2) for t, a, b in timed(" ")])
        ends = [b for _, _, b in chunks[:-1]] + [None]
        expected = [
            (f"SPEAKER_0{turns[k][0]}", chunks[i][0])
            for i, k in rules.align([t[2] for t in turns], ends)
        ]
        merged = final[f].mergedTranscriptionDiarization
        assert [(m.speaker, m.text) for m in merged] == expected


def test_pictures_to_captions(spark):
    pictures = spark.range(70).select("id", F.concat(F.lit("/p/"), "id", F.lit(".jpg")).alias("file_path"))
    all_of_them = captions.captions(pictures, backends.path_caption, size=JobSize(1, 32))
    assert all_of_them.where("caption LIKE '%picture named%'").count() == 70
    some = captions.captions(pictures, backends.path_caption, key="id", rows=5).collect()
    assert sorted(r.id for r in some) == [0, 1, 2, 3, 4]
