import tracemalloc

import pytest
from pyspark.sql import functions as F

from batchlens.operators import backends, models
from batchlens.operators.table_functions import ROWS_OUT, diarizer, scored_rows, transcriber

SCRIPTS = [(1, "a\nbc\n\nd"), (2, None), (3, ""), (1, "a\nbc\n\nd"), (None, "x<y<"), (4, "one " * 500)]


@pytest.fixture(scope="module")
def files(spark):
    rows = [(7, *r, 0.5) for r in SCRIPTS]
    # Columns that clash with those of the result.
    return spark.createDataFrame(rows, "chunk int, file_ids bigint, script string, start double").repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_transcriber_gives_the_rows_of_the_nested_cell(spark, files):
    spark.udtf.register("transcribed", transcriber(backends.script_reader()))
    files.createOrReplaceTempView("files")
    found = spark.sql("SELECT file_ids, chunk, text, start, `end` FROM transcribed(TABLE(files))")
    cells = models.transcribe(files, "script", backends.script_reader())
    nested = cells.select("file_ids", F.posexplode("transcription").alias("chunk", "c")).select(
        "file_ids", "chunk", "c.text", F.get("c.timestamp", F.lit(0)), F.get("c.timestamp", F.lit(1))
    )
    assert rows(found) == rows(nested)


def test_diarizer_gives_the_rows_of_the_nested_cell(spark, files):
    bounds = backends.Speakers(at_least=2, at_most=3)
    found = diarizer(backends.script_speakers("<"), bounds)(files.asTable())
    cells = models.diarize(files, "script", backends.script_speakers("<"), bounds)
    nested = cells.select("file_ids", F.posexplode("segments").alias("position", "s")).select(
        "file_ids", "position", "s.segment.start", "s.segment.end", "s.track", "s.label"
    )
    assert rows(found) == rows(nested)


def test_empty_table_and_text_keys(spark):
    none = spark.createDataFrame([], "name string, heard string")
    found = transcriber(backends.script_reader(), key="name", key_type="string", input_col="heard")
    assert found(none.asTable()).collect() == []
    one = spark.createDataFrame([("f", "hello")], none.schema)
    assert [tuple(r)[:3] for r in found(one.asTable()).collect()] == [("f", 0, "hello")]


def test_long_recording_goes_by_in_pieces(spark):
    chunks = 1_000_000

    def endless():
        def run(inputs, options):
            return [({"text": "w", "timestamp": [i, i + 1.0]} for i in range(chunks)) if x else None for x in inputs]

        return run

    def heard(function):
        table = spark.createDataFrame([(1, "x"), (2, "")], "file_ids bigint, script string")
        return function(table.coalesce(1).asTable())

    out = heard(transcriber(endless)).groupBy("file_ids").agg(F.count("*"), F.max("chunk"), F.sum("end"))
    assert rows(out) == [(1, chunks, chunks - 1, chunks * (chunks + 1) / 2)]

    def traced(element):
        if element == 0:
            tracemalloc.start()
        return (tracemalloc.get_traced_memory()[1] if element % ROWS_OUT == 0 else 0,)

    numbers = lambda: lambda inputs, options: [iter(range(200_000)) for _ in inputs]
    function = scored_rows(numbers, None, "file_ids bigint, position int, peak bigint", traced)
    assert heard(function).where("file_ids = 1").agg(F.max("peak")).first()[0] < 400 * ROWS_OUT


def test_wrong_number_of_outputs(spark):
    short = transcriber(lambda: lambda inputs, options: [])
    with pytest.raises(Exception, match="0 outputs for 1 inputs"):
        short(spark.createDataFrame([(1, "x")], "file_ids bigint, script string").asTable()).collect()
