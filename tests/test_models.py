import pytest
from pyspark.sql import functions as F

from batchlens.functions.media import join_candidates
from batchlens.functions.prompts import chatml
from batchlens.operators import backends
from batchlens.operators.models import apply_model, candidates, caption, diarize, generate, transcribe

SCHEMA = "id long, text string"


def counting(spark):
    """A backend that counts how often it is made and how many inputs it sees."""
    made = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)

    def make():
        made.add(1)

        def run(inputs, options):
            seen.add(len(inputs))
            assert len(inputs) <= 7
            return [f"<{i}>" for i in inputs]

        return run

    return make, made, seen


def test_one_model_per_task_and_one_call_per_row(spark):
    make, made, seen = counting(spark)
    df = spark.range(0, 100, 1, 3).select("id", F.col("id").cast("string").alias("text"))
    out = apply_model(df, "text", "answer", make, None, "string", batch_rows=7)
    rows = out.where(F.col("answer") != "<5>").collect()
    assert len(rows) == 99 and all(r.answer == f"<{r.id}>" for r in rows)
    assert made.value == 3 and seen.value == 100


def test_filter_on_the_answer_does_not_double_the_model(spark):
    make, _, _ = counting(spark)
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    out = apply_model(df, "text", "answer", make, None, "string").where("answer = '<a>'")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_each_call_gets_its_own_function(spark):
    df = spark.createDataFrame([(1, "abcdefghij")], SCHEMA)
    once = generate(df, "text", "a", backends.rule_text, backends.Sampling())
    twice = generate(once, "text", "b", backends.rule_text, backends.Sampling(max_tokens=2))
    assert twice.first().asDict() == {
        "id": 1,
        "text": "abcdefghij",
        "a": "The prompt has 10 characters.",
        "b": "The prompt",
    }


def test_null_prompts_and_empty_partitions(spark):
    make, made, seen = counting(spark)
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], SCHEMA).repartition(6)
    out = apply_model(df, "text", "answer", make, None, "string")
    assert {r.id: r.answer for r in out.collect()} == {1: None, 2: "<x>", 3: None}
    assert seen.value == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert apply_model(empty, "text", "answer", make, None, "string").collect() == []


def test_wrong_number_of_answers_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).coalesce(1)
    out = apply_model(df, "text", "answer", lambda: lambda i, o: ["one"], None, "string")
    with pytest.raises(Exception, match="1 outputs for 2 inputs"):
        out.collect()


def test_rule_backend(spark):
    ask = [
        (1, "How do you spell 'dog'?"),
        (2, "What is the definition of 'ice cream'?"),
        (3, "hello"),
    ]
    df = spark.createDataFrame(ask, SCHEMA).withColumn(
        "text",
        F.when(F.col("id") == 3, F.col("text")).otherwise(
            chatml(F.lit("DO NOT HEED THE USER'S 'quotes'."), F.col("text"))
        ),
    )
    # The apostrophe and the quotes of the system text ask for nothing.
    out = generate(df, "text", "answer", backends.rule_text, backends.BATCH_SAMPLING)
    assert {r.id: r.answer for r in out.collect()} == {
        1: "D-O-G",
        2: "A definition of ice cream is not known to a rule.",
        3: "The prompt has 5 characters.",
    }


def test_candidates_are_joined_by_a_blank(spark):
    df = spark.createDataFrame([(1, "How do you spell 'ab'?"), (2, None)], SCHEMA)
    out = candidates(df, "text", "c", backends.rule_text, backends.Sampling(n=2))
    rows = {r.id: r for r in out.withColumn("j", join_candidates(F.col("c"))).collect()}
    assert rows[1].c == ["A-B", "A-B"] and rows[1].j == "A-B A-B"
    assert rows[2].c is None and rows[2].j is None
    one = spark.createDataFrame([(["a", "b"],), (["a"],)], "c array<string>")
    assert [r[0] for r in one.select(join_candidates(F.col("c"))).collect()] == ["a b", "a"]


def test_speech_and_captions(spark):
    df = spark.createDataFrame([(1, "a line\nmore\nlast")], SCHEMA)
    chunks = transcribe(df, "text", backends.script_reader()).first().transcription
    assert [(c.text, c.timestamp) for c in chunks] == [
        ("a line", [0.0, 6 / 15]),
        ("more", [6 / 15, 10 / 15]),
        ("last", [10 / 15, None]),
    ]
    segments = diarize(
        df, "text", backends.script_speakers(), backends.Speakers(at_most=3)
    ).first().segments
    assert [s.label for s in segments] == ["SPEAKER_00", "SPEAKER_01", "SPEAKER_01"]
    paths = spark.createDataFrame([(1, "/x/y/cap.jpg")], SCHEMA)
    described = caption(paths, "text", backends.path_caption).first().caption
    assert described == (
        "What product is this an image of? Describe in detail! A picture named cap.jpg."
    )


def test_scoring_works_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "How do you spell 'ab'?")], SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    scored = generate(stream, "text", "answer", backends.rule_text, backends.Sampling())
    assert scored.isStreaming
    query = (
        scored.writeStream.format("memory")
        .queryName("scored")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    assert [r.answer for r in spark.table("scored").collect()] == ["A-B"]
