import random

from pyspark.sql import functions as F

from batchlens.functions import media, prompts, sql, variants


def test_functions_equal_columns(spark):
    sql.register(spark)
    rng = random.Random(5)
    rows = [(None, None, None)]
    for n in range(40):
        ends = [rng.choice([1.0, 2.5, 2.5, 4.0, 0.1 + 0.2, 7.25, None]) for _ in range(rng.randint(0, 9))]
        cells = [{"text": f" w{i}", "timestamp": [float(i), e]} for i, e in enumerate(ends)]
        turns = [{"segment": {"start": 0.0, "end": rng.choice([0.3, 1.75, 3.25, 5.0])}, "speaker": f"s{i}"} for i in range(rng.randint(0, 6))]
        rows.append((f"it's {n}\n\\", cells, turns))
    df = spark.createDataFrame(rows, f"text string, chunks {media.CHUNKS}, turns {media.TURNS}")
    df.createOrReplaceTempView("cells")
    by_sql = spark.sql(
        """SELECT llama_prompt('be brief', text) AS a, mistral_prompt(text) AS b, chatml_prompt('be brief', text) AS c,
                  n_tokens(length(text)) AS d, join_candidates(array(text, 'x')) AS e, align_by_turn(chunks, turns) AS f
           FROM cells"""
    )
    text, system = F.col("text"), F.lit("be brief")
    by_column = df.select(
        prompts.llama(system, text), prompts.mistral(text), prompts.chatml(system, text), F.length(text) / 4,
        media.join_candidates(F.array(text, F.lit("x"))), media.align_by_turn(F.col("chunks"), F.col("turns")),
    )
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in by_column.collect()]


def test_alignment_is_computed_once_and_searches(spark):
    sql.register(spark)
    rng = random.Random(6)
    rows = []
    for n in range(6):
        ends = sorted(rng.choice([rng.uniform(0, 90), float(rng.randint(0, 90))]) for _ in range(600))
        cells = [{"text": f" w{i}", "timestamp": [0.0, e]} for i, e in enumerate(ends)]
        turns = [{"segment": {"start": 0.0, "end": rng.uniform(0, 90)}, "speaker": f"s{i}"} for i in range(280 + n)]
        rows.append((n, cells, turns))
    df = spark.createDataFrame(rows, f"n int, chunks {media.CHUNKS}, turns {media.TURNS}")
    df.createOrReplaceTempView("long_cells")
    found = spark.sql("SELECT n, f FROM (SELECT n, align_by_turn(chunks, turns) AS f FROM long_cells) WHERE size(f) > 0")
    # Where a filter takes the alignment in, the ends of the turns are read once, not in each step.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    (condition,) = [line for line in plan.splitlines() if "Filter" in line]
    assert condition.count("segment.end") == 1
    expected = df.select("n", media.align_by_turn(F.col("chunks"), F.col("turns")))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    # Ends and times for which a search and a look at every chunk would differ.
    nan, inf = float("nan"), float("inf")
    odd = spark.sql(
        f"""SELECT turn_cuts(array(1D, 2D, 3D), array(double('{inf}'))),
                   turn_cuts(array(1D, 2D, 3D), array(double('{nan}'))), turn_cuts(array(1D, NULL), array(0.5D))"""
    )
    assert tuple(odd.first()) == ([0], [0], [1])


def test_bad_elements_stand_for_themselves(spark):
    good = '{"speaker":"a","segment":{"start":0.5,"end":1.0E1}}'
    rows = [
        (1, f'[{good},7,null,{{"speaker":"b"}},{good}]'),
        (2, "[]"), (3, None), (4, "{"), (5, '{"segment":[]}'), (6, ""), (7, '[{"segment":{"start":"soon","end":2}}]'),
        (None, f"[{good}]"), (None, f"[{good}]"),
    ]
    df = spark.createDataFrame(rows, "pos int, value string").withColumn("__list", F.lit(1))
    found = [tuple(r) for r in variants.turns_from_variant(df, "pos", "value").collect()]
    sound = ("a", 0.5, 10.0, None)
    expected = [
        (1, 0, *sound), (1, 1, None, None, None, "element"), (1, 2, None, None, None, "element"),
        (1, 3, "b", None, None, "element"), (1, 4, *sound),
        (4, None, None, None, None, "text"), (5, None, None, None, None, "text"), (6, None, None, None, None, "text"),
        (7, 0, None, None, 2.0, "element"), (None, 0, *sound), (None, 0, *sound),
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
