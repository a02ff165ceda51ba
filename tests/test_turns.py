import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchlens.functions.media import SEGMENTS, turns_of
from batchlens.operators.ordered import by_length, find_long_keys
from batchlens.operators.turns import speaker_turns

import rules

CASES = {
    "runs": (
        [(0.0, 1.0, "A"), (1.0, 1.5, "A"), (1.7, 3.0, "B"), (2.9, 4.0, "A")],
        [("A", 0.0, 1.7), ("B", 1.7, 2.9), ("A", 2.9, 4.0)],
    ),
    "last end": ([(0.0, 9.0, "A"), (1.0, 2.0, "A")], [("A", 0.0, 2.0)]),
    "one": ([(0.5, 1.0, "A")], [("A", 0.5, 1.0)]),
    "no label": ([(0.0, 1.0, None), (1.0, 2.0, None), (2.0, 3.0, "B")], [(None, 0.0, 2.0), ("B", 2.0, 3.0)]),
}


def array_turns(spark, files):
    data = [
        (f, None if s is None else [((a, b), "T", c) for a, b, c in s]) for f, s in files.items()
    ]
    df = spark.createDataFrame(data, f"f long, segments {SEGMENTS}")
    out = df.select("f", turns_of(F.col("segments")).alias("turns")).collect()
    return {
        r.f: None
        if r.turns is None
        else [(t.speaker, t.segment.start, t.segment.end) for t in r.turns]
        for r in out
    }


def row_turns(spark, files, max_rows=None):
    data = [(f, i, a, b, c) for f, s in files.items() for i, (a, b, c) in enumerate(s)]
    df = spark.createDataFrame(
        data, "file_ids long, segment_id long, start double, end double, label string"
    )
    long = find_long_keys(df, ["file_ids"], max_rows) if max_rows else None
    out = by_length(
        long, lambda l, rows: speaker_turns(rows, order=("segment_id",), long=l), df
    ).collect()
    result = {}
    for r in sorted(out, key=lambda r: (r.file_ids, r.turn)):
        mine = result.setdefault(r.file_ids, [])
        assert r.turn == len(mine)
        mine.append((r.speaker, r.start, r.end))
    return result


@pytest.mark.parametrize("name", CASES)
def test_golden(spark, name):
    segments, turns = CASES[name]
    assert rules.turns_of(segments) == turns
    assert array_turns(spark, {1: segments}) == {1: turns}
    assert row_turns(spark, {1: segments}) == {1: turns}


def test_no_segments_and_null(spark):
    assert array_turns(spark, {1: [], 2: None}) == {1: [], 2: None}


segment = st.tuples(
    st.integers(0, 40).map(lambda x: x / 4), st.integers(0, 40).map(lambda x: x / 4), st.sampled_from("AB")
)
files = st.lists(st.lists(segment, min_size=1, max_size=12), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(files)
def test_against_the_sequential_rule(spark, many):
    data = dict(enumerate(many))
    expected = {f: rules.turns_of(s) for f, s in data.items()}
    assert array_turns(spark, data) == expected
    assert row_turns(spark, data) == expected


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(segment, min_size=30, max_size=80), files)
def test_long_files_in_blocks(spark, hot, many):
    data = {**dict(enumerate(many)), 1000: hot}
    expected = {f: rules.turns_of(s) for f, s in data.items()}
    assert row_turns(spark, data, max_rows=9) == expected


def test_short_files_take_one_shuffle(spark):
    df = spark.range(10).selectExpr(
        "id % 3 file_ids", "id segment_id", "id * 1D start", "id * 1D end", "'A' label"
    )
    plan = speaker_turns(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1
