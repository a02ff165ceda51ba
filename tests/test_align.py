import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchlens.functions.media import CHUNKS, TURNS, align, align_by_turn
from batchlens.operators.align import align_chunks, align_turns
from batchlens.operators.ordered import by_length, find_long_keys

import rules

# turn ends, chunk ends, expected (chunk, turn)
CASES = {
    "dropped tail": ([1.0], [1.0, 2.0], [(0, 0)]),
    "one each": ([1.0, 1.1, 1.2], [1.0, 5.0, 9.0], [(0, 0), (1, 1), (2, 2)]),
    "exhausted": ([9.0, 10.0], [1.0, 9.0], [(0, 0), (1, 0)]),
    "tie": ([2.0], [1.5, 2.5], [(0, 0)]),
    "unsorted": ([1.0, 3.0], [3.0, 1.0, 2.0], [(0, 0), (1, 0), (2, 1)]),
    "equal ends": ([2.0, 2.0], [2.0, 2.0, 2.0], [(0, 0), (1, 1)]),
    "open end": ([1.0, 9.0], [1.0, None], [(0, 0), (1, 1)]),
    "all open": ([1.0, 9.0], [None, None, None], [(0, 0), (1, 1)]),
    "tie of rounded distances": ([1e9], [1e-9, 2e-9, 3e-9], [(0, 0), (1, 0), (2, 0)]),
    "the same, unsorted": ([1e9], [1e-9, 3e-9, 2e-9], [(0, 0), (1, 0)]),
    "no chunks": ([1.0], [], []),
    "no turns": ([], [1.0], []),
}


def by_arrays(spark, files):
    data = [
        (
            f,
            [(str(i), [0.0, e]) for i, e in enumerate(chunks)],
            [((0.0, e), str(k)) for k, e in enumerate(turns)],
        )
        for f, (turns, chunks) in files.items()
    ]
    df = spark.createDataFrame(data, f"f long, chunks {CHUNKS}, turns {TURNS}")
    out = df.select("f", align(F.col("chunks"), F.col("turns")).alias("a")).collect()
    return {r.f: [(int(c.text), int(c.speaker)) for c in r.a] for r in out}


def frames(spark, files):
    turns = spark.createDataFrame(
        [(f, k, str(k), float(e)) for f, (ts, _) in files.items() for k, e in enumerate(ts)],
        "file_ids long, turn long, speaker string, end double",
    )
    chunks = spark.createDataFrame(
        [
            (f, i, str(i), 0.0, e)
            for f, (_, cs) in files.items()
            for i, e in enumerate(cs)
        ],
        "file_ids long, chunk_id long, text string, start double, end double",
    )
    return turns, chunks


def by_rows(spark, files, max_rows=None, **options):
    turns, chunks = frames(spark, files)
    long = None
    if max_rows:
        keys = turns.select("file_ids").unionByName(chunks.select("file_ids"))
        long = find_long_keys(keys, ["file_ids"], max_rows)
        assert long is not None

    def run(long, turns, chunks):
        return align_chunks(turns, chunks, chunk_order=("chunk_id",), long=long, **options)

    out = by_length(long, run, turns, chunks)
    result = {f: [] for f in files}
    for r in out.collect():
        assert r.text == str(r.chunk) and r.speaker == str(r.turn)
        result[r.file_ids].append((r.chunk, r.turn))
    return {f: sorted(rows) for f, rows in result.items()}


def test_golden(spark):
    files = {n: (t, c) for n, (t, c, _) in enumerate(CASES.values())}
    expected = {n: e for n, (_, _, e) in enumerate(CASES.values())}
    assert {f: rules.align(*x) for f, x in files.items()} == expected
    assert by_arrays(spark, files) == expected
    assert by_rows(spark, files) == expected


def test_null_on_either_side(spark):
    df = spark.createDataFrame(
        [(None, [((0.0, 1.0), "A")]), ([("x", [0.0, 1.0])], None), ([], [((0.0, 1.0), "A")])],
        f"chunks {CHUNKS}, turns {TURNS}",
    )
    for merge in (align, align_by_turn):
        rows = df.select(merge(F.col("chunks"), F.col("turns")).alias("a")).collect()
        assert [r.a for r in rows] == [None, None, []]


def test_by_turn(spark):
    turns = [((0.0, 1.7), "A"), ((1.7, 2.9), "B"), ((2.9, 4.0), "A")]
    chunks = [
        (" Hi", [0.0, 1.0]),
        (" there", [1.0, 1.6]),
        (" yes", [1.7, 3.1]),
        (" ok", [3.1, None]),
    ]
    expected = [
        ("A", " Hi there", [0.0, 1.6]),
        ("B", " yes", [1.7, 3.1]),
        ("A", " ok", [3.1, None]),
    ]
    df = spark.createDataFrame([(chunks, turns)], f"chunks {CHUNKS}, turns {TURNS}")
    merged = df.select(align_by_turn(F.col("chunks"), F.col("turns")).alias("a")).first().a
    assert [(m.speaker, m.text, m.timestamp) for m in merged] == expected

    turn_rows = spark.createDataFrame(
        [(1, k, s, e) for k, ((_, e), s) in enumerate(turns)],
        "file_ids long, turn long, speaker string, end double",
    )
    chunk_rows = spark.createDataFrame(
        [(1, i, t, a, b) for i, (t, (a, b)) in enumerate(chunks)],
        "file_ids long, chunk_id long, text string, start double, end double",
    )
    out = align_turns(align_chunks(turn_rows, chunk_rows)).orderBy("turn").collect()
    assert [(r.speaker, r.text, [r.start, r.end]) for r in out] == expected


def random_files(seed, n, ascending, longest=14):
    rng = random.Random(seed)

    def ends(size):
        return [rng.randrange(60) / 4 for _ in range(size)]

    files = {}
    for f in range(n):
        chunks, turns = ends(rng.randint(0, longest)), ends(rng.randint(0, longest))
        if ascending:
            chunks.sort()
        if rng.random() < 0.7:
            turns.sort()
        if chunks and rng.random() < 0.4:
            chunks[-1] = None
        files[f] = (turns, chunks)
    return files


@pytest.mark.parametrize("ascending", [True, False])
def test_against_the_sequential_rule(spark, ascending):
    files = random_files(5, 1500, ascending)
    expected = {f: rules.align(*x) for f, x in files.items()}
    assert by_arrays(spark, files) == expected
    assert by_rows(spark, files, ends_ascend=True if ascending else None) == expected


def test_unsorted_files_too_large_to_walk_through(spark, monkeypatch):
    from batchlens.operators import align_unsorted

    monkeypatch.setattr(align_unsorted, "FOLD_ROWS", 6)
    files = random_files(21, 400, False)
    assert by_rows(spark, files) == {f: rules.align(*x) for f, x in files.items()}


times = st.lists(st.integers(0, 30).map(lambda x: x / 4), max_size=10)
open_times = st.tuples(times, st.booleans()).map(lambda t: t[0] + [None] * t[1])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(times, open_times, st.booleans()), min_size=20, max_size=60))
def test_any_files_against_the_sequential_rule(spark, many):
    files = {
        f: (t, sorted(c, key=lambda e: (e is None, e)) if ascending else c)
        for f, (t, c, ascending) in enumerate(many)
    }
    assert by_arrays(spark, files) == {f: rules.align(*x) for f, x in files.items()}


def test_sorted_and_unsorted_files_together(spark):
    files = random_files(1, 60, True) | {
        f + 100: x for f, x in random_files(2, 60, False).items()
    }
    assert by_rows(spark, files) == {f: rules.align(*x) for f, x in files.items()}


@pytest.mark.parametrize("ascending", [True, False])
def test_long_files_in_blocks(spark, ascending):
    files = random_files(7, 10, ascending)
    files[99] = random_files(8, 1, ascending, longest=0)[0]
    rng = random.Random(3)
    hot_chunks = [rng.randrange(400) / 4 for _ in range(60)]
    hot_turns = sorted(rng.randrange(400) / 4 for _ in range(25))
    files[100] = (hot_turns, sorted(hot_chunks) if ascending else hot_chunks)
    expected = {f: rules.align(*x) for f, x in files.items()}
    assert by_rows(spark, files, max_rows=30) == expected


def test_long_unsorted_files_in_blocks(spark, monkeypatch):
    from batchlens.operators import align_unsorted

    monkeypatch.setattr(align_unsorted, "FOLD_ROWS", 20)
    rng = random.Random(9)
    turns = sorted(rng.randrange(400) / 4 for _ in range(15))
    files = random_files(9, 5, False) | {100: (turns, [rng.randrange(400) / 4 for _ in range(50)])}
    expected = {f: rules.align(*x) for f, x in files.items()}
    assert by_rows(spark, files, max_rows=30) == expected


def test_no_join_or_pairing_for_ascending_ends(spark):
    turns, chunks = frames(spark, random_files(4, 5, True))
    out = align_chunks(turns, chunks, ends_ascend=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    # One shuffle for the chunks; the turns come with theirs, then all stays put.
    assert plan.count("Exchange") == 2


def test_by_turn_in_long_files(spark):
    files = random_files(11, 8, True) | {50: ([5.0, 99.0], [i / 2 for i in range(80)])}
    turns, chunks = frames(spark, files)

    def run(long, turns, chunks):
        taken = align_chunks(turns, chunks, long=long, ends_ascend=True, chunk_order=("chunk_id",))
        return align_turns(taken, long=long)

    long = find_long_keys(chunks, ["file_ids"], 30)
    rows = by_length(long, run, turns, chunks).orderBy("file_ids", "turn", "part").collect()
    expected = {}
    for f, x in files.items():
        for chunk, turn in rules.align(*x):
            expected[f, turn] = expected.get((f, turn), "") + str(chunk)
    got = {}
    for r in rows:
        got[r.file_ids, r.turn] = got.get((r.file_ids, r.turn), "") + r.text
    assert got == expected
    assert all(r.part == 0 for r in rows)
