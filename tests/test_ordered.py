import random

import pytest
from pyspark.sql import functions as F

from batchlens.operators.ordered import (
    by_length,
    deal_by_key,
    find_long_keys,
    following,
    last_seen,
    next_seen,
    previous,
    running_max,
    running_sum,
    with_running,
)


def rows(seed):
    """Six keys, one of which (and the NULL key) holds a third of all rows."""
    rng = random.Random(seed)
    keys = ["hot"] * 6 + [None] * 5 + ["a", "b", "c", "d", "e"]
    return [
        (
            rng.choice(keys),
            rng.randrange(40) / 4,
            i,
            rng.choice([None, 1, 2, 3]),
        )
        for i in range(400)
    ]


def running(df, long):
    v = F.col("v")
    return with_running(
        df,
        ["k"],
        ["t", "id"],
        long,
        before=previous(F.struct("v")),
        after=following(F.struct("v")),
        total=running_sum(v),
        top=running_max(v),
        seen=last_seen(v),
        coming=next_seen(v),
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_rows", [7, 60])
def test_blocks_give_what_one_window_gives(spark, seed, max_rows):
    df = spark.createDataFrame(rows(seed), "k string, t double, id long, v long")
    long = find_long_keys(df, ["k"], max_rows)
    assert long is not None and long.n_rows > max_rows
    key = lambda r: r["id"]
    plain = sorted(running(df, None).collect(), key=key)
    blocked = by_length(long, lambda l, rows: running(rows, l), df)
    assert plain == sorted(blocked.collect(), key=key)


def test_blocks_stay_within_their_bound(spark):
    from batchlens.operators.ordered import _in_blocks

    df = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.col("id").alias("t"), "id", F.col("id").alias("v")
    )
    long = find_long_keys(df, ["k"], 1_000)
    sizes = [
        r["count"] for r in _in_blocks(df, ["k"], ["t", "id"], long).groupBy("_block").count().collect()
    ]
    assert len(sizes) >= 15 and max(sizes) < 3_000


def test_short_keys_need_no_blocks(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert find_long_keys(df, ["k"], 1) is None


def test_filter_between_scans_may_empty_a_block(spark):
    df = spark.range(300).select(
        F.lit(1).alias("k"), "id", (F.col("id") % 100 == 0).alias("keep")
    )
    long = find_long_keys(df, ["k"], 10)
    kept = df.where("keep")
    out = with_running(kept, ["k"], ["id"], long, after=following(F.struct("id")))
    got = {r.id: r.after.id if r.after else None for r in out.collect()}
    assert got == {0: 100, 100: 200, 200: None}


def test_tasks_grow_with_the_rows(spark):
    df = spark.range(2000).select((F.col("id") % 97).alias("k"), (F.col("id") / 4).alias("t"), "id", F.lit(1).alias("v"))
    assert deal_by_key(df, ["k"], 1000) is df
    dealt = deal_by_key(df, ["k"], 100)
    assert dealt.rdd.getNumPartitions() == 20
    ran = running(dealt, None)
    assert ran._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(ran.collect(), key=repr) == sorted(running(df, None).collect(), key=repr)


@pytest.mark.parametrize("name", ["speaker_turns", "align_chunks", "align_turns", "align_any_order"])
def test_queries_deal_files_by_their_rows(spark, tmp_path, monkeypatch, name):
    import __spark_entry__ as entry_point
    from batchlens.operators import ordered

    rng = random.Random(3)
    made = [
        (i, rng.randrange(10_000) / 4, rng.choice([None, *range(40)]), rng.choice("ab"), rng.choice([0.5, 2.0, 9.5]), f"w{i}")
        for i in range(1000)
    ]
    events = spark.createDataFrame(made, "event_id long, at double, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds("at")).drop("at").write.parquet(f"{tmp_path}/events.parquet")
    query = entry_point.queries()[name]
    plain = sorted(query(spark, str(tmp_path)).collect(), key=repr)
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 50)
    dealt = query(spark, str(tmp_path))
    assert sorted(dealt.collect(), key=repr) == plain
    assert dealt.rdd.getNumPartitions() == 20
