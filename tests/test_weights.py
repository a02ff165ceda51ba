"""Dealing by weight, and models that see the content of files."""

import random

import pytest
from pyspark.sql import functions as F

from batchlens.operators.totals import batch_report
from batchlens.operators.weights import deal_by_weight, with_weight_before
from batchlens.plans.content import content_scores
from batchlens.sources.media import media_files


def test_weight_before(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 0, 1, 5, 900])) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, w long").repartition(7)
    found = {r.k: r.weight_before for r in with_weight_before(df, ["k"], F.col("w")).collect()}
    total = 0
    for k, w in rows:
        assert found[k] == total
        total += w or 0


@pytest.mark.parametrize("n", [1, 3, 8])
def test_partitions_of_equal_weight(spark, n):
    rng = random.Random(2)
    texts = ["x" * rng.choice([0, 3, 40, 2000]) for _ in range(400)] + [None, "y" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    dealt = deal_by_weight(df, "id", F.length("text"), n)
    assert dealt.rdd.getNumPartitions() == n
    report = batch_report(dealt).collect()
    total = sum(len(t or "") for t in texts)
    assert sum(r.n_rows for r in report) == len(texts) and sum(r.chars or 0 for r in report) == total
    assert max(r.chars or 0 for r in report) <= -(-total // n) + 5000
    assert sorted(map(tuple, dealt.collect())) == list(enumerate(texts))


def test_nothing_to_deal(spark):
    empty = spark.createDataFrame([], "id long, text string")
    assert deal_by_weight(empty, "id", F.length("text"), 4).collect() == []
    light = spark.createDataFrame([(1, None), (2, "")], "id long, text string")
    assert sorted(r.id for r in deal_by_weight(light, "id", F.length("text"), 4).collect()) == [1, 2]


def test_models_see_contents(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x00\xffab")
    (tmp_path / "b.bin").write_bytes(b"")
    (tmp_path / "large.bin").write_bytes(b"x" * 100)

    def lengths():
        return lambda contents, options: [f"{options}{len(c)}:{c[:2].hex()}" for c in contents]

    files = spark.createDataFrame(
        [(n, str(tmp_path / n)) for n in ("a.bin", "b.bin", "large.bin", "none.bin")], "name string, file_path string"
    )
    media = media_files(spark, str(tmp_path), "*.bin", max_inline_bytes=50)
    out = content_scores(files, media, lengths, "n", "string")
    assert out.columns == ["name", "file_path", "score"]
    assert {r.name: r.score for r in out.collect()} == {
        "a.bin": "n4:00ff", "b.bin": "n0:", "large.bin": None, "none.bin": None,
    }
