import pytest
from pyspark.sql import functions as F

from batchlens.functions.media import (
    TURNS,
    chunks_from_text,
    to_text,
    turns_from_text,
)
from batchlens.operators.chunks import number_chunks_by_key, union_chunks
from batchlens.operators.concat import concat_ordered
from batchlens.operators.joins import join_media, left_join
from batchlens.operators.ordered import by_length, find_long_keys
from batchlens.operators.totals import batch_report, token_totals
from batchlens.plans import partitions
from batchlens.sources.media import attach_media, file_ends, media_files
from batchlens.sources.tables import bounded, image_path, keep, read_products, write_table


def test_csv_and_image_path(spark, tmp_path):
    file = tmp_path / "p.csv"
    file.write_text("Category,Gender,Image\nApparel,Girls,42419.jpg\nApparel,,1.jpg\n")
    df = read_products(spark, str(file), ["Category", "Gender", "Image"])
    assert {t for _, t in df.dtypes} == {"string"}
    path = image_path("/d/", F.col("Category"), F.col("Gender"), F.col("Image"))
    assert [r[0] for r in df.select(path).collect()] == [
        "/d/Apparel/Girls/Images/images_with_product_ids/42419.jpg",
        None,
    ]


@pytest.mark.parametrize("fmt", [None, "parquet", "orc"])
def test_overwrite_twice(spark, fmt):
    name = f"overwritten_{fmt}"
    write_table(spark.range(5), name, fmt)
    write_table(spark.range(3).withColumn("x", F.lit("y")), name, fmt)
    assert spark.sql(f"SELECT * FROM {name}").count() == 3
    assert spark.table(name).columns == ["id", "x"]


def test_write_to_a_path_and_keep(spark, tmp_path):
    write_table(spark.range(4), "at_path", "parquet", str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    kept = keep(spark.range(3))
    assert kept.count() == 3 and kept.is_cached
    kept.unpersist()


def test_bounded_takes_the_first_by_key(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in bounded(df, "id", 3).collect()] == [0, 1, 2]


def test_token_totals(spark):
    df = spark.createDataFrame(
        [("hello", "\U0001f600"), ("ab", None), (None, "abc")], "text string, generated string"
    )
    assert tuple(token_totals(df).first()) == (1.75, 1.0, 3)
    assert tuple(token_totals(df.where("text = 'none'")).first()) == (None, None, 0)


def test_partition_count(spark):
    size = partitions.JobSize
    for rows, per_task, workers, expected in [
        (100_000, 1024, 4, 98),
        (0, 1024, 4, 4),
        (1000, 32, 1, 32),
        (2, 4096, 2, 2),
    ]:
        assert partitions.partition_count(rows, size(workers, per_task)) == expected
        plan = partitions.partition_plan(spark.range(rows), "w", size(workers, per_task))
        assert tuple(plan.first()) == ("w", rows, expected)


def test_spread_is_even_and_whole(spark):
    df = spark.range(0, 5000, 1, 2).withColumn("text", F.lit("ab"))
    report = batch_report(partitions.spread(df, partitions.JobSize(2, 1000))).collect()
    assert len(report) == 5 and sum(r.n_rows for r in report) == 5000
    assert all(900 < r.n_rows < 1100 and r.chars == 2 * r.n_rows for r in report)


def test_arrow_batches_are_capped(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    partitions.cap_arrow_batches(spark)
    try:
        sizes = spark.range(0, 1001, 1, 1).mapInPandas(
            lambda batches: (b.head(1).assign(id=len(b)) for b in batches), "id long"
        )
        assert sorted(r.id for r in sizes.collect()) == [489, 512]
    finally:
        spark.conf.set(name, before)


def test_left_joins(spark):
    files = spark.createDataFrame(
        [(1, "a", "/a"), (2, "b", "/b"), (3, "c", "/c"), (None, "n", "/n")],
        "file_ids long, file_name string, file_path string",
    )
    text = spark.createDataFrame(
        [(1, "t1"), (1, "t1 again"), (2, "t2"), (None, "lost")], "file_ids long, transcription string"
    )
    voices = spark.createDataFrame([(2, "d2")], "file_ids long, diarization string")
    out = join_media(files, text, voices)
    assert out.columns == ["file_ids", "file_name", "file_path", "transcription", "diarization"]
    expected = [
        ("a", "t1", None), ("a", "t1 again", None), ("b", "t2", "d2"),
        ("c", None, None), ("n", None, None),
    ]
    rows = out.select("file_name", "transcription", "diarization").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_hot_key_on_the_right_of_a_left_join(spark):
    left = spark.range(20).select(
        F.when(F.col("id") != 7, F.col("id") % 10).alias("k"), F.col("id").alias("l")
    )
    right = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 4)
        .when(F.col("id") % 3 == 1, F.col("id") % 8)
        .cast("long")
        .alias("k"),
        F.col("id").alias("r"),
    )
    long = find_long_keys(right, ["k"], 100)
    assert long is not None and long.n_keys == 2  # 4 and NULL
    key = lambda r: (r.l, -1 if r.r is None else r.r)
    plain = sorted(left_join(left, right, "k").collect(), key=key)
    salted = sorted(left_join(left, right, "k", long).collect(), key=key)
    assert plain == salted and any(r.r is None for r in plain)


def test_concat_in_order_and_in_parts(spark):
    df = spark.range(50).select(
        (F.col("id") % 3 == 0).alias("g"), (50 - F.col("id")).alias("o"), F.col("id").cast("string").alias("t")
    )
    expected = {
        g: "".join(str(i) for i in range(49, -1, -1) if (i % 3 == 0) == g) for g in (True, False)
    }
    whole = concat_ordered(df, ["g"], ["o"], "t", last=F.max("o")).collect()
    assert {r.g: r.t for r in whole} == expected
    assert {r.g: (r.part, r["last"]) for r in whole} == {True: (0, 50), False: (0, 49)}

    def texts(parts):
        rows = sorted(parts.collect(), key=lambda r: r.part)
        return (
            {g: "".join(r.t for r in rows if r.g == g) for g in (True, False)},
            {g: sum(r.g == g for r in rows) for g in (True, False)},
        )

    text, counts = texts(concat_ordered(df, ["g"], ["o"], "t", max_chars=10))
    assert text == expected and counts[True] >= 3 and counts[False] >= 5
    long = find_long_keys(df, ["g"], 20)
    assert long.n_keys == 1
    text, counts = texts(
        by_length(long, lambda l, rows: concat_ordered(rows, ["g"], ["o"], "t", l), df)
    )
    assert text == expected and counts == {True: 1, False: 1}


def test_chunk_numbers(spark):
    ids = spark.range(5000).select((F.col("id") * F.col("id") + 7).alias("id")).repartition(5)
    out = number_chunks_by_key(ids, "id", 64).collect()
    by_key = sorted((r.id, r.chunk_no) for r in out)
    assert [c for _, c in by_key] == [i // 64 for i in range(5000)]


def test_chunk_numbers_of_any_key(spark):
    keys = spark.createDataFrame([(k,) for k in "dbca"] + [(None,), (None,), ("b",)], "k string")
    rows = sorted((r.k or "", r.chunk_no) for r in number_chunks_by_key(keys, "k", 2).collect())
    assert rows == [("", 0), ("", 0), ("a", 1), ("b", 1), ("b", 2), ("c", 2), ("d", 3)]


def test_pieces_are_matched_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    b = spark.createDataFrame([("y", 2)], "t string, id long")
    assert sorted(map(tuple, union_chunks([a, b]).collect())) == [(1, "x"), (2, "y")]


def test_json_round_trip(spark):
    turns = [((0.0, 1.5), "A"), ((1.5, None), None)]
    df = spark.createDataFrame([(turns,), (None,), ([],)], f"turns {TURNS}")
    back = df.select("turns", turns_from_text(to_text(F.col("turns"))).alias("back")).collect()
    assert all(r.turns == r.back for r in back)
    bad = spark.createDataFrame([("{oops",), (None,)], "t string")
    assert [r[0] for r in bad.select(chunks_from_text(F.col("t"))).collect()] == [None, None]
    open_end = spark.createDataFrame([('[{"text":"hi","timestamp":[0.0,null]}]',)], "t string")
    assert open_end.select(chunks_from_text(F.col("t"))).first()[0][0].timestamp == [0.0, None]


def test_media_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "b.bin").write_bytes(b"1" * 100)
    (tmp_path / "c.txt").write_bytes(b"")
    names = media_files(spark, str(tmp_path), "*.bin").collect()
    assert sorted((r.file_name, r.length, r.content) for r in names) == [
        ("a.bin", 5, None), ("b.bin", 100, None),
    ]
    read = media_files(spark, str(tmp_path), "*.bin", max_inline_bytes=50).collect()
    assert {r.file_name: r.content for r in read} == {"a.bin": bytearray(b"12345"), "b.bin": None}

    files = spark.createDataFrame(
        [(1, str(tmp_path / "a.bin")), (2, "/nowhere/a.bin")], "file_ids long, file_path string"
    )
    attached = attach_media(files, media_files(spark, str(tmp_path), "*.bin", max_inline_bytes=50))
    assert {r.file_ids: (r.length, r.content) for r in attached.collect()} == {
        1: (5, bytearray(b"12345")), 2: (None, None),
    }


def test_file_ends(spark, tmp_path):
    for name, content in {"a b%20.bin": b"12345", "b.bin": b"1" * 99 + b"2", "c.bin": b"", "d.bin": b"12"}.items():
        (tmp_path / name).write_bytes(content)
    expected = [("a b%20.bin", 5, b"1234", b"2345"), ("b.bin", 100, b"1111", b"1112"), ("c.bin", 0, b"", b""), ("d.bin", 2, b"12", b"12")]
    for inline in (None, 0, 50, 1000):
        ends = file_ends(media_files(spark, str(tmp_path), "*.bin", max_inline_bytes=inline)).collect()
        assert sorted((r.file_name, r.n_bytes, bytes(r.head), bytes(r.tail)) for r in ends) == expected


def test_model_calls_follow_the_job(spark):
    from batchlens.plans import captions

    def counting():
        return lambda inputs, options: [str(len(inputs))] * len(inputs)

    size = partitions.JobSize(1, 32)
    pictures = spark.range(320).select(F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("file_path"))
    out = captions.captions(pictures, counting, size=size)
    assert out.rdd.getNumPartitions() == 10
    seen = [int(r.caption) for r in out.collect()]
    assert len(seen) == 320 and max(seen) <= 32


def test_a_task_makes_many_calls(spark):
    from batchlens.plans import captions

    def counting():
        return lambda inputs, options: [str(len(inputs))] * len(inputs)

    pictures = spark.range(20_000).select(F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("file_path"))
    out = captions.captions(pictures, counting)
    # Tasks grow with the rows, but not with the calls.
    assert out.rdd.getNumPartitions() == 20
    seen = [int(r.caption) for r in out.collect()]
    assert len(seen) == 20_000 and max(seen) == 32
    plan = partitions.partition_plan(pictures, "image", partitions.IMAGE_JOB)
    assert tuple(plan.first()) == ("image", 20_000, 625)
