"""CSV by header, tables in versions, media by ranges, recordings over many rows."""

import os
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.operators.audio import prepare_blocks, prepare_rows
from batchlens.sources import versions
from batchlens.sources.csv_files import read_by_header
from batchlens.sources.ranges import dealt, file_sums, media_ranges
from batchlens.sources.versions import replace_table


def test_csv_columns_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Image,ProductId,Gender,Category,Extra\n1.jpg,7,Men,Shoes,x\n2.jpg,8\n")
    (tmp_path / "b c.csv").write_text('Category,Gender,Image\n"Bags, big",Women,3.jpg\nBags,Men,4.jpg,more\nBags,,5.jpg\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("Gender,Image,,Category\n")
    rows, bad = read_by_header(spark, str(tmp_path), ["Category", "Gender", "Image"])
    assert rows.columns == ["Category", "Gender", "Image"] and {t for _, t in rows.dtypes} == {"string"}
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("Bags", None, "5.jpg"), ("Bags, big", "Women", "3.jpg"), ("Shoes", "Men", "1.jpg"),
    ]
    assert sorted((r.file_path.rsplit("/", 1)[1], r.line) for r in bad.collect()) == [
        ("a.csv", "2.jpg,8"), ("b%20c.csv", "Bags,Men,4.jpg,more"),
    ]
    assert rows.count() == 3 and bad.count() == 2


def test_csv_without_a_column_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Image,Image,Gender\n1,2,3\n")
    for column in ("Category", "Image"):
        with pytest.raises(ValueError, match=column):
            read_by_header(spark, str(tmp_path), [column])
    (tmp_path / "none").mkdir()
    rows, bad = read_by_header(spark, str(tmp_path / "none"), ["A"])
    assert rows.columns == ["A"] and not rows.collect() and not bad.collect()


def test_replaced_in_one_step(spark, tmp_path):
    base = str(tmp_path)
    folders = [replace_table(spark.range(n), "versioned", base=base) for n in (5, 3, 2)]
    assert spark.table("versioned").count() == 2
    kept = sorted(os.listdir(tmp_path / "versioned"))
    assert kept == sorted(f.rsplit("/", 1)[1] for f in folders[1:])
    replace_table(spark.range(4).withColumn("x", F.lit("y")), "versioned", base=base)
    assert spark.table("versioned").columns == ["id", "x"] and spark.table("versioned").count() == 4
    replace_table(spark.range(0).withColumn("x", F.lit("y")), "versioned", "orc", base)
    assert spark.table("versioned").count() == 0


def test_broken_writes_leave_the_old_rows(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    replace_table(spark.range(5), "kept", base=base)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        replace_table(broken, "kept", base=base)
    assert sorted(r.id for r in spark.table("kept").collect()) == [0, 1, 2, 3, 4]
    with monkeypatch.context() as patched:
        patched.setattr(versions, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            replace_table(spark.range(7), "kept", base=base)
    assert spark.table("kept").count() == 5
    # A table may be replaced by what is read from it.
    replace_table(spark.table("kept").where("id > 2"), "kept", base=base)
    assert sorted(r.id for r in spark.table("kept").collect()) == [3, 4]


def test_tables_written_otherwise_are_left_alone(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("in_place")
    with pytest.raises(ValueError, match="in_place"):
        replace_table(spark.range(1), "in_place")
    assert spark.table("in_place").count() == 3


def test_ranges(spark, tmp_path):
    content = {"a b%20.bin": os.urandom(25), "b.bin": b"", "c.bin": os.urandom(10), "d.txt": b"no"}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "sub.bin").mkdir()
    rows = media_ranges(spark, str(tmp_path), "*.bin", range_bytes=10, task_bytes=30).collect()
    for name in ("a b%20.bin", "b.bin", "c.bin"):
        own = sorted((r for r in rows if r.file_name == name), key=lambda r: r.part)
        assert b"".join(r.content for r in own) == content[name]
        assert [r.part for r in own] == list(range(len(own))) and {r.length for r in own} == {len(content[name])}
        assert all(len(r.content) <= 10 and r.first_byte == 10 * r.part for r in own)
    assert len(rows) == 5
    sums = file_sums(media_ranges(spark, str(tmp_path), "*.bin", range_bytes=10)).collect()
    assert {r.file_name: (r.n_bytes, r.n_parts) for r in sums} == {"a b%20.bin": (25, 3), "b.bin": (0, 1), "c.bin": (10, 1)}
    (tmp_path / "none").mkdir()
    assert media_ranges(spark, str(tmp_path / "none")).collect() == []


def test_ranges_are_dealt_by_bytes():
    tasks = dealt([("a", 100), ("b", 0), ("c", 25)], 10, 2 * 1024 * 1024)
    assert sum(len(t.rows) for t in tasks) == 14
    assert len(dealt([(str(i), 1) for i in range(10)], 10, 3 * 1024 * 1024 + 30)) == 4


def test_a_large_file_takes_little_memory(spark, tmp_path):
    size = 1 << 30
    with open(tmp_path / "large.bin", "wb") as file:
        file.truncate(size)

    def peak(batches):
        import pyarrow as pa

        for batch in batches:
            used = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
            n = sum(len(c.as_buffer()) for c in batch.column("content"))
            yield pa.RecordBatch.from_arrays([pa.array([used]), pa.array([n])], ["mb", "n"])

    rows = media_ranges(spark, str(tmp_path), task_bytes=256 << 20).mapInArrow(peak, "mb long, n long")
    total = rows.agg(F.sum("n").alias("n"), F.max("mb").alias("mb")).first()
    assert total.n == size and total.mb < 600


def cut(signal, sizes):
    at = 0
    for n in sizes:
        yield at, signal[at : at + n]
        at += n
    assert at >= len(signal)


@pytest.mark.parametrize("rate", [8000, 16000, 22050, 44100])
def test_recordings_over_many_rows(spark, rate):
    rng = np.random.default_rng(rate)
    signal = rng.normal(size=rate * 2 + 77).tolist()
    whole = spark.createDataFrame([(1, rate, signal)], "file_ids long, sampling_rate int, samples array<double>")
    expected = {r.block: (r.first_sample, r.samples) for r in prepare_blocks(whole, seconds=1).collect()}
    for sizes in ([5, 1, 0, 2] * 4 + [len(signal)], [len(signal) // 7 + 1] * 7, [len(signal)]):
        rows = [(1, rate, at, part) for at, part in cut(signal, sizes) if part or len(sizes) > 8]
        df = spark.createDataFrame(rows, "file_ids long, sampling_rate int, first_sample long, samples array<double>").repartition(5)
        found = {r.block: (r.first_sample, r.samples) for r in prepare_rows(df, seconds=1).collect()}
        assert found == expected


def test_recordings_with_a_problem(spark):
    rows = [
        (1, 8000, 0, [1.0] * 4), (1, 8000, 5, [1.0]),  # a gap
        (2, 8000, 0, [1.0] * 4), (2, 8000, 3, [1.0] * 2),  # an overlap
        (3, 8000, 0, [1.0]), (3, 16000, 1, [1.0]),
        (4, 8000, 0, [1.0]), (4, 8000, 1, [None]),
        (5, 8000, 0, None),
        (6, 0, 0, [1.0]),
        (7, 16000, 0, [0.5, 0.25]),
        (8, 16000, 0, []),
        (None, 16000, 2, [0.75]), (None, 16000, 0, [0.5, 0.25]),
        (9, 8000, 0, [1.0] * 3), (9, 8000, 2, [1.0] * 2), (9, 8000, 6, [1.0]),  # both, of equal length
    ]
    df = spark.createDataFrame(rows, "file_ids long, sampling_rate int, first_sample long, samples array<double>")
    found = {r.file_ids: (r.samples, r.problem) for r in prepare_rows(df).collect()}
    assert found == {
        1: (None, "missing samples"), 2: (None, "missing samples"), 3: (None, "no sampling rate"),
        4: (None, "missing samples"), 5: (None, "no samples"), 6: (None, "no sampling rate"),
        7: ([0.5, 0.25], None), 8: ([], None), None: ([0.5, 0.25, 0.75], None), 9: (None, "missing samples"),
    }
