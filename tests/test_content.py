"""Whole contents of files of any size, given to models."""

import hashlib
import os
import resource

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_point
from batchlens.plans.content import content_scores
from batchlens.sources.media import media_files, openable, with_entries


@pytest.mark.parametrize("inline", [None, 0, 50, 1000])
@pytest.mark.parametrize("memory", [0, 50, 1000])
def test_contents_are_whole(spark, tmp_path, inline, memory):
    content = {"a b%20.bin": os.urandom(25), "b.bin": b"", "large.bin": os.urandom(300)}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)

    def digests():
        return lambda files, options: [hashlib.sha256(f.read()).hexdigest() for f in files]

    files = spark.createDataFrame([(n, str(tmp_path / n)) for n in [*content, "none.bin"]], "name string, file_path string")
    media = media_files(spark, str(tmp_path), "*.bin", max_inline_bytes=inline)
    out = content_scores(files, media, digests, None, "string", memory_bytes=memory)
    assert out.columns == ["name", "file_path", "score"]
    expected = {name: hashlib.sha256(data).hexdigest() for name, data in content.items()}
    assert {r.name: r.score for r in out.collect()} == expected | {"none.bin": None}


def test_files_given_at_once_are_bounded_by_bytes(spark, tmp_path):
    for k in range(9):
        (tmp_path / f"{k}.bin").write_bytes(b"x" * (500 if k == 4 else 30))

    def company():
        def run(files, options):
            sizes = [len(f.read()) for f in files]
            return [f"{len(sizes)} {sum(sizes)}"] * len(sizes)

        return run

    media = media_files(spark, str(tmp_path), "*.bin")
    out = content_scores(media.select("file_path").coalesce(1), media.coalesce(1), company, None, "string", memory_bytes=100)
    seen = [tuple(map(int, r.score.split())) for r in out.collect()]
    assert len(seen) == 9 and seen.count((1, 500)) == 1
    assert all(n <= 3 and size == 30 * n for n, size in seen if size != 500) and max(seen)[0] == 3


def test_a_large_content_takes_little_memory(spark, tmp_path):
    size = 1 << 30
    with open(tmp_path / "large.bin", "wb") as file:
        file.truncate(size)

    def read():
        def run(files, options):
            n = sum(len(piece) for f in files for piece in iter(lambda: f.read(1 << 20), b""))
            return [{"n": n, "mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024}] * len(files)

        return run

    media = media_files(spark, str(tmp_path))
    out = content_scores(media.select("file_path"), media, read, None, "n long, mb long", memory_bytes=1 << 20)
    (row,) = out.collect()
    assert row.score.n == size and row.score.mb < 600


def write_table(path, n, **options):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"x": np.arange(n, dtype="int64")}), path, **options)


def scored(spark, folder):
    return {r.file_name: r.n_rows for r in entry_point.q_media_content(spark, str(folder)).collect()}


def test_rows_of_large_tables(spark, tmp_path):
    plain = {"compression": "none", "use_dictionary": False}
    write_table(tmp_path / "large.parquet", 9_000_000, **plain)
    assert os.path.getsize(tmp_path / "large.parquet") > 64 << 20
    write_table(tmp_path / "small.parquet", 5)
    write_table(tmp_path / "none.parquet", 0)
    assert scored(spark, tmp_path) == {"large.parquet": 9_000_000, "small.parquet": 5, "none.parquet": 0}


def test_rows_of_tables_in_folders(spark, tmp_path):
    given = tmp_path / "given 1%20.parquet"
    write_table(given / "one.parquet", 7)
    write_table(given / "many.parquet/part-0.parquet", 3)
    write_table(given / "many.parquet/part-1.parquet", 4)
    write_table(given / "many.parquet/k=1/one.parquet", 5)
    write_table(given / "other/one.parquet", 100)
    (given / "many.parquet/_SUCCESS").write_bytes(b"")
    expected = {"one.parquet": 7, "many.parquet": 12}
    assert scored(spark, given) == expected and scored(spark, f"file://{given}/") == expected
    entries = with_entries(media_files(spark, str(given), nested=True), str(given)).collect()
    assert {(r.entry_path, r.entry_name) for r in entries} == {
        (f"file:{given}/{name}", name) for name in ("one.parquet", "many.parquet", "other")
    }


def test_rows_in_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    write_table(tmp_path / "one.parquet", 7)
    write_table(tmp_path / "many.parquet/part-0.parquet", 3)
    write_table(tmp_path / "many.parquet/part-1.parquet", 4)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.contents.link./in", f"file://{tmp_path}")
    monkeypatch.setattr(entry_point, "CONTENT_BYTES", 0)
    assert openable(spark, str(tmp_path)) and not openable(spark, "viewfs://contents/in")
    assert scored(spark, "viewfs://contents/in") == {"one.parquet": 7, "many.parquet": 7}
