"""Every registered query against its SQL counterpart on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = sorted(n for n in entry_point.queries() if not n.startswith(("op", "pipeline")))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def check(spark, sql, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert got
    result = sql.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    check(spark, sql, name)


@pytest.mark.parametrize(
    "name",
    ["speaker_turns", "align_chunks", "align_any_order", "align_turns", "media_join", "prompt_chat", "prompt_chat_parts"],
)
def test_query_with_hot_keys(spark, sql, name, monkeypatch):
    """The same results when most files count as too long for one task."""
    from batchlens.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_BLOCK", 40)
    check(spark, sql, name)


@pytest.mark.parametrize("inline", [0, 20_000])
def test_media_scan_opens_large_files(spark, sql, inline, monkeypatch):
    monkeypatch.setattr(entry_point, "INLINE_BYTES", inline)
    check(spark, sql, "media_scan")


@pytest.mark.parametrize("held", [0, 20_000])
def test_media_content_is_whole_beyond_what_a_task_holds(spark, sql, held, monkeypatch):
    monkeypatch.setattr(entry_point, "CONTENT_BYTES", held)
    check(spark, sql, "media_content")


def test_entry(spark):
    row = entry_point.entry(spark).first()
    assert row.total_ct > 0 and row.input_tokens > row.output_tokens > 0
