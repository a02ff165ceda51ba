"""Collocations against counting every phrase in plain Python."""

import collections
import re

import numpy as np
import pytest

from batchlens.llm import phrases, queries


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", piece)


def expected(rows, least, first, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = collections.defaultdict(list)
    often = [(lang, p) for (lang, p), c in f.items() if c >= least and len(p) > 1]
    within = collections.Counter()
    for lang, p in often:
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p):
                    within[lang, p[i:j]] = max(within[lang, p[i:j]], f[lang, p])
    for lang, p in often:
        a = f[lang, p]
        if within[lang, p] >= a:
            continue
        score, _, l, r = min(  # noqa: E741
            (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
        )
        found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:first], 1)  # noqa: E741
    )


def found(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def test_query(spark, sf, documents):
    rows = [(d["lang"], d["text"]) for d in documents]
    assert found(queries.op12_phrases(spark, sf)) == expected(rows, 100, 2000)


@pytest.mark.parametrize(
    "plan",
    [
        phrases.Plan(least=2, first=40),
        phrases.Plan(least=2, filter_bits=16, buffer=50, known_words=20),
        phrases.Plan(least=3, longest=3, buffer=1),
    ],
)
def test_small_counts(spark, sf, documents, plan, monkeypatch):
    rows = [(d["lang"], d["text"]) for d in documents]
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    df = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    assert found(phrases.collocations(df, plan=plan)) == expected(rows, plan.least, plan.first, plan.longest)


def test_odd_characters(spark):
    rows = [("a", "X y \x1c z  " * 3), ("a", "É\x85é, é É. " * 4), (None, "one.\r\none\x0bone\ttwo two two two"), ("b", None), ("b", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(phrases.collocations(df, plan=phrases.Plan(least=1))) == expected(rows, 1, 2000)


def test_ranges_are_joined(spark):
    rows = [("a", "x y z x y z x y")] * 50 + [("a", f"x y w{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(phrases.collocations(df, plan=phrases.Plan(least=1))) == expected(rows, 1, 2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_exact_arithmetic(spark):
    big = 9_000_000_000_000
    df = spark.createDataFrame([(big, big, 3, 7)], "a long, n long, l long, r long")
    value = df.selectExpr(
        "(CAST(a AS DECIMAL(18,0)) * CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(15,0))) div "
        "(CAST(l * 1000000000 AS DECIMAL(18,0)) * CAST(r * 1000000000 AS DECIMAL(18,0))) AS s"
    ).first()
    assert value.s == 1000 * big * big // (21 * 10**18)


def test_windows_are_sent_once_a_slot(spark):
    codes = np.array([5, 6, 7, 8, 9], dtype=np.uint64).tobytes()
    slots = spark.sparkContext.defaultParallelism
    read = spark.createDataFrame([("a", codes)] * 40 * slots, "lang string, codes binary").repartition(4 * slots)
    known = spark.sparkContext.broadcast([np.full(8, 255, dtype=np.uint8)])
    rows = phrases._windows(read, known, phrases.Plan(longest=2)).collect()
    assert len(rows) <= 4 * slots
    assert sorted(collections.Counter(r["gram"] for r in rows)) == [bytes(7) + bytes([i]) + bytes(7) + bytes([i + 1]) for i in (5, 6, 7, 8)]
    assert sum(r["n"] for r in rows) == 4 * 40 * slots
