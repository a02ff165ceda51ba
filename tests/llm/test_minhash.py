"""Near copies by min-hash signatures against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.llm import minhash, queries


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    size = min(2, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def expected(rows):
    """``(key, n_shingles, component_id)`` of ``(key, text)`` rows, NULL keys last."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        rank = (key is None, key or 0)
        least[top(i)] = min(least.get(top(i), rank), rank)
    first = [least[top(i)] for i in range(len(rows))]
    ids = [None if none else key for none, key in first]
    return sorted(((k, len(s), i) for (k, _), s, i in zip(rows, sets, ids, strict=True)), key=str)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r[0] == r.component_id) for r in rows)
    return sorted(((r[0], r.n_shingles, r.component_id) for r in rows), key=str)


def test_query(spark, sf, documents):
    assert found(queries.op11_minhash(spark, sf)) == expected([(d["doc_id"], d["text"]) for d in documents])


def edited(rng, words, share):
    return [rng.choice("pqrs") + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def clusters():
    """Copies near their original alone, chains, short sets, a shared line."""
    rng = random.Random(8)
    rows = []
    original = [f"w{rng.randint(0, 300)}" for _ in range(120)]
    rows.append(original)
    rows += [edited(rng, original, 0.05) for _ in range(60)]
    chain = [f"c{rng.randint(0, 300)}" for _ in range(100)]
    for _ in range(25):
        chain = edited(rng, chain, 0.03)
        rows.append(chain)
    line = [f"l{i}" for i in range(6)]
    rows += [[*line, *edited(rng, ["x"] * rng.randint(0, 3), 1)] for _ in range(60)]
    rows += [["a", "b", "c", "d", "e", "f"][:n] for n in range(7)] * 2
    texts = [" ".join(r) for r in rows] + [None, "", " \t"]
    rng.shuffle(texts)
    keyed = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    return [*keyed, (3, "another text under the id three of its own"), keyed[5]]


@pytest.mark.parametrize("plan", [minhash.Plan(), minhash.Plan(block=3)])
def test_any_block_size(spark, plan):
    rows = clusters()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).repartition(3)
    assert found(minhash.near_duplicates(df, plan=plan)) == expected(rows)


def test_plan():
    rng = np.random.default_rng(4)
    for plan in (minhash.Plan(), minhash.Plan(coordinates=32, missed=1e-3)):
        assert 0.36**plan.posted <= plan.missed
        equal = rng.binomial(plan.coordinates, 0.8, 1_000_000)
        assert (equal < plan.matches).mean() <= 1.5 * plan.missed + 5e-6
