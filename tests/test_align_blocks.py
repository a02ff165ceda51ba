"""Large files with falling chunk ends, in blocks of turns."""

import random

import numpy as np
import pytest

from batchlens.operators import align_blocks, align_unsorted
from batchlens.sources import scratch

import rules
from test_align import by_rows, random_files


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(align_unsorted, "FOLD_ROWS", 5)
    monkeypatch.setattr(align_blocks, "TURNS_PER_BLOCK", 3)


def agrees(spark, files, **options):
    assert by_rows(spark, files, **options) == {f: rules.align(*x) for f, x in files.items()}


def test_random_files(spark, small_blocks):
    agrees(spark, random_files(21, 250, False, longest=30))


def nearly_sorted(seed, n_chunks, n_turns, swaps, ends=4):
    """Ends that ascend but for ``swaps`` chunks changed with one close by."""
    rng = random.Random(seed)
    chunks = sorted(rng.randrange(ends * n_chunks) / 4 for _ in range(n_chunks))
    for _ in range(swaps):
        i = rng.randrange(n_chunks - 4)
        j = i + rng.randint(1, 3)
        chunks[i], chunks[j] = chunks[j], chunks[i]
    turns = sorted(rng.randrange(ends * n_chunks) / 4 for _ in range(n_turns))
    return turns, chunks


def test_dense_and_sparse_turns(spark, small_blocks):
    files = {f: nearly_sorted(f, 60, n, 12) for f, n in enumerate((3, 20, 59, 60, 90, 150))}
    files[10] = ([7.0] * 50, nearly_sorted(9, 60, 1, 10)[1])
    files[11] = (nearly_sorted(8, 60, 40, 0)[0], [None] * 3 + nearly_sorted(8, 60, 1, 9)[1])
    files[12] = (list(reversed(nearly_sorted(7, 60, 40, 0)[0])), nearly_sorted(7, 60, 1, 9)[1])
    agrees(spark, files)


@pytest.mark.parametrize("window", [4, 25])
def test_files_out_of_order_throughout(spark, small_blocks, monkeypatch, window):
    monkeypatch.setattr(align_blocks, "WINDOW_ROWS", window)
    agrees(spark, random_files(22, 40, False, longest=30))


def test_long_files_in_blocks(spark, small_blocks):
    files = random_files(23, 4, False) | {100: nearly_sorted(3, 80, 45, 20)}
    agrees(spark, files, max_rows=30)


def test_work_does_not_grow_with_disorder(spark, small_blocks, monkeypatch):
    """As many tables are written whatever the number of chunks out of place."""
    monkeypatch.setattr(align_blocks, "TURNS_PER_BLOCK", 64)
    names = []

    def counted(df, name):
        names.append(name)
        return scratch.written(df, name)

    monkeypatch.setattr(align_blocks, "written", counted)
    seen = []
    for swaps in (32, 64, 128):
        names.clear()
        agrees(spark, {0: nearly_sorted(swaps, 1500, 900, swaps)})
        seen.append(list(names))
    assert seen[0] == seen[1] == seen[2]


def test_nearest_from_takes_the_first_of_equal_ones():
    rng = np.random.default_rng(2)
    for _ in range(50):
        far, lost = rng.integers(0, 4, 9).astype(float), rng.integers(0, 2, 9).astype(float)
        pairs = list(zip(far, lost))
        expected = [min(range(i, 9), key=lambda j: (pairs[j], j)) for i in range(9)]
        assert align_blocks._nearest_from(far, lost).tolist() == expected
