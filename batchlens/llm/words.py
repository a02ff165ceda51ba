"""Words of a text, in Spark expressions and in Python."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between plain words, and what ends a benchmark word.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

PLAIN_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)


def plain_words(text: Column) -> Column:
    """Words between white space; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def folded_words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of letters, digits and non-ASCII characters."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, NOT_ALNUM), lambda w: w != "")


def words_of(text: str | None) -> list[str]:
    return PLAIN_WORD.findall(text) if text else []


def fold(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(_TO_LOWER)


class WordHashes(dict):
    """64-bit hashes of words, kept while there are at most ``most`` of them."""

    def __init__(self, most: int = 400_000, seed: int = 0):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v = v ^ (v >> np.uint64(29))
    v = v * MULTIPLIER
    return v ^ (v >> np.uint64(32))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for j in range(size):
        total = total * MULTIPLIER + hashes[j : j + count]
    return mixed(total)
