"""Vocabulary files of byte-level BPE tokenizers, and how they cut texts."""

from __future__ import annotations

import ctypes
import json
import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the pattern by which byte-level BPE cuts texts before merging.
PIECES = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id: all that decoding needs of a vocabulary."""
    return Vocabulary(path).bytes_of


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in vocabulary files: itself
    where it is printable Latin-1, else the next free sign from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    return signs | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens as bytes, the merge that makes each, and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        signs = _byte_signs()

        def raw(token: str) -> bytes:
            return bytes(signs[c] for c in token)

        model = described["model"]
        self.id_of = {raw(token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        count = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of = [b""] * count
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        #: (left, right) to the rank of the merge, and a token to the first merge that makes it
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for n, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = raw(left), raw(right)
            pair_ids = self.id_of[a], self.id_of[b]
            self.rank.setdefault(pair_ids, n)
            self.parts.setdefault(self.id_of[a + b], pair_ids)
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def pieces(self, text: str) -> list[str]:
        """``text`` cut into special tokens and pieces that are merged on their own."""
        if self._special is None or not any(s in text for s in self.special):
            return PIECES.findall(text)
        found = []
        for n, part in enumerate(self._special.split(text)):
            found += [part] if n % 2 else PIECES.findall(part)
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def library_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# Distinct chunks a task keeps, and their characters and ids; marks that are one
# byte and so one token.
CHUNKS_KEPT = 1_000_000
SIZE_KEPT = 4_000_000
MARKS = (",", ".")


def flattened(found: list) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum())), lengths


class ChunkEncoder:
    """Ids of texts, put together from the ids of their distinct chunks.

    A space that a non-space follows always starts a piece, so a text may be cut
    before each of its spaces, and each chunk encoded by itself, once. Texts in
    which a space follows or precedes other white space in a way that could be
    one piece with it, or which hold special tokens, are cut into pieces instead.
    Chunks met once are forgotten when too many are kept.
    """

    def __init__(self, words: Vocabulary, encode_new: Callable[[list[str], bool], tuple[np.ndarray, np.ndarray]], size_kept: int | None = None):
        """``encode_new`` gets chunks and gives their ids, end to end, and how many
        each has; it is told whether the chunks may be put end to end too."""
        self.words, self._encode_new, self._size_kept = words, encode_new, size_kept or SIZE_KEPT
        self.clear()

    def clear(self) -> None:
        self._spaced: dict[str, int] = {}
        self._plain: dict[str, int] = {}
        self._lengths = np.zeros(0, dtype=np.int64)
        self._starts = np.zeros(0, dtype=np.int64)
        self._whole = np.zeros(0, dtype=bool)
        self._uses = np.zeros(0, dtype=np.int64)
        self._flat = np.zeros(0, dtype=np.int32)
        self._held = 0

    def _add(self, spaced: list[str], plain: list[str], flat: np.ndarray, lengths: np.ndarray, whole: np.ndarray) -> None:
        first = len(self._lengths)
        self._held += sum(map(len, spaced)) + sum(map(len, plain)) + len(flat)
        self._spaced.update(zip(spaced, range(first, first + len(spaced)), strict=True))
        self._plain.update(zip(plain, range(first + len(spaced), first + len(lengths)), strict=True))
        self._starts = np.concatenate([self._starts, len(self._flat) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._flat = np.concatenate([self._flat, flat])
        self._whole = np.concatenate([self._whole, whole])
        self._uses = np.concatenate([self._uses, np.zeros(len(lengths), dtype=np.int64)])

    def _learn(self, new: list[str], new_plain: list[str]) -> None:
        """Takes up distinct chunks that are not known yet."""
        # A closing mark after a letter is a piece of its own.
        closed = [w for w in new if w[-1:] in MARKS and w[-2:-1].isalpha()]
        if closed:
            rest = set(new).difference(closed)
            rest.update(w for w in [w[:-1] for w in closed] if w not in self._spaced)
            new = list(rest)
            new_plain = new_plain + [m for m in MARKS if m not in self._plain and m not in new_plain]
        special = tuple(self.words.special)
        odd = [w for w in new if not w or w[0].isspace() or "<" in w and any(x in w for x in special)]
        easy = list(set(new).difference(odd)) if odd else new
        for chunks, apart, own in ((easy, [], True), (odd, new_plain, False)):
            if chunks or apart:
                flat, lengths = self._encode_new([" " + w for w in chunks] + apart, own)
                whole = [own] * len(chunks) + [not any(x in w for x in special) for w in apart]
                self._add(chunks, apart, flat, lengths, np.array(whole, dtype=bool))
        if closed:
            stems = np.fromiter((self._spaced[w[:-1]] for w in closed), dtype=np.int64, count=len(closed))
            marks = np.fromiter((self._flat[self._starts[self._plain[w[-1]]]] for w in closed), dtype=np.int32, count=len(closed))
            lengths = self._lengths[stems] + 1
            starts = np.cumsum(lengths) - lengths
            flat = np.empty(int(lengths.sum()), dtype=np.int32)
            flat[gathered(starts, lengths - 1)] = self._flat[gathered(self._starts[stems], lengths - 1)]
            flat[starts + lengths - 1] = marks
            self._add(closed, [], flat, lengths, self._whole[stems])

    def _forget(self) -> None:
        kept = self._uses > 1
        number = np.cumsum(kept) - 1
        self._spaced = {w: int(number[i]) for w, i in self._spaced.items() if kept[i]}
        self._plain = {w: int(number[i]) for w, i in self._plain.items() if kept[i]}
        starts, lengths = self._starts[kept], self._lengths[kept]
        self._flat = self._flat[gathered(starts, lengths)]
        self._lengths, self._whole = lengths, self._whole[kept]
        self._starts = np.cumsum(lengths) - lengths
        self._uses = np.zeros(len(lengths), dtype=np.int64)
        self._held = sum(map(len, self._spaced)) + sum(map(len, self._plain)) + len(self._flat)
        if len(lengths) > CHUNKS_KEPT // 2 or self._held > self._size_kept // 2:
            self.clear()

    def _numbers(self, spaced: list[str], plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of distinct chunks after a space and of other ones."""
        sides = (self._spaced, spaced), (self._plain, plain)
        numbers = [np.fromiter(map(known.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks)) for known, chunks in sides]
        places = [np.flatnonzero(found < 0) for found in numbers]
        new = [[chunks[i] for i in at.tolist()] for at, (_, chunks) in zip(places, sides, strict=True)]
        self._learn(*new)
        for found, at, own, (known, _) in zip(numbers, places, new, sides, strict=True):
            found[at] = np.fromiter(map(known.__getitem__, own), dtype=np.int64, count=len(own))
        return numbers[0], numbers[1]

    def _slots(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the chunks of all texts, end to end, and how many each text has."""
        if len(self._lengths) >= CHUNKS_KEPT or self._held >= self._size_kept:
            self._forget()
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        # Each distinct chunk is looked up once.
        cut = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(cut).to_numpy().astype(np.int64)
        chunks, firsts = cut.flatten(), np.cumsum(sizes) - sizes
        after = np.ones(len(chunks), dtype=bool)
        after[firsts] = False
        spaced = chunks.filter(pa.array(after)).dictionary_encode()
        plain = chunks.take(pa.array(firsts)).dictionary_encode()
        numbers = self._numbers(_listed(spaced.dictionary), _listed(plain.dictionary))
        every = np.empty(len(chunks), dtype=np.int64)
        every[after] = numbers[0][spaced.indices.to_numpy()]
        every[firsts] = numbers[1][plain.indices.to_numpy()]
        odd = np.flatnonzero(~np.logical_and.reduceat(self._whole[every], firsts))
        if len(odd):
            pieces = [self.words.pieces(texts[int(n)].as_py()) for n in odd]
            self._numbers([], list(dict.fromkeys(chain.from_iterable(pieces))))
            found = np.split(every, firsts[1:])
            for n, own in zip(odd, pieces, strict=True):
                found[n] = np.fromiter(map(self._plain.__getitem__, own), dtype=np.int64, count=len(own))
                sizes[n] = len(own)
            every = np.concatenate(found)
        self._uses += np.bincount(every, minlength=len(self._uses))
        return every, sizes

    def encode_flat(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and how many each text has."""
        every, sizes = self._slots(texts)
        lengths = self._lengths[every]
        reached = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(sizes)
        return self._flat[gathered(self._starts[every], lengths)], reached[ends] - reached[ends - sizes]

    def encode_all(self, texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode_flat(texts)
        yield from np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else ()


def _listed(texts: pa.Array) -> list[str]:
    """``to_pylist`` by way of numpy, which takes a tenth of the time."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all runs, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)



@contextmanager
def of_one_task(encoder: ChunkEncoder) -> Iterator[ChunkEncoder]:
    """``encoder``, emptied at the end of the task. Its memory goes back to the
    system, since a Python worker lives on, idle, beside the tasks of later stages."""
    try:
        yield encoder
    finally:
        encoder.clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform.startswith("linux") else None
        if trim is not None:
            trim(0)
