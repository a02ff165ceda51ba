"""Byte-level BPE over a trie of the distinct words: shared prefixes once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from batchlens.llm.vocabulary import ChunkEncoder, Vocabulary, flattened, of_one_task, token_bytes, vocabulary
from batchlens.plans.partitions import cap_arrow_batches

_NEVER = 1 << 60
TEXTS_AT_ONCE = 256
# Of an Arrow batch, which the JVM and a worker each hold whole, on both sides of
# encoding and decoding.
ARROW_ROWS, ARROW_BYTES = 1_024, 4_000_000
# Steps from byte to byte and seams that are kept.
STEPS_KEPT = 250_000
SEAMS_KEPT = 250_000


# The ending of a prefix: its bytes, the tokens that end there (longest first, each
# with its length and whether its seam to a token before it holds), and what
# follows when a byte is added.
Ending = tuple[bytes, list[tuple[int, int, dict[int, bool]]], dict[int, "Ending"]]


class TrieEncoder:
    """Encodes words by walking their trie depth first.

    The BPE of every prefix of a word ends in one last token, and what comes
    before it is the BPE of the prefix without that token. So a node of the trie
    needs only its last token: the token that ends the prefix and stands the seam
    to the last token before it. The sorted words are the trie in depth-first
    order: the nodes of a word's longest common prefix with the word before it
    are still on the path, and only the rest is new.

    Which tokens end a prefix is told by its longest ending that some token
    starts with, so that only tokens that do occur there are tried. Such an
    ending follows from that of the prefix without its last byte.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        opens = chain.from_iterable((token[:n] for n in range(1, len(token) + 1)) for token in words.id_of)
        self._openings = {b"", *opens}
        self._spines: tuple[dict, dict] = ({}, {})
        self._forget()

    def _forget(self) -> None:
        self._root: Ending = (b"", [], {})
        self._endings = {b"": self._root}
        self._seams: dict[int, dict[int, bool]] = {}
        self._steps_kept = self._seams_kept = 0

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on one edge (0 left, 1 right) while ``token`` is built, from
        the last, each with the rank of the merge that takes it up."""
        known = self._spines[side].get(token)
        if known is None:
            known, until, at = [], _NEVER, token
            while True:
                known.append((at, until))
                parts = self.words.parts.get(at)
                if parts is None:
                    break
                until, at = self.words.rank[parts], parts[side]
            self._spines[side][token] = known
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether no merge joins the two tokens while both are being built.

        Of equal merges the leftmost comes first: one inside ``left`` goes before
        the seam's, the seam's before one inside ``right``.
        """
        rank = self.words.rank
        held = True
        for a, a_until in self._spine(left, 1):
            for b, b_until in self._spine(right, 0):
                merge = rank.get((a, b))
                if merge is not None and merge < a_until and merge <= b_until:
                    held = False
                    break
            if not held:
                break
        self._seams[right][left] = held
        self._seams_kept += 1
        return held

    def _step(self, before: Ending, byte: int) -> Ending:
        """The ending that follows when a byte is added."""
        reached = before[0] + bytes([byte])
        own = next(reached[n:] for n in range(len(reached) + 1) if reached[n:] in self._openings)
        found = self._endings.get(own)
        if found is None:
            id_of = self.words.id_of
            tokens = [(id_of[own[n:]], len(own) - n) for n in range(len(own)) if own[n:] in id_of]
            found = own, [(token, size, self._seams.setdefault(token, {})) for token, size in tokens], {}
            self._endings[own] = found
        before[2][byte] = found
        self._steps_kept += 1
        return found

    def _walk(self, words: list[bytes]) -> Iterator[tuple[int, ...]]:
        """The ids of sorted distinct words."""
        if self._steps_kept >= STEPS_KEPT or self._seams_kept >= SEAMS_KEPT:
            self._forget()
        seam_holds = self._seam_holds
        # Per prefix: its ending, and its last token with its length.
        endings: list[Ending] = [self._root]
        path: list[tuple[int, int, dict[int, bool]]] = [(-1, 0, {})]
        before = b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del endings[shared + 1 :], path[shared + 1 :]
            ending, end = endings[shared], shared
            for byte in word[shared:]:
                end += 1
                ending = ending[2].get(byte) or self._step(ending, byte)
                for last in ending[1]:
                    token, size, seams = last
                    if size == end:
                        break
                    left = path[end - size][0]
                    holds = seams.get(left)
                    if holds or holds is None and seam_holds(left, token):
                        break
                endings.append(ending)
                path.append(last)
            ids = []
            while end:
                last = path[end]
                ids.append(last[0])
                end -= last[1]
            before = word
            yield tuple(ids[::-1])

    def encode_new(self, chunks: list[str], _: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks of text, by a walk over their distinct pieces."""
        # A word of ASCII letters, with the space before it, is one piece.
        cut = [[c] if c[:1] == " " and c[1:].isalpha() and c.isascii() else self.words.pieces(c) for c in chunks]
        special = self.words.special
        known: dict[str, tuple[int, ...]] = {p: (i,) for p, i in special.items()}
        plain = sorted({p.encode() for p in chain.from_iterable(cut) if p not in special})
        for word, ids in zip(plain, self._walk(plain), strict=True):
            known[word.decode()] = ids
        return flattened(
            [known[pieces[0]] if len(pieces) == 1 else [i for p in pieces for i in known[p]] for pieces in cut]
        )

    def decode(self, ids: list[int]) -> str:
        return text_of(self.words.bytes_of, ids)


def text_of(table: list[bytes], ids: list[int]) -> str:
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def trie(path: str) -> TrieEncoder:
    return TrieEncoder(vocabulary(path))


def encoder(path: str) -> ChunkEncoder:
    """One for each task, so that chunks stay known between its batches."""
    return ChunkEncoder(vocabulary(path), trie(path).encode_new)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` without its text, with the token ids of it (``array<int>``).

    NULL and empty texts have no ids. A column named ``ids`` is replaced. Each
    text is encoded where it lies, without a shuffle; a task keeps at most
    ``CHUNKS_KEPT`` chunks of ``SIZE_KEPT`` characters and ids in all, and the
    texts at hand, in memory.
    """
    kept = [c for c in df.columns if c not in (text, ids)]
    cap_arrow_batches(df.sparkSession, ARROW_ROWS, ARROW_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with of_one_task(encoder(path)) as own:
            for batch in _slices(batches):
                column = pa.array(list(own.encode_all(batch.column(text))), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], column], [*kept, ids])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept]
    return df.select(*kept, text).mapInArrow(run, ", ".join([*fields, f"`{ids}` array<int>"]))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text of its ids; NULL ids give an empty text."""
    kept = [c for c in df.columns if c != text]
    cap_arrow_batches(df.sparkSession, ARROW_ROWS, ARROW_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in _slices(batches):
            texts = pa.array([text_of(table, i or []) for i in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], texts], [*kept, text])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept]
    return df.select(*kept).mapInArrow(run, ", ".join([*fields, f"`{text}` string"]))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: ids and the text decoded
    from them, hashed where they are made instead of being moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path).bytes_of
        signs = [str(i) for i in range(len(table))]
        with of_one_task(encoder(path)) as own:
            for batch in _slices(batches):
                counts, hashed, decoded = [], [], []
                for array in own.encode_all(batch.column(text)):
                    ids = array.tolist()
                    counts.append(len(ids))
                    hashed.append(hashlib.sha256(",".join(map(signs.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(text_of(table, ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
