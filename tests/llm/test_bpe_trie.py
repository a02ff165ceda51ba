"""The walk over the trie looks only at tokens that can end a prefix."""

import random

from batchlens.llm import bpe_trie, vocabulary
from batchlens.llm.token_files import library_tokenizer


class Counted(dict):
    asked = 0

    def get(self, *args):
        Counted.asked += 1
        return super().get(*args)


def test_few_tokens_are_tried():
    path = vocabulary.default_path()
    words = vocabulary.Vocabulary(path)
    rng = random.Random(9)
    parts = ["tion", "ing", "straße", "über", "pre", "la", "niño", "ment", "  ", "x", "ка", "日本", "-_", "42", "'s"]
    made = sorted({"".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(600)})
    pieces = sorted({p.encode() for w in made for p in words.pieces(" " + w)})
    encoder = bpe_trie.TrieEncoder(words)
    words.id_of = Counted(words.id_of)
    found = list(encoder._walk(pieces))
    prefixes, before = 0, b""
    for piece in pieces:
        shared = next((n for n, (a, b) in enumerate(zip(piece, before)) if a != b), min(len(piece), len(before)))
        prefixes, before = prefixes + len(piece) - shared, piece
    assert Counted.asked <= 3 * prefixes
    library = library_tokenizer(path)
    expected = [tuple(library.encode(p.decode(), add_special_tokens=False).ids) for p in pieces]
    assert found == expected


def test_known_words_are_not_looked_up():
    words = vocabulary.Vocabulary(vocabulary.default_path())
    encoder = bpe_trie.TrieEncoder(words)
    pieces = sorted({f" {a}{b}".encode() for a in ("pre", "tion", "über", "x") for b in ("ing", "ment", "ка", "42")})
    first = list(encoder._walk(pieces))
    words.id_of, Counted.asked = Counted(words.id_of), 0
    assert list(encoder._walk(pieces)) == first and Counted.asked == 0


def test_what_a_walk_keeps_is_forgotten(monkeypatch):
    monkeypatch.setattr(bpe_trie, "SEAMS_KEPT", 50)
    path = vocabulary.default_path()
    encoder, library, rng = bpe_trie.TrieEncoder(vocabulary.vocabulary(path)), library_tokenizer(path), random.Random(3)
    for _ in range(20):
        pieces = sorted({bytes(rng.choices(b"aeinrst", k=rng.randint(1, 9))) for _ in range(30)})
        expected = [tuple(library.encode(p.decode(), add_special_tokens=False).ids) for p in pieces]
        assert list(encoder._walk(pieces)) == expected
        assert encoder._seams_kept < 50 + 30 * 9 * 7


def test_batches_are_bounded_and_decoding_needs_no_trie(spark):
    path = vocabulary.default_path()
    df = spark.createDataFrame([(1, "a text, \n\n and  more"), (2, None)], "doc_id long, text string")
    found = bpe_trie.decode(bpe_trie.encode(df, path), path).collect()
    assert {r.doc_id: r.text for r in found} == {1: "a text, \n\n and  more", 2: ""}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= bpe_trie.ARROW_BYTES
    vocabulary.vocabulary.cache_clear()
    assert vocabulary.token_bytes(path)[2] and not vocabulary.vocabulary.cache_info().currsize
