"""The parts of the operators on their own."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchlens.llm import bpe_trie, gru, jaccard, language, lm, quality, sharding, token_files
from batchlens.llm.components import components
from batchlens.llm.tables import by_bytes
from batchlens.llm.vocabulary import default_path, library_tokenizer


@pytest.mark.parametrize("rows", [1, 2, 3, 24, 1000])
def test_permutation(spark, rows):
    df = spark.range(rows).select(F.col("id"), sharding.permuted(F.col("id"), rows, 5).alias("p"))
    df = df.withColumn("back", sharding.unpermuted(F.col("p"), rows, 5))
    found = df.collect()
    assert sorted(r.p for r in found) == list(range(rows)) and all(r.back == r.id for r in found)


def test_binomial_bound(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.02), (20, 4000, 0.01), (5, 5, 0.5), (0, 200_000, 0.01)]
    for k, n, p in cases:
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_at_most(F.lit(k), F.lit(n), p).alias("b")).first().b
        assert got == pytest.approx(min(1.0, exact), rel=1e-9, abs=1e-300)


def test_cutoffs_lose_few_good_documents(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(4000):
        good = i % 4 != 0
        symbols = 0 if good and rng.random() < 0.999 else rng.randint(30, 200)
        rows.append((i, "aa" if i % 2 else None, 100, 500, symbols, 0, 10, False))
        labels.append((i, int(good)))
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, base_failed boolean")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rules = quality.default_rules()
    cutoffs = {(r.stratum, r.rule): r.cutoff for r in quality.choose_cutoffs(scored, known, rules).collect()}
    assert {rule for _, rule in cutoffs} == {"symbols"} and set(cutoffs) <= {("aa", "symbols"), (None, "symbols")}
    judged = quality.with_verdict(scored, quality.choose_cutoffs(scored, known, rules), rules).collect()
    lost = sum(not r.kept for r in judged if r.doc_id % 4)
    assert lost <= 0.03 * 3000 and sum(not r.kept for r in judged) > 400


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    expected = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == expected and len(got) == len(expected)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_byte_codes(values):
    numbers = np.array(values, dtype=np.uint32)
    control, data = token_files.pack(numbers)
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'aeirstABCé日🎉　\xa0"), st.characters(codec="utf-8")), max_size=60))
def test_encoders_agree_with_the_library(text):
    path = default_path()
    expected = library_tokenizer(path).encode(text, add_special_tokens=False).ids
    assert next(bpe_trie.encoder(path).encode_all([text])).tolist() == expected
    assert next(token_files.encoder(path).encode_all([text])).tolist() == expected
    assert bpe_trie.trie(path).decode(expected) == text


def test_chunks_are_forgotten(monkeypatch):
    from batchlens.llm import vocabulary

    monkeypatch.setattr(vocabulary, "CHUNKS_KEPT", 20)
    path = default_path()
    encoder = vocabulary.ChunkEncoder(vocabulary.vocabulary(path), bpe_trie.trie(path).encode_new)
    rng = random.Random(4)
    for _ in range(30):
        text = " ".join(rng.choice(["again", "once" + str(rng.random())]) for _ in range(12))
        expected = library_tokenizer(path).encode(text, add_special_tokens=False).ids
        assert next(encoder.encode_all([text])).tolist() == expected


def test_character_models_sum_to_one():
    text = "abracadabra banana cabana"
    model = language.fit({"x": [text] * 3, "y": ["zyzzyva " * 5]})
    letters = sorted(set(text.replace(" ", "")))

    def bits_before_close(t):
        bits, n = model.scores([t])
        return bits[0][0] * n[0] - _close(model, t)

    for context in ("ab", "na", "ca"):
        # what follows the context: a letter, or the space that closes the text
        total = 2.0 ** -_close(model, context)
        total += sum(2.0 ** (bits_before_close(context) - bits_before_close(context + c)) for c in letters)
        assert 0.9 < total <= 1.001


def _close(model, text):
    codes = language.codes_of(text)
    hashes = language.gram_hashes(codes, language.ORDER)
    total, at = 0.0, len(codes) - 1
    for n in range(min(language.ORDER, at + 1), 0, -1):
        place = model.found[n - 1].find(hashes[n - 1][at : at + 1])[0]
        if place >= 0:
            return -(total + model.log_prob[n - 1][place][0]) / np.log10(2)
        if n > 1:
            context = model.found[n - 2].find(hashes[n - 2][at - 1 : at])[0]
            total += model.back_off[n - 2][context][0] if context >= 0 else 0
    return -(total + model.floor) / np.log10(2)


def test_language_models_tell_languages_apart():
    rng = random.Random(5)
    make = lambda stock: " ".join(rng.choice(stock) for _ in range(200))
    stocks = {"aa": ["the", "there", "these", "then"], "bb": ["und", "unter", "uns", "dort"]}
    model = language.fit({k: [make(v)] for k, v in stocks.items()})
    for k, stock in stocks.items():
        bits, _ = model.scores([make(stock)])
        assert model.languages[int(bits[0].argmin())] == k


def test_gradients_and_whole_text_scores():
    rng = np.random.default_rng(0)
    shape = gru.Shape(12, 4, 5)
    model = gru.GRU(shape, np.arange(12, 0, -1.0))
    for k in ("class", "word"):
        model.p[k] = rng.standard_normal(model.p[k].shape).astype(np.float32) * 0.3
    text = np.append(rng.integers(0, 11, 40), 11)
    # one text in windows of any length, beside others, scores the same
    whole = model.score([text], 11, window=100)[0]
    assert model.score([text, text[-3:], text[20:], text[30:]], 11, lanes=2, window=7)[0] == pytest.approx(whole, rel=1e-4)
    # probabilities of all tokens after one state sum to one
    state = rng.standard_normal((1, 5)).astype(np.float32)
    logs = model.log_probs(np.repeat(state, 12, axis=0), np.arange(12))
    assert np.exp(logs).sum() == pytest.approx(1, rel=1e-4)
    lanes = np.stack([np.tile([1, 2, 3, 4], 9)] * 8).T
    before = None
    for _ in range(60):
        _, loss = model.train(lanes[:-1], lanes[1:], np.ones_like(lanes[1:], bool), np.zeros((8, 5), np.float32), 0.1)
        before = before or loss
    assert loss < 0.3 * before


def _read_by_training(texts, words):
    """What the windows hold of each text, lane by lane."""
    batches = iter([pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + 3], pa.string())}) for i in range(0, len(texts), 3)])
    lanes, names = [[] for _ in range(lm.LANES)], list(range(lm.LANES))
    before = dict.fromkeys(names, words.end)
    for inputs, targets, used, kept in lm._windows(batches, words):
        names = [names[k] for k in kept]
        for k, lane in enumerate(names):
            for i, t, u in zip(inputs[:, k], targets[:, k], used[:, k], strict=True):
                if u:
                    assert i == before[lane]
                    lanes[lane].append(int(t))
                    before[lane] = t
    found = []
    for lane in lanes:
        own = []
        for t in lane:
            own.append(t)
            if t == words.end:
                found.append(own)
                own = []
        assert not own
    return found


@pytest.mark.parametrize("lanes", [1, 4, 256])
def test_training_reads_whole_texts(monkeypatch, lanes):
    monkeypatch.setattr(lm, "LANES", lanes)
    stock = [f"w{i}".encode() for i in range(50)]
    words = lm.Vocabulary({w: i for i, w in enumerate(stock)}, np.arange(50, 0, -1), 40, 2000, 51, 9)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(n)) for n in (1, 700, 15, 16, 17, 33, 3)] + [None, ""]
    expected = [[min(words.place.get(w, 40), 40) for w in lm.tokens_of(t)] + [words.end] for t in texts]
    assert sorted(_read_by_training(texts, words)) == sorted(expected)


def test_training_starts_texts_from_a_zero_state():
    shape = gru.Shape(6, 3, 4)
    rng = np.random.default_rng(1)
    inputs = np.array([[5], [1], [2], [5], [3], [1]])
    targets = np.array([[1], [2], [5], [3], [1], [4]])
    used = np.ones_like(targets, bool)
    carried = rng.standard_normal((1, 4)).astype(np.float32)
    one, two = gru.GRU(shape, np.arange(6, 0, -1.0)), gru.GRU(shape, np.arange(6, 0, -1.0))
    state, loss = one.train(inputs, targets, used, carried, 0.1, 5)
    # the same two texts side by side, as lanes of their own
    side = lambda x: np.concatenate([x[:3], x[3:]], axis=1)
    other, other_loss = two.train(side(inputs), side(targets), side(used), np.zeros((2, 4), np.float32), 0.1)
    assert loss == pytest.approx(other_loss, rel=1e-5) and np.allclose(state[0], other[1], atol=1e-6)
    assert np.allclose(one.vector(), two.vector(), atol=1e-4)


def test_networks_trained_side_by_side_are_those_trained_alone(monkeypatch):
    monkeypatch.setattr(lm, "LANES", 4)
    rng = np.random.default_rng(4)
    model = gru.GRU(gru.Shape(42, 5, 6), np.arange(42, 0, -1.0))
    # One shard ends long before the others, one has no text.
    shards = [[np.append(rng.integers(0, 41, n), 41) for n in sizes] for sizes in ((3, 40, 200, 17, 16), (5,), (), (90, 90, 0, 31))]
    networks, seen = lm._trained([iter(texts) for texts in shards], model, 41)
    assert seen.tolist() == [sum(map(len, texts)) for texts in shards]
    assert np.array_equal(networks.vector(2), model.vector())
    for k, texts in enumerate(shards):
        alone = gru.GRU(gru.Shape(42, 5, 6), np.arange(42, 0, -1.0))
        state = np.zeros((4, 6), np.float32)
        for inputs, targets, used, kept in lm._lanes(iter(texts), 41):
            rate = lm.RATE * int(used.sum()) / (lm.STEPS * 4)
            state, _ = alone.train(inputs, targets, used, state[kept], rate, 41)
        assert np.allclose(networks.vector(k), alone.vector(), atol=1e-4)


def test_texts_of_a_task_go_to_their_shards():
    words = lm.Vocabulary({b"a": 0, b"b": 1}, np.array([5, 3]), 2, 20, 4, 2)
    batch = pa.RecordBatch.from_pydict({"shard": [9, 8, 9, 11, 8], "text": ["a", "B b", None, "x\u00a0y z", " a\x0b"]})
    streams = lm._streams(lm._numbered(iter([batch.slice(0, 2), batch.slice(2)]), words), range(8, 12))
    assert [[t.tolist() for t in s] for s in reversed(streams)] == [[[2, 2, 3]], [], [[0, 3], [3]], [[1, 1, 3], [0, 3]]]


def test_texts_are_cut_as_their_tokens():
    texts = ["", " ", "a  B\tc\nD\x0bE\x0cF\rg ", "\u00c4\u00a0x \u2003y", None, "\x1c a\x00b", "I\u0307 \u0130"]
    flat, sizes = lm._cut(pa.array(texts, pa.string()))
    expected = [lm.tokens_of(t) for t in texts]
    assert flat.to_pylist() == [w for own in expected for w in own] and sizes.tolist() == [len(own) for own in expected]


def test_words_are_counted_over_many_parts(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.expovariate(0.02))}" for _ in range(30)) for _ in range(300)] + [None, "", " "]
    expected = Counter(w for t in texts for w in lm.tokens_of(t))
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    for held in (50, 400_000):
        monkeypatch.setattr(lm, "WORDS_HELD", held)
        monkeypatch.setattr(lm, "TEXT_AT_ONCE", 500)
        assert {bytes(r["word"]): r["n"] for r in lm.word_counts(df).collect()} == expected


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_runs_keep_the_recall_of_sets_that_hold_each_other(depth):
    plan = jaccard.Plan(depth=depth)
    meets = 1.0
    for _ in range(depth):
        meets = 1 - math.exp(-2 * 0.8 * meets)
    assert (1 - meets) ** plan.runs <= 1 - plan.recall < (1 - meets) ** (plan.runs - 1)


def test_every_language_has_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_CHARS", 4000)
    monkeypatch.setattr(language, "STRETCH", 200)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefg ") for _ in range(n))
    one, copied = text(100), text(300)
    rows = [("few", text(50_000)) for _ in range(5)] + [("one", one)] * 50 + [("long", text(90_000))]
    rows += [("many", text(100)) for _ in range(300)] + [("copies", copied)] * 500
    rows += [("copies", text(150)) for _ in range(60)] + [(None, "x"), ("none", None), ("small", "ab"), ("small", "cd")]
    found = language.training_sample(spark.createDataFrame(rows, "lang string, text string").repartition(7)).collect()
    own = {k: sorted(r.text for r in found if r.lang == k) for k in {r.lang for r in found}}
    assert set(own) == {"few", "one", "long", "many", "copies", "small"}
    assert [len(t) for t in own["few"]] == [800] * 5 and [len(t) for t in own["long"]] == [4000]
    assert all(any(t in whole for k, whole in rows if k == "few") for t in own["few"])
    assert own["one"] == [one] and own["small"] == ["ab", "cd"] and len(own["many"]) == 40
    assert len(set(own["copies"])) == len(own["copies"]) and 4000 <= sum(map(len, own["copies"])) < 4200
    again = language.training_sample(spark.createDataFrame(rows, "lang string, text string").repartition(3)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_languages_of_one_text_are_learnt(spark):
    stocks = {f"l{i}": [chr(97 + i) + chr(97 + (i * j) % 26) for j in range(1, 6)] for i in range(12)}
    rng = random.Random(10)
    rows = [(k, " ".join(rng.choice(v) for _ in range(60))) for k, v in stocks.items()] * 20
    models = language.train(spark.createDataFrame(rows, "lang string, text string"))
    assert models.languages == sorted(stocks) and np.isinf(models.limits).all()
    bits, _ = models.scores([t for _, t in rows[:12]])
    assert [models.languages[int(b.argmin())] for b in bits] == [k for k, _ in rows[:12]]


def test_known_words_of_equal_counts(spark):
    rows = [(f"often{i}".encode(), 9) for i in range(5)] + [(f"once{i}".encode(), 1) for i in range(4000)]
    counts = spark.createDataFrame(rows, "word binary, n bigint")
    found = lm.learn_vocabulary(counts, 3, network_words=50, known_words=1000)
    again = lm.learn_vocabulary(counts.repartition(7), 3, network_words=50, known_words=1000)
    assert found.place == again.place and found.network == 50
    assert abs(len(found.place) - 1000) < 120 and {w for w, i in found.place.items() if i < 5} == {f"often{i}".encode() for i in range(5)}
    assert (found.tokens, found.distinct) == (4048, 4006)
    assert len(lm.learn_vocabulary(counts, 3).place) == 4005


def test_slices_hold_so_many_bytes():
    texts = ["", None, "abc", "\u00c4", "a" * 12, "", "ab", "cd", "efg"]
    parts = list(by_bytes(iter([pa.RecordBatch.from_pydict({"text": texts})]), "text", 5))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(sum(len((t or "").encode()) for t in p.column("text").to_pylist()[1:]) <= 5 for p in parts) and len(parts) == 3
    nothing = pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})
    assert list(by_bytes(iter([nothing]), "text", 5)) == []


def test_known_chunks_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, *of):
            Counted.asked += 1
            return super().get(*of)

        def __contains__(self, w):
            Counted.asked += 1
            return super().__contains__(w)

        def __getitem__(self, w):
            Counted.asked += 1
            return super().__getitem__(w)

    own = token_files.encoder(default_path())
    texts = ["one two three", "three  four, <s> one", "", "one"]
    before = [i.tolist() for i in own.encode_all(texts)]
    own._spaced, own._plain = Counted(own._spaced), Counted(own._plain)
    assert [i.tolist() for i in own.encode_all(["one three", "three two"])] == [i.tolist() for i in token_files.encoder(default_path()).encode_all(["one three", "three two"])]
    assert Counted.asked == 4
    assert [i.tolist() for i in own.encode_all(texts)] == before == library_tokenizer_ids(texts)


def library_tokenizer_ids(texts):
    return [library_tokenizer(default_path()).encode(t, add_special_tokens=False).ids for t in texts]


def test_packed_rows_of_all_lengths():
    rng = random.Random(12)
    rows = [[rng.choice([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]) for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 0, 9, 0)]
    counts = np.array([len(r) for r in rows])
    control, data = token_files.pack_rows(np.array(sum(rows, []), dtype=np.uint32), counts)
    for r, c, d in zip(rows, control.to_pylist(), data.to_pylist(), strict=True):
        assert (len(c), len(d)) == (-(-len(r) // 4), sum(max(1, -(-v.bit_length() // 8)) for v in r))
        assert token_files.unpack(c, d, len(r)).tolist() == r
    whole = token_files.unpack_rows(b"".join(control.to_pylist()), b"".join(data.to_pylist()), counts)
    assert whole.tolist() == sum(rows, [])


def test_texts_are_encoded_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = [(None if i == 7 else i // 2, None if i % 9 == 0 else f"text {i}, and  {'more ' * i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = df.withColumn("text", F.udf(seen, "string").asNondeterministic()("text"))
    path, folder = default_path(), str(tmp_path)
    token_files.write_ids(texts, folder, path)
    assert read.value == len(rows)
    library = library_tokenizer(path)
    expected = sorted((k is not None, k or 0, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in rows)
    found = token_files.read_ids(spark, folder).orderBy("start").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in found) == expected
    starts = np.cumsum([0, *[r.n_tokens for r in found]])[:-1]
    assert [r.start for r in found] == starts.tolist() and [r.doc_id for r in found][0] is None
