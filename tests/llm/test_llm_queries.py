"""Every query against a brute-force version, on texts of all kinds."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from batchlens.llm import queries, stages
from batchlens.llm.vocabulary import default_path, library_tokenizer

ALL = queries.queries()


def run(spark, name, sf):
    return [r.asDict() for r in ALL[name](spark, sf).collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: r["doc_id"])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def in_order(documents):
    return sorted(documents, key=lambda d: d["doc_id"])


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables(spark, empty_sf, name):
    df = ALL[name](spark, empty_sf)
    assert {"doc_id", "conv_id", "phrase"} & set(df.columns) and df.collect() == []


def test_sharding(spark, sf, documents):
    rows = run(spark, "op1_sharding", sf)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted(
        (d["doc_id"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode())) for d in documents
    )
    slots = collections.defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    key = lambda r: tuple(map(str, r.values()))
    assert sorted(rows, key=key) == sorted(run(spark, "op1_sharding", sf), key=key)


def test_quality(spark, sf, documents):
    rows = by_id(run(spark, "op4_quality", sf))
    assert len(rows) == len(documents)
    for d, r in zip(in_order(documents), rows, strict=True):
        words = plain(d["text"])
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        lines = [x for x in (d["text"] or "").split("\n") if plain(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        expected = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d["text"] or "")),
            len(lines) - len(set(lines)), len(covered), failed,
        )
        assert tuple(r[c] for c in queries.quality.FEATURES) == expected
        assert not (failed and r["kept"])


def folded(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(documents, items):
    windows = collections.defaultdict(set)
    for item in items:
        words = folded(item["text"])
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add(str(item["item_id"]))
    for d in in_order(documents):
        words, hit, found = folded(d["text"]), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                own = windows.get(tuple(words[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        yield d, len(words), len(hit), found


def test_decontamination(spark, sf, documents, items):
    rows = by_id(run(spark, "op6_decontamination", sf))
    for (d, n, hit, found), r in zip(contamination(documents, items), rows, strict=True):
        assert (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) == (d["doc_id"], n, hit, len(found))
        assert r["items_sha256"] == sha(",".join(sorted(found)))
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
    assert sum(r["contaminated"] for r in rows) == 2


def shingles(text):
    words = plain(text)
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def classes(documents):
    docs = in_order(documents)
    sets = [shingles(d["text"]) for d in docs]
    links, root = [0] * len(docs), list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return [(d["doc_id"], docs[r]["doc_id"], n) for d, r, n in zip(docs, root, links, strict=True)]


def test_jaccard(spark, sf, documents):
    rows = by_id(run(spark, "op3_jaccard", sf))
    assert [(r["doc_id"], r["class_id"], r["n_links"]) for r in rows] == classes(documents)
    assert sum(r["n_links"] > 0 for r in rows) == 7


@pytest.mark.parametrize("plan", [{"bucket": 2, "depth": 2}, {"bucket": 2, "depth": 1, "cluster_texts": 1}])
def test_jaccard_splits_and_blocks(spark, sf, documents, plan):
    df = queries.documents(spark, sf)
    rows = queries.jaccard.similar_texts(df, plan=queries.jaccard.Plan(**plan)).collect()
    assert sorted(tuple(r) for r in rows) == sorted(classes(documents))


def test_substrings(spark, sf, documents):
    rows = by_id(run(spark, "op7_substrings", sf))
    first = {}
    for d in in_order(documents):
        words = plain(d["text"])
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), d["doc_id"])
    for d, r in zip(in_order(documents), rows, strict=True):
        words = plain(d["text"])
        gone = {i + j for i in range(len(words) - 12) if first[tuple(words[i : i + 13])] < d["doc_id"] for j in range(13)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(words), len(gone), sha(kept))


def test_substrings_of_two_texts_under_one_id(spark, tmp_path):
    shared, own = [f"w{i}" for i in range(20)], [f"u{i}" for i in range(20)]
    rows = [(1, " ".join(shared)), (2, " ".join([*shared, "x"])), (2, " ".join(own)), (2, " ".join(own)), (2, None), (None, " ".join(shared)), (3, " ".join(own))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = queries.substrings.digests(docs).collect()
    expected = [(1, 20, 0, shared), (2, 21, 20, ["x"]), (2, 20, 0, own), (2, 20, 0, own), (2, 0, 0, []), (None, 20, 0, shared), (3, 20, 20, [])]
    expected = [(k, n, gone, sha(" ".join(kept))) for k, n, gone, kept in expected]
    assert collections.Counter(map(tuple, found)) == collections.Counter(expected)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
        assert collections.Counter(db.execute(queries.ORACLE["op7_substrings"]).fetchall()) == collections.Counter(expected)


def test_spans_follow_their_source(spark, sf, documents):
    text = {d["doc_id"]: plain(d["text"]) for d in documents}
    found = queries.substrings.spans(queries.documents(spark, sf)).collect()
    assert found
    for r in found:
        own = text[r.doc_id][r.start : r.start + r.n_words]
        assert r.source < r.doc_id and own == text[r.source][r.source_start : r.source_start + r.n_words]


def test_substrings_by_paths(spark):
    """Many texts of a few words, in which paths branch, repeat, loop and end in all ways."""
    rng = np.random.default_rng(3)
    passages = [[f"p{p}w{i}" for i in range(int(rng.integers(13, 60)))] for p in range(6)] + [["a"] * 30, ["a", "b"] * 12]
    rows = [(None, " ".join(passages[0])), (5, None), (6, ""), (7, "short text")]
    for n in range(120):
        words = []
        for _ in range(int(rng.integers(1, 6))):
            passage = passages[int(rng.integers(len(passages)))]
            start = int(rng.integers(0, max(1, len(passage) - 14)))
            words += passage[start : start + int(rng.integers(13, 50))] + [f"u{n}"] * int(rng.integers(0, 2))
        rows.append((int(rng.integers(0, 90)), " ".join(words)))
    rows += rows[-20:]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    first = {}
    for key, text in rows:
        words = plain(text)
        for i in range(len(words) - 12 if key is not None else 0):
            window = tuple(words[i : i + 13])
            first[window] = min(first.get(window, key), key)
    expected = []
    for key, text in rows:
        words = plain(text)
        gone = set()
        for i in range(len(words) - 12 if key is not None else 0):
            if first[tuple(words[i : i + 13])] < key:
                gone.update(range(i, i + 13))
        expected.append((key, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert collections.Counter(map(tuple, queries.substrings.digests(docs).collect())) == collections.Counter(expected)


def test_substrings_settled_in_small_parts(spark, sf, documents, monkeypatch):
    """Paths between tasks and runs within them give the same."""
    whole = sorted(map(tuple, queries.op7_substrings(spark, sf).collect()))
    monkeypatch.setattr(queries.substrings, "ROWS_AT_ONCE", 50)
    assert sorted(map(tuple, queries.op7_substrings(spark, sf).collect())) == whole


def test_paths_have_no_branches(spark):
    """Four edges in a row with a branch after the second, at nodes 1 to 5."""
    rows = [(1, 2, None, 3, 0), (2, 3, 1, None, 1), (3, 4, None, 5, 2), (4, 5, 3, None, 3), (3, 9, 2, None, 40)]
    edges = spark.createDataFrame(
        [(a, b, enter, leave, 7, 70, pos) for a, b, enter, leave, pos in rows],
        "from_node bigint, to_node bigint, enter bigint, leave bigint, source bigint, source_mark bigint, source_pos int",
    )
    found = sorted((r.source_pos, r.n_edges) for r in queries.substrings._paths(edges).collect())
    assert found == [(0, 2), (2, 2), (40, 1)]


def test_runs_are_cut_at_places_of_the_source():
    at = np.concatenate([np.arange(10, 610), np.arange(10, 20)])
    whole = lambda value: np.full(len(at), value)
    runs = queries.substrings.runs_of(whole(9), whole(90), at, whole(2), whole(20), at + 90)
    assert [tuple(map(int, r)) for r in zip(*runs)] == [
        (9, 90, 10, 2, 20, 100, 156 + 12), (9, 90, 166, 2, 20, 256, 256 + 12), (9, 90, 422, 2, 20, 512, 188 + 12),
    ]


def test_spans_that_differ_from_their_source_stay():
    words = [f"w{i}" for i in range(15)]
    span = {"pos": 1, "n_words": 13, "digest": queries.substrings._digest(words[1:14])}
    assert queries.substrings._kept_words(words, False, [span]) == ["w0", "w14"]
    assert queries.substrings._kept_words(words, False, [span | {"digest": b"other"}]) == words


def library_ids(documents):
    tokenizer = library_tokenizer(default_path())
    return [tokenizer.encode(d["text"] or "", add_special_tokens=False).ids for d in in_order(documents)], tokenizer


def test_bpe(spark, sf, documents):
    expected, tokenizer = library_ids(documents)
    rows = by_id(run(spark, "op9_bpe", sf))
    for ids, r in zip(expected, rows, strict=True):
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(text))


def test_token_files(spark, sf, documents):
    expected, _ = library_ids(documents)
    start = 0
    rows = sorted(run(spark, "op5_token_files", sf), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in in_order(documents)]
    for ids, r in zip(expected, rows, strict=True):
        raw = np.array([*ids, 2], dtype="<u4").tobytes()
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids) + 1, zlib.crc32(raw))
        start += len(ids) + 1


def test_language(spark, sf, documents):
    rows = by_id(run(spark, "op8_language", sf))
    for d, r in zip(in_order(documents), rows, strict=True):
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        letters = any(c.isalpha() for c in d["text"] or "")
        assert (r["lang_pred"] in ("aa", "bb")) == letters and (r["lang_pred"] == "und") != letters
        assert 0 <= r["score"] <= 1


def test_lm(spark, sf, documents):
    rows = by_id(run(spark, "op10_lm", sf))
    docs = in_order(documents)
    tokens = [[*(d["text"] or "").encode().lower().split(), None] for d in docs]
    held = [zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs]
    counts = collections.Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    total = sum(counts.values())
    for own, h, r in zip(tokens, held, rows, strict=True):
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in own)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (h, len(own), total)
        assert r["n_known"] == sum(t in counts for t in own)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_pii(spark, sf, documents):
    rows = by_id(run(spark, "op2_pii", sf))
    text = {r["doc_id"]: r["text"] for r in rows}
    before = {d["doc_id"]: d["text"] for d in documents}
    ids = {d["text"][:8]: d["doc_id"] for d in documents if d["text"] and len(d["text"]) > 8}
    contact, card, secret = text[ids["Write to"]], text[ids["Again an"]], text[ids["password"]]
    everything = " ".join([contact, card, secret]).lower()
    for private in ("ann.lee", "firm.com", "555-0188", "10.1.2.3", "4532 0151", "abc123def", "akiaabcdef", "0123456789abcdef", "anna schmidt", "dr. schmidt"):
        assert private not in everything
    # one entity, one surrogate, in the format of each mention
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}|\+1 \d{3}-\d{3}-\d{4}", contact)
    assert len(phones) == 2 and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1])[1:]
    assert re.findall(r"\S+@\S+\.com", contact)[0] == re.findall(r"\S+@\S+\.com", card)[0].rstrip(",")
    number = re.search(r"\d{4} \d{4} \d{4} \d{4}", card)[0].replace(" ", "")
    doubled = [sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(number)]
    assert sum(doubled) % 10 == 0 and number[0] == "4"
    given, family = re.search(r"Mrs\. (\S+) (\S+) met", card).groups()
    assert f"Dr. {family}" in card and f"{given} {family} left" in card
    changed = {i for i in text if text[i] != before[i]}
    assert changed == {r["doc_id"] for r in rows if r["n_entities"]} == {ids["Write to"], ids["Again an"], ids["password"]}


def test_surrogates_stay_distinct(spark):
    kinds = [("ip", f"1.2.{i // 200}.{i % 200}", "") for i in range(400)]
    kinds += [("given", f"Name{i}", "f") for i in range(60)]
    df = spark.createDataFrame(kinds, "kind string, entity string, gender string")
    rows = queries.pii.surrogates(df, "k").collect()
    assert len(rows) == 460 and len({(r.kind, r.surrogate) for r in rows}) == 460


def test_pipeline(spark, sf, documents, items):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = set(docs.columns)
    scored = {r["doc_id"] for r in run(spark, "op4_quality", sf) if r["kept"]}
    kept = stages.quality_rules(spark, docs, sf)
    assert set(kept.columns) == columns and {r.doc_id for r in kept.collect()} == scored
    rest = [d for d in documents if d["doc_id"] in scored]
    single = stages.near_copies(spark, kept, sf)
    own = {i for i, c, _ in classes(rest) if i == c}
    assert sorted(r.doc_id for r in single.collect()) == sorted(own)
    clean = stages.decontaminated(spark, single, sf)
    bad = {d["doc_id"] for d, n, hit, _ in contamination(documents, items) if hit and 20 * hit >= n}
    assert {r.doc_id for r in clean.collect()} == own - bad
    final = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in final) == sorted(own - bad)
    tokenizer = library_tokenizer(default_path())
    for r in final:
        assert r.ids == tokenizer.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


@pytest.mark.parametrize("plan", [{}, {"bucket": 2, "depth": 2}])
def test_near_copies_are_told_by_id_and_text(spark, plan):
    rng = np.random.default_rng(8)
    text = lambda: " ".join(f"w{i}" for i in rng.integers(0, 5000, 60))
    near = lambda t: t + " more"
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [
        (None, a), (None, b), (None, near(b)),  # different texts without an id, and a near copy
        (5, c), (5, d), (5, d),  # different texts under one id, and a repeated row
        (7, e), (None, near(e)),  # a near copy without an id
        (9, f), (9, near(f)),  # near copies under one id
        (None, None), (None, None), (None, "!"), (11, ""), (11, None), (12, near(d)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    jaccard = queries.jaccard
    kept = collections.Counter(tuple(r) for r in jaccard.one_of_each(df, plan=jaccard.Plan(**plan)).collect())
    assert set(kept.values()) == {1}
    assert len([r for r in kept if r in {(None, b), (None, near(b))}]) == 1
    assert len([r for r in kept if r in {(9, f), (9, near(f))}]) == 1
    rest = set(kept) - {(None, b), (None, near(b)), (9, f), (9, near(f))}
    assert rest == {(None, a), (5, c), (5, d), (7, e), (None, None), (None, "!"), (11, ""), (11, None)}
    found = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard.similar_texts(df).collect())
    assert found[(5, 5, 0)] == 1 and found[(5, 5, 2)] == 2 and found[(12, 5, 2)] == 1
    assert found[(None, 7, 1)] == 1 and found[(None, None, 1)] == 2


def test_secrets_in_capitals(spark):
    token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    texts = [
        f'XQ JUNK TOKEN = "{token}" MORE', f"again {token.lower()}.", "PASSWORD=HUNTER2X; Token=Ab3dEf", token[:20].lower() + token[20:],
        "ABCDEFABCDEFABCDEFABCDEFABCDEFAB",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = {r.doc_id: r for r in queries.pii.pseudonymise(df, "k").collect()}
    assert [new[i].n_entities for i in range(5)] == [1, 1, 2, 1, 1]
    drawn = re.fullmatch(r'XQ JUNK TOKEN = "([0-9A-F]{40})" MORE', new[0].text)[1]
    assert drawn != token and new[1].text == f"again {drawn.lower()}."
    assert new[3].text.lower() == drawn.lower() and new[3].text not in (drawn, drawn.lower())
    assert re.fullmatch(r"PASSWORD=[A-Z]{6}[0-9][A-Z]; Token=[A-Z][a-z][0-9][a-z][A-Z][a-z]", new[2].text)
    assert "HUNTER2X" not in new[2].text and "Ab3dEf" not in new[2].text
    assert re.fullmatch("[0-9A-F]{32}", new[4].text) and new[4].text != texts[4]


def test_substring_marks_take_no_room_where_ids_tell_texts_apart(spark):
    shared = " ".join(f"w{i}" for i in range(20))
    single = [(1, shared), (2, shared), (2, shared), (3, shared + " x"), (None, "a"), (None, "b")]
    docs = queries.substrings._marked(spark.createDataFrame(single, "doc_id bigint, text string").coalesce(1), "doc_id", "text")
    seeds = queries.substrings._seed_rows(docs).collect()
    assert {r.mark for r in seeds} == {0} and {r.key for r in seeds} == {1, 2, 3}
    assert any(r.salt for r in seeds) and all(0 <= r.salt < queries.substrings.SALTS for r in seeds)
    clashing = spark.createDataFrame([*single, (2, None), (3, shared)], "doc_id bigint, text string")
    marks = collections.defaultdict(set)
    for r in queries.substrings._marked(clashing, "doc_id", "text").collect():
        marks[r.key].add((r.mark, r.text))
    assert {m for m, _ in marks[1]} == {0} and len({m for m, _ in marks[2]}) == len(marks[2]) == 2 and len({m for m, _ in marks[3]}) == 2


def test_substring_tables_leave_no_shuffles(spark):
    def shuffles():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}

    before = shuffles()
    counted = spark.range(5000).withColumn("x", queries.F.col("id") % 97).groupBy("x").count()
    kept = queries.substrings._kept(counted, "counted")
    assert not shuffles() - before
    assert kept.count() == 97 and spark.conf.get(queries.substrings._DROP_SHUFFLES) == "false"
