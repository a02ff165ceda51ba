"""Collocations from sorted streams of word sequence counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import written
from batchlens.llm.words import LOWER, UPPER, mixed, window_hashes
from batchlens.plans.partitions import cap_arrow_batches

# What ends a piece; words in it stand between spaces and tabs.
DELIMITERS = ".,;:!?\x0a\x0b\x0c\x0d"
NO_LANGUAGE = "und"
BREAK, NOTHING = 0, 1  # codes that no word has
WORD = 8  # bytes of a word's code
SLICE_BYTES = 250_000
# Rows of codes are large.
ARROW_ROWS, ARROW_BYTES = 500, 8_000_000
_TABLE = bytes.maketrans((UPPER + "\t" + DELIMITERS).encode(), (LOWER + " " + "\n" * len(DELIMITERS)).encode())


@dataclass(frozen=True)
class Plan:
    """``filter_bits``: size of the bitmaps sent to tasks (2 ** 26 bits are 8 MB,
    whatever the corpus). They only spare work: counts are exact without them."""

    longest: int = 5
    least: int = 100
    first: int = 2000
    filter_bits: int = 26
    buffer: int = 1_000_000
    known_words: int = 100_000


class _Codes(dict):
    """64-bit codes of words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = max(xxhash.xxh64_intdigest(word), 2)
        return value


def _slices(texts: list[bytes]) -> Iterator[bytes]:
    """Texts put together, a break between them, cut at breaks only."""
    held, size = [], 0
    for t in texts:
        t = t.translate(_TABLE)
        while len(t) > SLICE_BYTES and (cut := t.find(b"\n", SLICE_BYTES)) >= 0:
            yield t[:cut]
            t = t[cut + 1 :]
        held.append(t)
        size += len(t)
        if size >= SLICE_BYTES:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


_READ = "lang string, codes binary, gram binary, word binary, n bigint"


def _read(df: DataFrame, lang: str, text: str, plan: Plan) -> DataFrame:
    """All texts as codes, ``(lang, codes)``, and counts of words per task,
    ``(lang, gram, word, n)``, in one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        names = ["lang", "codes", "gram", "word", "n"]
        codes = _Codes({b"\n": BREAK, b"": NOTHING})
        counts: dict[str, dict[int, int]] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            words = {v: w for w, v in codes.items()}
            for name, own in counts.items():
                values = np.fromiter(own, dtype=np.uint64, count=len(own)).astype(">u8").tobytes()
                grams = [values[i : i + WORD] for i in range(0, len(values), WORD)]
                columns = [[name] * len(own), [None] * len(own), grams, [words[v] for v in own], list(own.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            counts.clear()
            codes.clear()
            codes.update({b"\n": BREAK, b"": NOTHING})

        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(t)
            for name, texts in by_lang.items():
                own = counts.setdefault(name, {})
                for body in _slices(texts):
                    pieces = body.replace(b"\n", b" \n ").split(b" ")
                    found = np.fromiter(map(codes.__getitem__, pieces), dtype=np.uint64, count=len(pieces))
                    found = found[found != NOTHING]
                    values, times = np.unique(found[found != BREAK], return_counts=True)
                    for v, n in zip(values.tolist(), times.tolist(), strict=True):
                        own[v] = own.get(v, 0) + n
                    columns = [[name], [found.tobytes()], [None], [None], [None]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
                    if len(codes) > plan.known_words:
                        yield from counted()
                        own = counts.setdefault(name, {})
        yield from counted()

    slim = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    return written(slim.mapInArrow(run, _READ), "codes")


def _salted(hashes: np.ndarray, lang: str) -> np.ndarray:
    return mixed(hashes ^ np.uint64(xxhash.xxh64_intdigest(lang)))


def _bit(frequent: DataFrame, plan: Plan) -> np.ndarray:
    """A bitmap of ``frequent(hash)``, of one size always, made on executors."""
    place = F.col("hash").bitwiseAND((1 << plan.filter_bits) - 1) + 1
    rows = frequent.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
    parts = rows.groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
    bits = np.zeros(1 << (plan.filter_bits - 3), dtype=np.uint8)
    for r in parts.toLocalIterator():
        own = np.frombuffer(r.bits, dtype=np.uint8)
        at = (r.b - 1) * len(own)
        bits[at : at + len(own)] = own[: len(bits) - at]
    return bits


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _open(codes: np.ndarray, lang: str, filters: list[np.ndarray]) -> list[np.ndarray]:
    """For each length up to one beyond the filters, at which places a sequence of
    so many words may be frequent: both sequences one word shorter are."""
    may = [codes != BREAK]
    for size, bits in enumerate(filters, 1):
        own = may[-1].copy()
        at = np.flatnonzero(own)
        if len(at):
            own[at] = _holds(bits, _salted(_hashes(codes, at, size), lang))
        may[-1] = own
        may.append(own[:-1] & own[1:])
    return may


def _hashes(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return mixed(codes[at]) if size == 1 else window_hashes(codes, size)[at]


def _blocks(read: DataFrame) -> DataFrame:
    return read.where(F.col("codes").isNotNull()).select("lang", "codes")


def _sequence_counts(read: DataFrame, size: int, filters, plan: Plan) -> DataFrame:
    """``(hash, n)`` of sequences of ``size`` words, summed in the task as far as
    ``plan.buffer`` of them allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        values, times = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new = np.concatenate([values, *held])
            each = np.ones(len(new), dtype=np.int64)
            each[: len(times)] = times
            return _summed(new, each)[1:]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(times, pa.int64())], ["hash", "n"])

        for batch in batches:
            for lang, codes in zip(batch.column("lang").to_pylist(), batch.column("codes"), strict=True):
                codes = np.frombuffer(codes.as_buffer(), dtype=np.uint64)
                at = np.flatnonzero(_open(codes, lang, filters.value)[size - 1])
                held.append(_salted(_hashes(codes, at, size), lang) if len(at) else np.zeros(0, dtype=np.uint64))
                count += len(at)
                if count >= plan.buffer:
                    values, times = merged()
                    held, count = [], 0
                    if len(values) >= plan.buffer:
                        yield out()
                        values, times = values[:0], times[:0]
        values, times = merged()
        yield out()

    return _blocks(read).mapInArrow(run, "hash bigint, n bigint")


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places of distinct keys, the keys, and the sums of their ``times``."""
    values, first, place = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.zeros(len(values), dtype=np.int64)
    np.add.at(sums, place, times)
    return first, values, sums


def _windows(read: DataFrame, filters, plan: Plan) -> DataFrame:
    """``(lang, gram, n)``: from each place the longest sequence that may be
    frequent, two words at least, filled up with breaks.

    Each task sends a row for every sequence it holds, most tasks the same ones,
    so one task per slot reads the codes, not one per file split; what a task
    holds is bounded by ``plan.buffer``.
    """
    longest = plan.longest
    slots = read.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        count = 0

        def merge() -> None:
            for lang, parts in held.items():
                before, n = known.get(lang, (np.zeros((0, longest), dtype=np.uint64), np.zeros(0, dtype=np.int64)))
                rows = np.concatenate([before, *parts])
                each = np.ones(len(rows), dtype=np.int64)
                each[: len(n)] = n
                key = np.zeros(len(rows), dtype=np.uint64)
                for j in range(longest):
                    key = mixed(key * np.uint64(31) + rows[:, j])
                first, _, sums = _summed(key, each)
                known[lang] = (rows[first], sums)
            held.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (rows, times) in known.items():
                grams = rows.astype(">u8").tobytes()
                step = longest * WORD
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(rows), pa.string()),
                        pa.array([grams[i : i + step] for i in range(0, len(grams), step)], pa.binary()),
                        pa.array(times, pa.int64()),
                    ],
                    ["lang", "gram", "n"],
                )
            known.clear()

        for batch in batches:
            for lang, codes in zip(batch.column("lang").to_pylist(), batch.column("codes"), strict=True):
                codes = np.frombuffer(codes.as_buffer(), dtype=np.uint64)
                may = _open(codes, lang, filters.value)
                at = np.flatnonzero(may[1])
                rows = np.zeros((len(at), longest), dtype=np.uint64)
                rows[:, 0], rows[:, 1] = codes[at], codes[at + 1]
                for size in range(3, longest + 1):
                    own = np.zeros(len(at), dtype=bool)
                    inside = at < len(may[size - 1])
                    own[inside] = may[size - 1][at[inside]]
                    rows[own, size - 1] = codes[at[own] + size - 1]
                if len(at):
                    held.setdefault(lang, []).append(rows)
                count += len(at)
                if count * longest >= plan.buffer:
                    merge()
                    count = 0
                    if longest * sum(len(r) for r, _ in known.values()) >= plan.buffer:
                        yield from out()
        merge()
        yield from out()

    return _blocks(read).coalesce(slots).mapInArrow(run, "lang string, gram binary, n bigint")


def _prefix_counts(windows: DataFrame, plan: Plan) -> DataFrame:
    """``(lang, gram, n)``: one scan of the stream in prefix order gives the counts
    of its prefixes of all lengths, since equal ones are neighbours. Those at the
    ends of a range may go on in the next one and come whatever their count."""
    longest, least = plan.longest, plan.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per length the sequence that is still open: lang, bytes, count, whether it is the range's first.
        held: dict[int, tuple[str, bytes, int, bool]] = {}
        met: set[int] = set()

        def out(rows: list[tuple[str, bytes, int]]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            grams = batch.column("gram").to_pylist()
            words = np.frombuffer(b"".join(grams), dtype=">u8").reshape(-1, longest)
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            rows: list[tuple[str, bytes, int]] = []
            differs = np.ones(len(n), dtype=bool)
            differs[1:] = langs[1:] != langs[:-1]
            for size in range(1, longest + 1):
                differs[1:] |= words[1:, size - 1] != words[:-1, size - 1]
                if size == 1:
                    continue
                starts = np.flatnonzero(differs)
                sums = np.add.reduceat(n, starts)
                full = words[starts, size - 1] != BREAK
                wanted = full & (sums >= least)
                wanted[[0, -1]] = full[[0, -1]]
                for i in np.flatnonzero(wanted):
                    lang, gram, total = langs[starts[i]], grams[starts[i]][: size * WORD], int(sums[i])
                    first = False
                    if i == 0 and size in held:
                        before = held.pop(size)
                        if before[:2] == (lang, gram):
                            total, first = total + before[2], before[3]
                        elif before[3] or before[2] >= least:
                            rows.append(before[:3])
                    elif i == 0:
                        first = size not in met
                    if i == len(starts) - 1:
                        if size in held:
                            before = held.pop(size)
                            if before[3] or before[2] >= least:
                                rows.append(before[:3])
                        held[size] = (lang, gram, total, first)
                    elif first or total >= least:
                        rows.append((lang, gram, total))
                met.add(size)
            yield out(rows)
        yield out([h[:3] for h in held.values()])

    ordered = windows.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram")
    return ordered.mapInArrow(run, "lang string, gram binary, n bigint")


def frequent_sequences(df: DataFrame, lang: str, text: str, plan: Plan) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``words(lang, gram, word, f)`` and ``grams(lang, gram, f)`` with a count of
    ``plan.least`` at least, and ``totals(lang, n)``; a gram is its words' codes."""
    cap_arrow_batches(df.sparkSession, ARROW_ROWS, ARROW_BYTES)
    read = _read(df, lang, text, plan)
    counts = read.where(F.col("gram").isNotNull()).groupBy("lang", "gram", "word").agg(F.sum("n").alias("f"))
    counts = written(counts, "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = counts.where(F.col("f") >= plan.least).select("lang", "gram", F.col("word").cast("string").alias("word"), "f")
    context = df.sparkSession.sparkContext
    filters = context.broadcast([])
    for size in range(1, plan.longest):
        few = _sequence_counts(read, size, filters, plan).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= plan.least)
        filters = context.broadcast([*filters.value, _bit(few, plan)])
    windows = written(_windows(read, filters, plan), "windows")
    grams = _prefix_counts(windows, plan).groupBy("lang", "gram").agg(F.sum("n").alias("f")).where(F.col("f") >= plan.least)
    both = words.select("lang", "gram", "f").unionByName(grams)
    return words, written(both.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram"), "grams"), totals


def _merged(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Both sides sorted by language and sequence and merged side by side."""
    own = right.hint("merge").select(F.col("lang").alias("__lang"), F.col("gram").alias("__gram"), *[c for c in right.columns if c not in ("lang", "gram")])
    return left.hint("merge").join(own, (left["lang"] == own["__lang"]) & (left[on] == own["__gram"]), how).drop("__lang", "__gram")


def _words_in(gram: str) -> Column:
    return (F.length(gram) / WORD).cast("int")


def _part(gram: str, start: Column, words: Column) -> Column:
    return F.substring(F.col(gram), start * WORD + 1, words * WORD)


def collocations(df: DataFrame, lang: str = "lang", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``plan.first``
    phrases of two to ``plan.longest`` words that occur ``plan.least`` times at least.

    A-Z are lower-cased, texts cut at ``.,;:!?`` and line ends, and counts taken of
    all contiguous occurrences inside pieces, overlaps included. NULL languages are
    ``und``; NULL and empty texts have no words; repeated rows count each time. A
    cut after the first words with ``l`` and ``r`` occurrences of its sides scores
    ``floor(1000 a n / (l r))``, ``n`` being all words of the language; the least
    score counts, of equal ones the earliest cut. Phrases inside a longer one that
    is as frequent go. Order: score and ``a`` falling, then the phrase's bytes.

    Texts are read once, as 64-bit codes of words. Passes over the codes find which
    sequences of one, two and more words may be frequent (bitmaps of one size, so
    never wrongly left out); what remains is sorted in prefix order, and one scan
    counts all lengths. The counts of both sides of each cut come from merging that
    stream with the cuts in order of the left and of the right side, extensions by
    a word from merging it without the last and without the first word: any longer
    phrase that is as frequent has one by a word that is, too.
    """
    words, grams, totals = frequent_sequences(df, lang, text, plan)
    many = grams.where(F.length("gram") > WORD).withColumn("w", _words_in("gram"))
    cuts = many.select("lang", "gram", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "gram", "a", "k",
        _part("gram", F.lit(0), F.col("k")).alias("left"),
        _part("gram", F.col("k"), F.col("w") - F.col("k")).alias("right"),
    )
    sided = _merged(cuts, grams.select("lang", "gram", F.col("f").alias("l")), "left")
    sided = _merged(sided, grams.select("lang", "gram", F.col("f").alias("r")), "right")
    # A row per language.
    exact = sided.join(totals, "lang").withColumn(
        "score",
        F.expr("(CAST(a AS DECIMAL(18,0)) * CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"),
    )
    scored = exact.groupBy("lang", "gram", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    longer = many.where(F.col("w") > 2)
    extended = longer.select("lang", _part("gram", F.lit(0), F.col("w") - 1).alias("gram"), "f").unionByName(
        longer.select("lang", _part("gram", F.lit(1), F.col("w") - 1).alias("gram"), "f")
    )
    extended = extended.groupBy("lang", "gram").agg(F.max("f").alias("most"))
    kept = _merged(scored, extended, "gram", "left").where(F.col("most").isNull() | (F.col("most") < F.col("a")))
    kept = written(kept.select("lang", "gram", "a", "n", "c.score", "c.l", "c.r"), "scored")
    # Best of each of 64 parts of a language first, so that no task sees them all.
    part = F.pmod(F.xxhash64("gram"), F.lit(64)).alias("part")
    order = [F.desc("score"), F.desc("a")]
    near = kept.select("*", part).withColumn("at", F.rank().over(Window.partitionBy("lang", "part").orderBy(*order)))
    near = near.where(F.col("at") <= plan.first)
    each = near.select("lang", F.col("gram").alias("whole"), F.posexplode(F.sequence(F.lit(0), _words_in("gram") - 1)).alias("i", "j"))
    each = each.select("lang", "whole", "i", _part("whole", F.col("j"), F.lit(1)).alias("gram"))
    named = _merged(each, words.select("lang", "gram", "word"), "gram").groupBy("lang", "whole").agg(
        F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w")
    )
    named = named.select("lang", F.col("whole").alias("gram"), F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    shown = _merged(near, named, "gram")
    order = [*order, F.asc("phrase")]
    best = shown.withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("at") <= plan.first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= plan.first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
