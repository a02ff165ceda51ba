"""Language of texts by character models with interpolated Kneser-Ney smoothing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import small_side, written
from batchlens.llm.words import mixed

ORDER = 4
DISCOUNT = 0.75
# Characters of training text per language, and the share of its documents on
# which rejection is calibrated instead.
SAMPLE_CHARS = 400_000
CALIBRATION_PARTS = 5
# Characters of one text in a sample that has texts enough, and the fewest texts
# that are fitted without those of calibration.
STRETCH = 20_000
FITTED_TEXTS = 5
CHARS_AT_ONCE = 2_000_000
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 32 if it is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def codes_of(text: str) -> np.ndarray:
    """Lower-case letters, with one space for each run of anything else, and a
    space at each end; nothing if there is no letter."""
    raw = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    raw = np.concatenate([[32], raw, [32]]).astype(np.uint64)
    kept = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])]
    return kept if len(kept) > 1 else kept[:0]


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1 to ``order`` characters that end at each place (0 where
    fewer precede)."""
    with np.errstate(over="ignore"):
        signs = mixed(codes + np.uint64(1))
        found = [mixed(signs)]
        plain = signs
        for n in range(2, order + 1):
            longer = np.zeros_like(plain)
            longer[n - 1 :] = signs[n - 1 :] + plain[n - 2 : -1] * _STEP
            plain = longer
            found.append(mixed(plain))
            found[-1][: n - 1] = 0
    return found


class SortedHashes:
    """Look-up in a sorted array of hashes, entered by the high bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.bits = max(1, min(20, int(len(keys) - 1).bit_length() if len(keys) > 1 else 1))
        bounds = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.searchsorted(keys, bounds).astype(np.int64)
        sizes = np.diff(np.append(self.first, len(keys)))
        self.deepest = int(sizes.max()) if len(sizes) else 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it is missing."""
        at = self.first[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)]
        last = len(self.keys) - 1
        for _ in range(self.deepest):
            low = self.keys[at] < hashes
            if not low.any():
                break
            at = np.minimum(at + low, last)
        return np.where(self.keys[at] == hashes, at, -1)


@dataclass
class Models:
    """For each order the known grams of any language, sorted, and per language
    their log10 probability and the log10 weight of what follows them."""

    languages: list[str]
    grams: list[np.ndarray]
    log_prob: list[np.ndarray]
    back_off: list[np.ndarray]
    floor: float
    # Per language: cross-entropy above which a text is rejected.
    limits: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.found = [SortedHashes(g) for g in self.grams]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the bits per character; characters per text."""
        codes = [codes_of(t) for t in texts]
        lengths = np.array([max(0, len(c) - 1) for c in codes], dtype=np.int64)
        out = np.zeros((len(texts), len(self.languages)))
        used = np.flatnonzero(lengths)
        if not len(used):
            return out, lengths
        # The first space of a text is context only, and no gram reaches past it.
        joined = np.concatenate([codes[i] for i in used])
        sizes = lengths[used] + 1
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(joined)) - np.repeat(starts, sizes)
        hashes = gram_hashes(joined, ORDER)
        total = np.zeros((len(joined), len(self.languages)), dtype=np.float32)
        open_ = np.flatnonzero(place > 0)
        for n in range(ORDER, 0, -1):
            fits = place[open_] >= n - 1
            trying = open_[fits]
            at = self.found[n - 1].find(hashes[n - 1][trying])
            hit = at >= 0
            total[trying[hit]] += self.log_prob[n - 1][at[hit]]
            missed = trying[~hit]
            if n > 1:
                context = self.found[n - 2].find(hashes[n - 2][missed - 1])
                seen = context >= 0
                total[missed[seen]] += self.back_off[n - 2][context[seen]]
            else:
                total[missed] += self.floor
            open_ = np.concatenate([missed, open_[~fits]]) if not fits.all() else missed
        total[starts] = 0
        sums = np.add.reduceat(total, starts, axis=0, dtype=np.float64)
        out[used] = -sums / lengths[used, None] / np.log10(2)
        return out, lengths


def _level_counts(texts: list[str]) -> list[dict[str, np.ndarray]]:
    """Per order the grams of one language: hash, count, hash of the context, and
    hash of the gram without its first character."""
    parts: list[list[np.ndarray]] = [[] for _ in range(ORDER)]
    for text in texts:
        codes = codes_of(text)
        if not len(codes):
            continue
        hashes = gram_hashes(codes, ORDER)
        for n in range(1, ORDER + 1):
            ends = np.arange(max(1, n - 1), len(codes))
            own = hashes[n - 1][ends]
            context = hashes[n - 2][ends - 1] if n > 1 else np.zeros_like(own)
            shorter = hashes[n - 2][ends] if n > 1 else np.zeros_like(own)
            parts[n - 1].append(np.stack([own, context, shorter]))
    levels = []
    for n in range(ORDER):
        every = np.concatenate(parts[n], axis=1) if parts[n] else np.zeros((3, 0), dtype=np.uint64)
        own, first, count = np.unique(every[0], return_index=True, return_counts=True)
        levels.append({"own": own, "context": every[1][first], "shorter": every[2][first], "count": count})
    return levels


def _kneser_ney(texts: list[str]) -> list[dict[str, np.ndarray]]:
    """Per order: grams, log10 probability, and log10 back-off weight of contexts.

    The highest order counts occurrences; a lower one counts the different
    characters before a gram (continuations). Every order is interpolated with
    the next lower one, the lowest with an even spread over its characters.
    """
    levels = _level_counts(texts)
    counts = [lv["count"].astype(np.float64) for lv in levels]
    for n in range(ORDER - 1):
        longer = levels[n + 1]["shorter"]
        own = levels[n]["own"]
        at = np.searchsorted(own, longer)
        continued = np.bincount(at, minlength=len(own))[: len(own)].astype(np.float64)
        counts[n] = np.maximum(continued, 1)  # the grams that start a text continue nothing
    out = []
    below: np.ndarray | None = None
    for n in range(ORDER):
        lv, c = levels[n], counts[n]
        contexts, which = np.unique(lv["context"], return_inverse=True)
        mass = np.bincount(which, weights=c, minlength=len(contexts))
        kinds = np.bincount(which, minlength=len(contexts))
        weight = DISCOUNT * kinds / np.maximum(mass, 1e-9)
        if n == 0:
            lower = np.full(len(c), 1.0 / max(1, len(c) + 1))
        else:
            lower = below[np.searchsorted(levels[n - 1]["own"], lv["shorter"])]
        prob = np.maximum(c - DISCOUNT, 0) / mass[which] + weight[which] * lower if len(c) else c
        below = prob
        out.append({"own": lv["own"], "log_prob": np.log10(prob), "contexts": contexts, "weight": np.log10(weight)})
    return out


def fit(samples: dict[str, list[str]]) -> Models:
    """Models of the languages of ``samples``."""
    languages = sorted(samples)
    fitted = [_kneser_ney(samples[lang]) for lang in languages]
    grams, probs, backs = [], [], []
    characters = max([len(f[0]["own"]) for f in fitted], default=0) + 1
    floor = float(np.log10(0.1 / characters))
    for n in range(ORDER):
        union = np.unique(np.concatenate([f[n]["own"] for f in fitted])) if fitted else np.zeros(0, np.uint64)
        grams.append(union)
        prob = np.full((len(union), len(languages)), np.nan)
        back = np.zeros((len(union), len(languages)))
        for k, f in enumerate(fitted):
            prob[np.searchsorted(union, f[n]["own"]), k] = f[n]["log_prob"]
            if n + 1 < ORDER:
                # A gram that ends every text is a context of nothing: it stays at 0.
                at = np.searchsorted(union, f[n + 1]["contexts"])
                back[at, k] = f[n + 1]["weight"]
        probs.append(prob)
        backs.append(back)
    # Where one language knows a gram and another does not, the other backs off.
    links = _shorter_of(samples, grams)
    for n in range(ORDER):
        for k in range(len(languages)):
            missing = np.flatnonzero(np.isnan(probs[n][:, k]))
            if n == 0:
                probs[0][missing, k] = floor
            else:
                shorter, context = links[n][0][missing], links[n][1][missing]
                probs[n][missing, k] = probs[n - 1][shorter, k] + backs[n - 1][context, k]
    as32 = lambda xs: [x.astype(np.float32) for x in xs]
    return Models(languages, grams, as32(probs), as32(backs), floor)


def _shorter_of(samples: dict[str, list[str]], grams: list[np.ndarray]) -> list:
    """Per order and known gram the places of the gram without its first and
    without its last character."""
    links: list = [None]
    levels = _level_counts([t for texts in samples.values() for t in texts])
    for n in range(1, ORDER):
        at = np.searchsorted(levels[n]["own"], grams[n])
        shorter = np.searchsorted(grams[n - 1], levels[n]["shorter"][at])
        context = np.minimum(np.searchsorted(grams[n - 1], levels[n]["context"][at]), len(grams[n - 1]) - 1)
        links.append((shorter, context))
    return links


def training_sample(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, text, part)``: of each language distinct texts in the order of a hash
    until they hold ``SAMPLE_CHARS`` characters; all of them if they hold fewer,
    and always one.

    Of a long text a drawn stretch is taken: at most ``STRETCH`` characters, or
    more where the language has too few texts to reach the bound that way. The
    lowest hashes are found from the characters per class of hash (classes grow
    by an eighth of a power of two), so only about the sample itself is sorted.
    """
    value = F.shiftrightunsigned(F.xxhash64(text), 1)
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), value.alias("__hash"), F.col(text).alias("text")
    )
    distinct = known.groupBy("lang", "__hash").agg(F.max(F.length("text")).alias("__chars"))
    distinct = written(distinct, "distinct-texts")
    texts = written(distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("__texts")), "languages")
    bound = F.greatest(F.lit(STRETCH), F.ceil(F.lit(SAMPLE_CHARS) / F.col("__texts"))).cast("int")
    texts = small_side(texts.select("lang", bound.alias("__bound")), texts.count())
    level = F.floor(F.log2(F.col("__hash") + F.lit(1.0)) * 8).cast("int")
    taken = F.least("__chars", "__bound").cast("long")
    slim = distinct.join(texts, "lang").select("lang", "__hash", "__bound", taken.alias("__taken"), level.alias("__level"))
    before = lambda *order: Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda chars, *order: F.coalesce(F.sum(chars).over(before(*order)), F.lit(0))
    classes = slim.groupBy("lang", "__level").agg(F.sum("__taken").alias("__sum"))
    classes = (
        classes.withColumn("__before", so_far("__sum", "__level"))
        .where(F.col("__before") < SAMPLE_CHARS)
        .groupBy(F.col("lang").alias("__lang"))
        .agg(F.max("__level").alias("__last"))
    )
    classes = written(classes, "hash-classes")
    wanted = (
        slim.join(
            small_side(classes, classes.count()),
            (F.col("lang") == F.col("__lang")) & (F.col("__level") <= F.col("__last")),
        )
        .withColumn("__before", so_far("__taken", "__hash"))
        .where(F.col("__before") < SAMPLE_CHARS)
        .select(F.col("lang").alias("__lang"), F.col("__hash").alias("__of"), "__bound")
    )
    wanted = written(wanted, "sampled-texts")
    room = F.greatest(F.length("text") - F.col("__bound"), F.lit(0))
    start = F.pmod(F.xxhash64("__hash"), room + 1).cast("int") + 1
    stretch = F.substr(F.col("text"), start, F.col("__bound"))
    part = F.pmod(F.xxhash64("__hash", F.lit(1)), F.lit(CALIBRATION_PARTS)).alias("part")
    return (
        known.join(
            small_side(wanted, wanted.count()),
            (F.col("lang") == F.col("__lang")) & (F.col("__hash") == F.col("__of")),
        )
        .select("lang", "__hash", stretch.alias("text"))
        .groupBy("lang", "__hash")
        .agg(F.first("text").alias("text"))
        .select("lang", "text", part)
    )


def train(df: DataFrame, lang: str = "lang", text: str = "text", false_rejects: float = 0.001) -> Models:
    """Models from the rows of ``df`` with a language and a text.

    The sample is bounded per language by ``SAMPLE_CHARS``, so it may come to the
    driver, where fitting takes seconds. One part of it is kept from fitting; the
    limit of a language is the cross-entropy that only ``false_rejects`` of those
    texts exceed, and a tenth more, since they are few. Where fewer than
    ``FITTED_TEXTS`` texts or half of the characters are left beside that part,
    the whole sample is fitted, and the language has no limit.
    """
    rows = training_sample(df, lang, text).toPandas()
    samples: dict[str, list[str]] = {}
    held_out: dict[str, list[str]] = {}
    for language, own in rows.groupby("lang"):
        fitted, apart = own["text"][own["part"] != 0], own["text"][own["part"] == 0]
        if len(fitted) < FITTED_TEXTS or 2 * fitted.str.len().sum() < own["text"].str.len().sum():
            fitted, apart = own["text"], own["text"][:0]
        samples[str(language)], held_out[str(language)] = sorted(fitted), list(apart)
    models = fit(samples)
    limits = np.full(len(models.languages), np.inf)
    for k, language in enumerate(models.languages):
        texts = held_out[language]
        scores, lengths = models.scores(texts) if texts else (np.zeros((0, 1)), np.zeros(0))
        long = lengths >= 20
        if long.any():
            limits[k] = 1.1 * np.quantile(scores[long][:, k], 1 - false_rejects)
    models.limits = limits
    return models


def _blocks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHARS_AT_ONCE:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def identify(df: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``lang_pred``, ``score`` and ``rejected``.

    The language of lowest bits per character; ties go to the first by name.
    ``score`` is its share among all languages, by the bits over at most 50
    characters. ``rejected`` marks texts that even it explains worse than it
    explains its own (see ``train``). NULL texts, texts without a letter, and all
    texts where nothing was learnt, are ``und`` with score 0 and rejected.
    Columns with the names added are replaced. Whole texts are scored where they
    lie; only the models, bounded by the training sample, are sent out.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    kept = [c for c in df.columns if c not in (text, "lang_pred", "score", "rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            langs, scores, rejected = [], [], []
            for block in _blocks(texts):
                bits, lengths = own.scores(texts[block])
                for row, n in zip(bits, lengths, strict=True):
                    if not n or not own.languages:
                        langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                        continue
                    best = int(row.argmin())
                    share = np.exp2((row[best] - row) * min(int(n), 50))
                    langs.append(own.languages[best])
                    scores.append(float(1 / share.sum()))
                    rejected.append(bool(row[best] > own.limits[best]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*kept, "lang_pred", "score", "rejected"],
            )

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept]
    return df.select(*kept, text).mapInArrow(
        run, ", ".join([*fields, "lang_pred string", "score double", "rejected boolean"])
    )
