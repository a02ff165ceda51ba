"""Waveform preparation: checks and resampling to the models' rate."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL_RATE = 16_000
# The low-pass filter of the standard windowed-sinc resampler.
ZERO_CROSSINGS = 6
ROLLOFF = 0.99


# Output samples computed at a time, which bounds the memory of a long signal.
SLICE = 1 << 18


def filters(step: int, phases: int) -> tuple[np.ndarray, np.ndarray]:
    """Low-pass filter of each output position between two input samples: the
    offsets of the first taps, and the taps, one row per position."""
    cutoff = min(step, phases) * ROLLOFF
    first = np.ceil((np.arange(phases) / phases - ZERO_CROSSINGS / cutoff) * step)
    width = math.ceil(2 * ZERO_CROSSINGS * step / cutoff) + 1
    taps = first[:, None] + np.arange(width)
    at = (taps / step - np.arange(phases)[:, None] / phases) * cutoff
    window = np.cos(at * math.pi / ZERO_CROSSINGS / 2) ** 2
    kernels = np.where(
        np.abs(at) < ZERO_CROSSINGS, np.sinc(at) * window * cutoff / step, 0.0
    )
    return first.astype(np.int64), kernels


def resample(
    samples: np.ndarray,
    rate: int,
    target: int = MODEL_RATE,
    known: dict | None = None,
    lead: int = 0,
    length: int | None = None,
) -> np.ndarray:
    """Band-limited interpolation with a Hann-windowed sinc.

    Output sample ``j`` lies at time ``j / target``. It is the sum of all input
    samples within ``ZERO_CROSSINGS`` zero crossings of the low-pass filter,
    whose cutoff is the lower of the two rates times ``ROLLOFF``. Output samples
    at the same position between two input samples share a filter; ``known``
    keeps the filters of the rates seen so far. For a stretch of a longer signal
    the first ``lead`` samples come before its time 0, and ``length`` output
    samples are wanted.
    """
    if rate == target or not len(samples):
        return samples[lead : None if length is None else lead + length]
    step, phases = rate // math.gcd(rate, target), target // math.gcd(rate, target)
    known = {} if known is None else known
    if rate not in known:
        known[rate] = filters(step, phases)
    first, kernels = known[rate]
    width = kernels.shape[1]
    if length is None:
        length = math.ceil((len(samples) - lead) * phases / step)
    before = -int(first[0])
    padded = np.concatenate(
        [np.zeros(before), samples.astype(np.float64), np.zeros(width + 2 * step)]
    )
    result = np.empty(length)
    for low in range(0, length, SLICE):
        turn, phase = np.divmod(np.arange(low, min(length, low + SLICE)), phases)
        starts = turn * step + first[phase] + before + lead
        near = padded[starts[:, None] + np.arange(width)]
        result[low : low + SLICE] = np.einsum("jt,jt->j", near, kernels[phase])
    return result


def prepare_audio(
    df: DataFrame,
    samples: str = "samples",
    rate: str = "sampling_rate",
    target: int = MODEL_RATE,
) -> DataFrame:
    """Bring single-channel waveforms to ``target`` samples a second.

    Adds ``problem``: NULL where the row is fine, else why it has no result
    (``no samples``, ``missing samples``, ``no sampling rate``). Such rows keep NULL samples instead
    of failing the job. Samples with more than one channel are refused here,
    before any task runs. Only samples at another rate are sent to Python.
    """
    kind = df.schema[samples].dataType
    if not isinstance(kind, T.ArrayType) or isinstance(kind.elementType, T.ArrayType):
        raise ValueError(f"single-channel samples expected, got {kind.simpleString()}")

    def at_target(waves: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict = {}
        for signals, rates in waves:
            yield pd.Series(
                [
                    None if s is None else resample(np.asarray(s), int(r), target, known)
                    for s, r in zip(signals, rates)
                ],
                dtype=object,
            )

    # Marked so that an explode or filter on the result does not resample twice.
    resampled = F.pandas_udf(at_target, "array<double>").asNondeterministic()
    checked = _with_problem(df, samples, rate)
    signal = F.when(F.col("problem").isNull(), F.col(samples).cast("array<double>"))
    converted = resampled(F.when(F.col(rate) != target, signal), F.coalesce(rate, F.lit(0)))
    return checked.withColumn(samples, F.coalesce(converted, signal)).withColumn(
        rate, F.lit(target)
    )


def prepare_blocks(
    df: DataFrame,
    samples: str = "samples",
    rate: str = "sampling_rate",
    target: int = MODEL_RATE,
    seconds: int = 30,
) -> DataFrame:
    """Like ``prepare_audio`` in stretches of ``seconds``: rows with ``block`` and
    ``first_sample`` (the place of its first sample in the whole), put end to end
    the whole signal.

    Each stretch is cut out with as much of its neighbours as the filter reaches,
    before anything goes to Python, so that a batch holds a bounded number of
    samples however long a recording is. A row without a result, or without
    samples in it, is one block.
    """
    kind = df.schema[samples].dataType
    if not isinstance(kind, T.ArrayType) or isinstance(kind.elementType, T.ArrayType):
        raise ValueError(f"single-channel samples expected, got {kind.simpleString()}")
    pace = F.greatest(F.coalesce(F.col(rate), F.lit(1)), F.lit(1)).cast("long")
    halo = F.ceil((ZERO_CROSSINGS + 2) * F.greatest(F.lit(1.0), pace / F.lit(target))).cast("long") + 2
    size = F.greatest(F.coalesce(F.size(samples), F.lit(0)), F.lit(0)).cast("long")
    checked = _with_problem(df, samples, rate)
    fine = F.col("problem").isNull()
    blocks = F.when(fine, F.greatest(F.ceil(size / (pace * seconds)), F.lit(1))).otherwise(1)
    one = checked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
    start = F.col("block") * pace * seconds
    lead = F.least(halo, start)
    whole = F.ceil(size * F.lit(target) / pace)
    cut = one.withColumns(
        {
            "_lead": lead.cast("int"),
            "_length": F.least(F.lit(target * seconds).cast("long"), whole - F.col("block") * target * seconds).cast("int"),
            "_cut": F.when(
                fine,
                F.slice(samples, (start - lead + 1).cast("int"), (pace * seconds + lead + halo).cast("int")),
            ),
        }
    )

    def at_target(waves: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known: dict = {}
        for signals, rates, leads, lengths in waves:
            yield pd.Series(
                [
                    None if s is None else resample(np.asarray(s), int(r), target, known, int(a), int(n))
                    for s, r, a, n in zip(signals, rates, leads, lengths)
                ],
                dtype=object,
            )

    resampled = F.pandas_udf(at_target, "array<double>").asNondeterministic()
    return (
        cut.withColumn(samples, resampled(F.col("_cut"), F.coalesce(rate, F.lit(0)), "_lead", "_length"))
        .withColumn(rate, F.lit(target))
        .withColumn("first_sample", F.col("block") * target * seconds)
        .drop("_cut", "_lead", "_length")
    )


def prepare_rows(
    df: DataFrame,
    key: str = "file_ids",
    samples: str = "samples",
    rate: str = "sampling_rate",
    first: str = "first_sample",
    target: int = MODEL_RATE,
    seconds: int = 30,
) -> DataFrame:
    """``prepare_blocks`` of recordings that come in many rows.

    ``df(key, rate, first, samples)`` holds stretches of any length, ``first``
    being the place of a stretch's first sample in its recording. Every stretch
    gives each output block the samples that block needs, its own and those of
    the neighbours that the filter reaches, so that a task never holds more than
    one block and its margins. The result is ``(key, rate, block, first_sample,
    samples, problem)``, sample for sample that of the whole recording in one row.

    A recording has one block with a ``problem`` and NULL samples where a stretch
    has one (``no samples``, ``missing samples``, ``no sampling rate``), where
    stretches leave a gap or overlap (``missing samples``) or where their rates
    differ (``no sampling rate``).
    """
    kind = df.schema[samples].dataType
    if not isinstance(kind, T.ArrayType) or isinstance(kind.elementType, T.ArrayType):
        raise ValueError(f"single-channel samples expected, got {kind.simpleString()}")
    rows = _with_problem(df, samples, rate).select(
        F.col(key).alias("_key"), F.col(rate).cast("long").alias("_rate"), F.col(first).cast("long").alias("_at"),
        F.col(samples).cast("array<double>").alias("_samples"), "problem",
        F.greatest(F.coalesce(F.size(samples), F.lit(0)), F.lit(0)).cast("long").alias("_n"),
    )
    # A row per recording; neighbours are compared by sums, not side by side.
    ends = F.sum((F.col("_at") + F.col("_n")) * F.col("_n")) - F.sum(F.col("_at") * F.col("_n"))
    squares = F.sum(F.col("_n") * F.col("_n"))
    whole = F.max(F.col("_at") + F.col("_n"))
    files = rows.groupBy(F.col("_key").alias("_file")).agg(
        F.min("problem").alias("_problem"),
        whole.alias("_size"),
        ((F.sum("_n") != whole) | (F.min("_at") != 0) | (F.count("_at") != F.count(F.lit(1))) | (ends != squares)
         | (F.sum(F.col("_n") * (2 * F.col("_at") + F.col("_n"))) != whole * whole)).alias("_broken"),
        F.max("_rate").alias("_pace"),
        (F.min("_rate") != F.max("_rate")).alias("_mixed"),
    )
    problem = (
        F.coalesce("_problem", F.when(F.col("_mixed"), "no sampling rate"), F.when(F.col("_broken"), "missing samples"))
    )
    files = files.withColumn("_problem", problem)
    fine = rows.join(files.where("_problem IS NULL"), rows["_key"].eqNullSafe(F.col("_file")))
    pace = F.col("_pace")
    halo = F.ceil((ZERO_CROSSINGS + 2) * F.greatest(F.lit(1.0), pace / F.lit(target))).cast("long") + 2
    size = pace * seconds
    end = F.col("_at") + F.col("_n")
    last = F.greatest(F.ceil(F.col("_size") / size) - 1, F.lit(0))
    reach = F.sequence(
        F.greatest(F.floor((F.col("_at") - halo) / size), F.lit(0)).cast("long"),
        F.least(F.floor((F.greatest(end - 1, F.col("_at")) + halo) / size), last).cast("long"),
    )
    dealt = fine.withColumn("block", F.explode(reach))
    start = F.col("block") * size
    lead = F.least(halo, start)
    low = F.greatest(F.col("_at"), start - lead)
    high = F.least(end, start + size + halo)
    pieces = dealt.where((high > low) | ((F.col("_size") == 0) & (F.col("block") == 0))).select(
        "_key", "block", "_pace", "_size", lead.cast("int").alias("_lead"), low.alias("_from"),
        F.slice("_samples", (low - F.col("_at") + 1).cast("int"), (high - low).cast("int")).alias("_piece"),
    )
    length = F.least(F.lit(target * seconds).cast("long"), F.ceil(F.col("_size") * F.lit(target) / pace) - F.col("block") * target * seconds)
    joined = pieces.groupBy("_key", "block", "_pace", "_size", "_lead").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_piece"))).alias("_pieces")
    )

    def at_target(waves: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known: dict = {}
        for signals, rates, leads, lengths in waves:
            yield pd.Series(
                [resample(np.asarray(s), int(r), target, known, int(a), int(n)) for s, r, a, n in zip(signals, rates, leads, lengths)],
                dtype=object,
            )

    resampled = F.pandas_udf(at_target, "array<double>").asNondeterministic()
    signal = F.flatten(F.transform("_pieces", lambda p: p["_piece"]))
    blocks = joined.select(
        F.col("_key").alias(key),
        F.lit(target).alias(rate),
        "block",
        (F.col("block") * target * seconds).alias("first_sample"),
        resampled(signal, F.col("_pace"), "_lead", length.cast("int")).alias(samples),
        F.lit(None).cast("string").alias("problem"),
    )
    zero = F.lit(0).cast("long")
    failed = files.where("_problem IS NOT NULL").select(
        F.col("_file").alias(key), F.lit(target).alias(rate), zero.alias("block"), zero.alias("first_sample"),
        F.lit(None).cast("array<double>").alias(samples), F.col("_problem").alias("problem"),
    )
    return blocks.unionByName(failed)


def _with_problem(df: DataFrame, samples: str, rate: str) -> DataFrame:
    return df.withColumn(
        "problem",
        F.when(F.col(samples).isNull(), "no samples")
        .when(F.exists(samples, lambda s: s.isNull()), "missing samples")
        .when(F.coalesce(F.col(rate), F.lit(0)) <= 0, "no sampling rate"),
    )
