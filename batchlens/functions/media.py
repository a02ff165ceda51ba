"""Nested speech columns: turns, alignment and JSON, all within one row.

These work where a file's transcript and segments already sit in one cell. The
row-per-segment forms are in ``batchlens.operators``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SEGMENTS = (
    "array<struct<segment:struct<start:double,end:double>,track:string,label:string>>"
)
TURNS = "array<struct<segment:struct<start:double,end:double>,speaker:string>>"
CHUNKS = "array<struct<text:string,timestamp:array<double>>>"
ATTRIBUTED = "array<struct<speaker:string,text:string,timestamp:array<double>>>"

CUTS_PER_LIST = 256
# Stands for the end of a chunk that has none: the largest double.
OPEN_END = 1.7976931348623157e308


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def _empty(ddl: str) -> Column:
    return F.array().cast(ddl)


def turns_of(segments: Column) -> Column:
    """Collapse raw segments (``SEGMENTS``) into speaker turns (``TURNS``).

    Same rule as ``operators.turns.speaker_turns``, in array order. Linear in
    the number of segments; NULL gives NULL and no segments give no turns.
    """
    last = F.size(segments) - 1

    def label(i: Column) -> Column:
        return F.get(segments, i)["label"]

    heads = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | ~label(i).eqNullSafe(label(i - 1)),
    )

    def turn(heads: Column, head: Column, number: Column) -> Column:
        start = F.get(segments, head)["segment"]["start"]
        end = F.when(
            number + 1 < F.size(heads),
            F.get(segments, F.get(heads, number + 1))["segment"]["start"],
        ).otherwise(F.get(segments, last)["segment"]["end"])
        return F.struct(
            F.struct(start.alias("start"), end.alias("end")).alias("segment"),
            label(head).alias("speaker"),
        )

    turns = _let(heads, lambda hs: F.transform(hs, lambda h, n: turn(hs, h, n)))
    return (
        F.when(segments.isNull(), F.lit(None))
        .when(last < 0, _empty(TURNS))
        .otherwise(turns)
        .cast(TURNS)
    )


def distance(end: Column, at: Column) -> Column:
    """``|end - at|``, exact: its double, then what rounding lost of it.

    Ordered as structs, distances compare as real numbers do, so that every way
    of finding the nearest end agrees, also where doubles would tie. Of equal
    distances the first chunk is taken.
    """
    difference = end - at
    part = difference - end
    lost = (end - (difference - part)) - (at + part)
    signed = F.when(difference < 0, -lost).otherwise(lost)
    return F.struct(F.abs(difference).alias("far"), signed.alias("lost"))


def _first_at_or_after(ends: Column, at: Column, low: Column, high: Column) -> Column:
    """First index in ``[low, high)`` whose end is not before ``at``, else ``high``.

    A binary search: as many halvings as the array length has binary digits.
    """
    halvings = F.sequence(F.lit(1), F.length(F.bin(F.size(ends))))
    start = F.struct(low.cast("int").alias("lo"), high.cast("int").alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["lo"] + s["hi"], 1)
        return F.when(s["lo"] >= s["hi"], s).otherwise(
            F.when(
                F.get(ends, middle) < at,
                F.struct((middle + 1).alias("lo"), s["hi"].alias("hi")),
            ).otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi")))
        )

    return F.aggregate(halvings, start, halve, lambda s: s["lo"])


def _nearest_sorted(ends: Column, at: Column, low: Column) -> Column:
    """First index from ``low`` on whose end is nearest to ``at``; ends ascend."""
    size = F.size(ends)

    def pick(right: Column) -> Column:
        left_end = F.get(ends, right - 1)
        alone = (right - 1 == low) | (F.get(ends, right - 2) != left_end)
        left = F.when(alone, right - 1).otherwise(
            _first_at_or_after(ends, left_end, low, right)
        )
        right_wins = distance(F.get(ends, right), at) < distance(left_end, at)
        return (
            F.when(right == low, right)
            .when((right < size) & right_wins, right)
            .otherwise(left)
        )

    return _let(_first_at_or_after(ends, at, low, size), pick)


def _nearest_any(ends: Column, at: Column, low: Column) -> Column:
    """The same for ends in any order, looking at each of them."""
    distances = F.transform(
        F.sequence(low, F.size(ends) - 1),
        lambda i: F.struct(distance(F.get(ends, i), at).alias("far"), i.alias("i")),
    )
    return F.array_min(distances)["i"]


def cuts_of(ends: Column, turns: Column, turn_end: Callable[[Column], Column]) -> Column:
    """Index of the last chunk of each turn, until the chunks are used up.

    ``ends`` are the chunks' ends; ``turn_end`` reads the end of an element of
    ``turns``. Cuts are gathered in short lists and these in a list, since each
    step copies what it adds to.
    """
    start = F.struct(
        F.array().cast("array<array<int>>").alias("full"),
        F.array().cast("array<int>").alias("cuts"),
        F.lit(0).alias("next"),
    )

    def fold(nearest: Callable[[Column, Column, Column], Column]) -> Column:
        def step(s: Column, turn: Column) -> Column:
            cut = nearest(ends, turn_end(turn), s["next"])
            is_full = F.size(s["cuts"]) >= CUTS_PER_LIST
            taken = _let(
                cut,
                lambda c: F.struct(
                    F.when(is_full, F.concat(s["full"], F.array(s["cuts"])))
                    .otherwise(s["full"])
                    .alias("full"),
                    F.when(is_full, F.array(c))
                    .otherwise(F.concat(s["cuts"], F.array(c)))
                    .alias("cuts"),
                    (c + 1).alias("next"),
                ),
            )
            return F.when(s["next"] >= F.size(ends), s).otherwise(taken)

        return F.aggregate(
            turns, start, step, lambda s: F.flatten(F.concat(s["full"], F.array(s["cuts"])))
        )

    return F.when(ends == F.array_sort(ends), fold(_nearest_sorted)).otherwise(
        fold(_nearest_any)
    )


def _by_turn(
    chunks: Column, turns: Column, emit: Callable[[Column, Column], Column]
) -> Column:
    """``emit(turn, its chunks)`` for each turn that takes chunks."""
    ends = F.transform(
        chunks, lambda c: F.coalesce(F.try_element_at(c["timestamp"], F.lit(-1)), F.lit(OPEN_END))
    )

    def share(cuts: Column, cut: Column, number: Column) -> Column:
        first = F.when(number == 0, F.lit(0)).otherwise(F.get(cuts, number - 1) + 1)
        own = _let(first, lambda f: F.slice(chunks, f + 1, cut - f + 1))
        return _let(own, lambda cs: emit(F.get(turns, number), cs))

    return _let(
        _let(ends, lambda es: cuts_of(es, turns, lambda t: t["segment"]["end"])),
        lambda cuts: F.transform(cuts, lambda cut, number: share(cuts, cut, number)),
    )


def align(chunks: Column, turns: Column) -> Column:
    """Give each transcript chunk its speaker: ``ATTRIBUTED`` from ``CHUNKS`` and
    ``TURNS``. NULL on either side gives NULL.

    Same rule as ``operators.align.align_chunks``. Files whose chunk ends ascend
    take a binary search per turn, others a look at each chunk left.
    """
    shares = _by_turn(
        chunks,
        turns,
        lambda turn, own: F.transform(
            own,
            lambda c: F.struct(
                turn["speaker"].alias("speaker"),
                c["text"].alias("text"),
                c["timestamp"].alias("timestamp"),
            ),
        ),
    )
    return F.when(chunks.isNotNull() & turns.isNotNull(), F.flatten(shares)).cast(ATTRIBUTED)


def align_by_turn(chunks: Column, turns: Column) -> Column:
    """Like ``align`` with one entry per turn: texts put together, from the start
    of its first chunk to the end of its last."""
    shares = _by_turn(
        chunks,
        turns,
        lambda turn, own: F.struct(
            turn["speaker"].alias("speaker"),
            F.array_join(F.transform(own, lambda c: c["text"]), "").alias("text"),
            F.array(
                F.get(F.get(own, 0)["timestamp"], 0),
                F.get(F.element_at(own, -1)["timestamp"], 1),
            ).alias("timestamp"),
        ),
    )
    return F.when(chunks.isNotNull() & turns.isNotNull(), shares).cast(ATTRIBUTED)


def to_text(nested: Column) -> Column:
    """JSON text of a nested column."""
    return F.to_json(nested)


def chunks_from_text(text: Column) -> Column:
    """``CHUNKS`` from JSON text; NULL or malformed gives NULL."""
    return F.from_json(text, CHUNKS)


def turns_from_text(text: Column) -> Column:
    """``TURNS`` from JSON text; NULL or malformed gives NULL."""
    return F.from_json(text, TURNS)


def join_candidates(candidates: Column) -> Column:
    """The candidate answers to one prompt as one text; NULL stays NULL."""
    return F.when(candidates.isNotNull(), F.concat_ws(" ", candidates))
