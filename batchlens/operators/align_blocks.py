"""Alignment of large files whose chunk ends do not ascend, block by block.

A turn's cut depends on where the turns before it left off. Entered at chunk
``p`` a turn leaves at ``f(p)``, one past the nearest of the chunks from ``p`` on,
and a later entry never leaves earlier. So a block of turns is a function of its
entry that only climbs, in few steps since entries meet: every block works its
own function out, one scan over the blocks follows the entries, and every block
then cuts once more from the entry it really has. Nothing is asked again.

What a block has to know of the chunks follows from *segments*: the parts that
the chunks fall into wherever all ends so far lie before all ends to come. Ends
are out of order inside a segment only. A turn at time ``t``

* leaves a segment whose ends all lie at or before ``t`` behind, if it was not past
  it, up to one of its chunks;
* goes at most to the end of the first segment whose ends all lie at or after
  ``t``, or, entered beyond that, of the segment it entered;
* entered beyond it, takes the least end left in its segment, whatever ``t`` is.

Running maxima of the first two bound all entries and exits of a block, and with
them the chunks it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.operators.ordered import (
    LongKeys,
    coming_min,
    last_seen,
    previous,
    running_max,
    running_sum,
    with_running,
)
from batchlens.sources.scratch import written

TURNS_PER_BLOCK = 4096
# Chunks a block may need. Files that go beyond, out of order nearly throughout,
# take another path.
WINDOW_ROWS = 500_000


def _matched(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of one name, NULL with NULL."""
    own = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = reduce(lambda a, b: a & b, (left[n].eqNullSafe(own[f"_r_{n}"]) for n in names))
    return left.join(own, on, how).drop(*[f"_r_{n}" for n in names])


def _segmented(chunks: DataFrame, key: str, long: LongKeys | None) -> DataFrame:
    """Chunks with ``_seg``, the number of their segment in the file."""
    spans = with_running(
        chunks, [key], ["_index"], long, keep_blocks=True,
        _most=running_max(F.col("_at")), _least=coming_min(F.col("_at")),
    )
    before = with_running(
        spans, [key], ["_index"], long, keep_blocks=True, _before=previous(F.struct("_most"))
    )
    starts = F.coalesce(F.col("_before._most") < F.col("_least"), F.lit(True)).cast("long")
    numbered = with_running(
        before.withColumn("_starts", starts), [key], ["_index"], long, _number=running_sum(F.col("_starts"))
    )
    return numbered.select(key, "_at", "_index", (F.col("_number") - 1).alias("_seg"))


def _located(turns: DataFrame, segments: DataFrame, key: str, long: LongKeys | None) -> DataFrame:
    """Turns with ``_below``, the last segment wholly at or before them (-1: none)
    and its ``_start``, and ``_above``, the first one wholly at or after them."""
    nobody = F.lit(None).cast(turns.schema["_speaker"].dataType)

    def ends(at: str, kind: int) -> DataFrame:
        return segments.select(
            key, F.col(at).alias("_at"), F.lit(kind).alias("_kind"), F.col("_seg").alias("_index"),
            nobody.alias("_speaker"), "_start",
        )

    asked = turns.select(
        key, "_at", F.lit(1).alias("_kind"), "_index", "_speaker", F.lit(None).cast("long").alias("_start")
    )
    # Of equal times the greatest ends come first and the least ends last.
    line = ends("_most", 0).unionByName(asked).unionByName(ends("_least", 2))
    seen = with_running(
        line,
        [key],
        ["_at", "_kind", "_index"],
        long,
        _done=running_sum((F.col("_kind") == 0).cast("long")),
        _begun=running_sum((F.col("_kind") == 2).cast("long")),
        _left=last_seen(F.when(F.col("_kind") == 0, F.col("_start"))),
    )
    return seen.where("_kind = 1").select(
        key,
        "_at",
        "_index",
        "_speaker",
        (F.col("_done") - 1).alias("_below"),
        F.col("_left").alias("_start"),
        F.col("_begun").alias("_above"),
    )


@dataclass(frozen=True)
class Blocks:
    """``spans``: bounds of every block, ``wide`` marking files with too large
    ones; ``turns`` and ``chunks`` as written tables."""

    spans: DataFrame
    turns: DataFrame
    chunks: DataFrame


def plan_blocks(
    points: DataFrame, key: str, long: LongKeys | None, turns_per_block: int, window_rows: int
) -> Blocks:
    chunks = points.where("_kind = 0").select(key, "_at", "_index")
    turns = points.where("_kind = 1").select(key, "_at", "_index", "_speaker")
    placed = written(_segmented(chunks, key, long), "segmented-chunks")
    segments = written(
        placed.groupBy(key, "_seg").agg(
            F.min("_index").alias("_start"), (F.max("_index") + 1).alias("_stop"),
            F.min("_at").alias("_least"), F.max("_at").alias("_most"),
        ),
        "segments",
    )
    block = F.floor(F.col("_index") / turns_per_block).cast("long")
    asked = written(_located(turns, segments, key, long).withColumn("_block", block), "located-turns")
    per_block = asked.groupBy(key, "_block").agg(
        F.min("_index").alias("_first"),
        F.max("_index").alias("_last"),
        F.max(F.col("_start") - F.col("_index")).alias("_low"),
        F.max(F.col("_above") - F.col("_index")).alias("_high"),
    )
    # A row per block, of which even a long file has few.
    ordered = Window.partitionBy(key).orderBy("_block")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = lambda c, w: F.greatest(F.coalesce(F.max(c).over(w), F.lit(0)), F.lit(0))
    spans = per_block.select(
        key,
        "_block",
        (F.col("_first") + ahead("_low", earlier)).alias("_lo"),
        (F.col("_first") + ahead("_high", earlier)).alias("_hi_seg"),
        (F.col("_last") + 1 + ahead("_high", so_far)).alias("_stop_seg"),
    )
    sizes = segments.groupBy(key).agg(F.max("_stop").alias("_n"))
    spans = _matched(spans, sizes, [key])
    for name in ("_hi", "_stop"):
        start = segments.select(key, F.col("_seg").alias(f"{name}_seg"), F.col("_start").alias(f"{name}_start"))
        spans = _matched(spans, start, [key, f"{name}_seg"], "left").withColumn(
            name, F.coalesce(f"{name}_start", "_n")
        )
    width = F.col("_stop") - F.col("_lo")
    spans = spans.where("_lo < _n").select(
        key,
        "_block",
        "_lo",
        F.greatest("_lo", "_hi").alias("_hi"),
        "_stop",
        F.max(width).over(Window.partitionBy(key)).alias("_widest"),
    )
    spans = spans.withColumn("_wide", F.col("_widest") > window_rows).drop("_widest")
    return Blocks(written(spans, "blocks"), asked, placed)


class _Chunks:
    """The chunk ends a block needs, from chunk ``first`` on."""

    def __init__(self, first: int, ends: np.ndarray, segments: np.ndarray):
        self.first, self.ends, self.segments = first, ends, segments
        self.stop = first + len(ends)
        # Later segments only hold later ends.
        self.least = first + _nearest_from(ends, np.zeros(len(ends)))

    def after(self, entries: np.ndarray, at: float, below: int, above: int) -> np.ndarray:
        """Where a turn leaves for each of the ascending ``entries``."""
        start = max(self.first, self.first + int(np.searchsorted(self.segments, below)))
        up, end = (self.first + int(np.searchsorted(self.segments, above, s)) for s in ("left", "right"))
        left = entries.copy()
        beyond = int(np.searchsorted(entries, up))
        gone = int(np.searchsorted(entries, self.stop))
        left[beyond:gone] = self.least[entries[beyond:gone] - self.first] + 1
        if beyond:
            part = slice(start - self.first, end - self.first)
            near = start + _nearest_from(*_distance(self.ends[part], at))
            left[:beyond] = near[np.maximum(entries[:beyond], start) - start] + 1
        return left


def _distance(ends: np.ndarray, at: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact distances: their doubles, and what rounding lost of them."""
    difference = ends - at
    part = difference - ends
    lost = (ends - (difference - part)) - (at + part)
    return np.abs(difference), np.where(difference < 0, -lost, lost)


def _nearest_from(far: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """For each place the first least value from there on."""
    order = np.lexsort((lost, far))
    new = np.ones(len(far), dtype=np.int64)
    new[1:] = (far[order[1:]] != far[order[:-1]]) | (lost[order[1:]] != lost[order[:-1]])
    rank = np.empty(len(far), dtype=np.int64)
    rank[order] = np.cumsum(new)
    back = rank[::-1]
    at = np.where(back == np.minimum.accumulate(back), np.arange(len(far)), 0)
    return len(far) - 1 - np.maximum.accumulate(at)[::-1]


def _arrays(lists: pa.ListArray, row: int, *fields: str) -> list[np.ndarray]:
    values = lists[row].values
    return [values.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _gathered(blocks: Blocks, spans: DataFrame, key: str, turns_per_block: int) -> DataFrame:
    """Every block with its ``turns`` and the ``chunks`` it may reach, as arrays."""
    piece = lambda c: F.floor(c / turns_per_block).cast("long")
    pieces = spans.withColumn("_piece", F.explode(F.sequence(piece(F.col("_lo")), piece(F.col("_stop") - 1))))
    chunks = blocks.chunks.withColumn("_piece", piece(F.col("_index")))
    near = _matched(chunks, pieces.select(key, "_block", "_piece", "_lo", "_stop"), [key, "_piece"])
    near = near.where("_index >= _lo AND _index < _stop").groupBy(key, "_block").agg(
        F.sort_array(F.collect_list(F.struct("_index", "_at", "_seg"))).alias("chunks")
    )
    asked = blocks.turns.groupBy(key, "_block").agg(
        F.sort_array(F.collect_list(F.struct("_index", "_at", "_below", "_above", "_speaker"))).alias("turns")
    )
    return _matched(_matched(spans, near, [key, "_block"]), asked, [key, "_block"])


def _chunks_of(batch: pa.RecordBatch, row: int) -> _Chunks:
    index, at, segments = _arrays(batch.column("chunks"), row, "_index", "_at", "_seg")
    return _Chunks(int(index[0]), at, segments)


def _functions(gathered: DataFrame, key: str) -> DataFrame:
    """``(key, _block, entries, exits)``: entered from ``entries[i]`` on a block is
    left at ``exits[i]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, exits = [], []
            for row in range(batch.num_rows):
                chunks = _chunks_of(batch, row)
                lo, hi = (batch.column(c)[row].as_py() for c in ("_lo", "_hi"))
                now, since = np.arange(lo, hi + 1), np.arange(lo, hi + 1)
                for at, below, above in zip(*_arrays(batch.column("turns"), row, "_at", "_below", "_above"), strict=True):
                    now, first = np.unique(chunks.after(now, at, below, above), return_index=True)
                    since = since[first]
                entries.append(since)
                exits.append(now)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("_block"), pa.array(entries, kind), pa.array(exits, kind)],
                [key, "_block", "entries", "exits"],
            )

    kind = gathered.schema[key].dataType.simpleString()
    return gathered.mapInArrow(run, f"{key} {kind}, _block bigint, entries array<bigint>, exits array<bigint>")


def _entered(functions: DataFrame, key: str) -> DataFrame:
    """``(key, _block, _entry)``: one scan over the blocks of each file in order,
    of which nothing but the present place is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place, begun = None, 0, False
        for batch in batches:
            found = []
            for row, name in enumerate(batch.column(key).to_pylist()):
                if not begun or name != file:
                    file, place, begun = name, 0, True
                found.append(place)
                entries, exits = (batch.column(c)[row].values.to_numpy() for c in ("entries", "exits"))
                place = int(exits[np.searchsorted(entries, place, "right") - 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("_block"), pa.array(found, pa.int64())], [key, "_block", "_entry"]
            )

    kind = functions.schema[key].dataType.simpleString()
    ordered = functions.repartition(key).sortWithinPartitions(key, "_block")
    return ordered.mapInArrow(run, f"{key} {kind}, _block bigint, _entry bigint")


def _cut(gathered: DataFrame, key: str) -> DataFrame:
    """``(key, _index, _speaker, _place)`` of blocks with their true ``_entry``;
    turns that find no chunk left take none and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunks = _chunks_of(batch, row)
                now = np.array([batch.column("_entry")[row].as_py()])
                places = []
                for at, below, above in zip(*_arrays(batch.column("turns"), row, "_at", "_below", "_above"), strict=True):
                    if now[0] >= chunks.stop:
                        break
                    now = chunks.after(now, at, below, above)
                    places.append(int(now[0]) - 1)
                turns = batch.column("turns")[row].values[: len(places)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(key)[row].as_py()] * len(places), batch.schema.field(key).type),
                        turns.field("_index"),
                        turns.field("_speaker"),
                        pa.array(places, pa.int64()),
                    ],
                    [key, "_index", "_speaker", "_place"],
                )

    name = gathered.schema[key].dataType.simpleString()
    speaker = gathered.schema["turns"].dataType.elementType["_speaker"].dataType.simpleString()
    return gathered.mapInArrow(run, f"{key} {name}, _index bigint, _speaker {speaker}, _place bigint")


def cuts_by_blocks(
    points: DataFrame,
    key: str,
    long: LongKeys | None,
    turns_per_block: int | None = None,
    window_rows: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``(key, _index, _speaker, _place)`` of the turns of ``points``, and the keys
    of files left out since their blocks need too many chunks (None: no file).

    A fixed number of tables is written, however the ends are ordered.
    """
    turns_per_block = turns_per_block or TURNS_PER_BLOCK
    blocks = plan_blocks(points, key, long, turns_per_block, window_rows or WINDOW_ROWS)
    wide = blocks.spans.where("_wide").select(key).distinct()
    spans = blocks.spans.where("NOT _wide").drop("_wide")
    gathered = written(_gathered(blocks, spans, key, turns_per_block), "gathered")
    functions = written(_functions(gathered, key), "functions")
    cuts = _cut(_matched(gathered, _entered(functions, key), [key, "_block"]), key)
    return cuts, None if wide.isEmpty() else wide


def is_in(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows of ``df`` whose file is among ``keys`` (left_semi) or not (left_anti)."""
    own: Column = df[key].eqNullSafe(keys[key])
    return df.join(keys, own, how)
