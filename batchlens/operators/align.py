"""Nearest-time alignment of transcript chunks with speaker turns, one row each.

Turns are served in order. Each takes the chunks nobody has taken yet, up to
the one whose end lies nearest to the end of the turn (the earlier one on a
tie). So each turn takes at least one chunk while any are left, and chunks
behind the last turn's cut belong to nobody.

Where chunk ends never decrease, that sequential rule has a closed form. With
``near[k]`` the chunk nearest to turn ``k`` among all chunks of the file,

    cut[k] = k + max(near[j] - j for j <= k)

and a chunk belongs to the first turn whose cut reaches it. Both parts are
running values over one union of chunks and turns, so no pair of a turn and a
chunk is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.functions.media import distance
from batchlens.operators.concat import concat_ordered
from batchlens.operators.ordered import (
    BROADCAST_BYTES,
    LongKeys,
    by_length,
    find_long_keys,
    last_seen,
    next_seen,
    previous,
    running_max,
    running_sum,
    with_running,
)

# Stands for the end of a chunk that has none: the largest double.
OPEN_END = 1.7976931348623157e308


def number_chunks(
    chunks: DataFrame,
    key: str = "file_ids",
    order: Sequence[str] = ("start", "chunk_id"),
    long: LongKeys | None = None,
) -> DataFrame:
    """Add ``chunk`` (0, 1, ... per file), ``_end`` and how it compares with the
    end before: ``_repeats`` for an equal one, ``_falls`` for a smaller one."""
    end = F.coalesce(F.col("end"), F.lit(OPEN_END))
    columns = list(dict.fromkeys([key, *order, "text", "start", "end"]))
    numbered = with_running(
        chunks.select(*columns, end.alias("_end")),
        [key],
        order,
        long,
        _number=running_sum(F.lit(1).cast("long")),
        _before=previous(F.struct(end.alias("end"))),
    )
    before = F.col("_before.end")
    return numbered.select(
        *columns,
        "_end",
        (F.col("_number") - 1).alias("chunk"),
        F.coalesce(before == F.col("_end"), F.lit(False)).alias("_repeats"),
        F.coalesce(before > F.col("_end"), F.lit(False)).alias("_falls"),
    )


def align_chunks(
    turns: DataFrame,
    chunks: DataFrame,
    key: str = "file_ids",
    chunk_order: Sequence[str] = ("start", "chunk_id"),
    long: LongKeys | None = None,
    ends_ascend: bool | None = None,
) -> DataFrame:
    """``(key, chunk, turn, speaker, text, start, end)``, one row per taken chunk.

    ``turns`` holds ``key, turn, speaker, end`` with ``turn`` counting from 0,
    ``chunks`` holds ``key, text, start, end`` and the order columns. Pass
    ``ends_ascend=True`` where chunk ends never decrease within a file: a file
    that breaks it fails the job. Otherwise that is found out by a job, and files
    that break it take the path of ``align_unsorted``. ``long`` says that these are rows of
    long files (see ``ordered.by_length``).
    """
    numbered = number_chunks(chunks, key, chunk_order, long)
    points = union_points(turns, numbered, key)
    if ends_ascend:
        broken = F.raise_error(F.lit("a chunk ends before the one before it: ends_ascend is false"))
        at = F.when(F.col("_falls"), broken.cast("double")).otherwise(F.col("_at"))
        points = points.withColumn("_at", at)
        return _assign(cuts_ascending(points, key, long), key, long)
    from batchlens.operators.align_unsorted import cuts_any_order, find_falling

    n_falling, bulky = find_falling(numbered, key)
    if not n_falling:
        return _assign(cuts_ascending(points, key, long), key, long)
    marked = _mark_falling(points, key, long)
    # In files that break the order only the chunks are kept from the closed form.
    kept = cuts_ascending(marked, key, long, ["_in_falling"]).where(
        (F.col("_kind") == 0) | ~F.col("_in_falling")
    )
    takers = cuts_any_order(marked.where("_in_falling"), key, bulky, long)
    return _assign(kept.drop("_in_falling").unionByName(takers), key, long)


def union_points(turns: DataFrame, numbered: DataFrame, key: str) -> DataFrame:
    """Chunk ends (``_kind`` 0) and turn ends (1) as points on one time line."""
    payload = F.struct("text", "start", "end")
    chunk_points = numbered.select(
        key,
        F.col("_end").alias("_at"),
        F.lit(0).alias("_kind"),
        F.col("chunk").alias("_index"),
        "_repeats",
        "_falls",
        F.lit(None).cast(turns.schema["speaker"].dataType).alias("_speaker"),
        payload.alias("_chunk"),
    )
    turn_points = turns.select(
        key,
        F.col("end").alias("_at"),
        F.lit(1).alias("_kind"),
        F.col("turn").alias("_index"),
        F.lit(False).alias("_repeats"),
        F.lit(False).alias("_falls"),
        F.col("speaker").alias("_speaker"),
        F.lit(None).cast(chunk_points.schema["_chunk"].dataType).alias("_chunk"),
    )
    return chunk_points.unionByName(turn_points)


def _mark_falling(points: DataFrame, key: str, long: LongKeys | None) -> DataFrame:
    """Add ``_in_falling``: does any chunk end of the file fall?"""
    if long is None:
        in_file = Window.partitionBy(key)
        return points.withColumn("_in_falling", F.max("_falls").over(in_file))
    # One row per long file, of which there are few.
    files = points.groupBy(F.col(key).alias("_of")).agg(F.max("_falls").alias("_in_falling"))
    if long.n_bytes <= BROADCAST_BYTES:
        files = F.broadcast(files)
    return points.join(files, points[key].eqNullSafe(F.col("_of"))).drop("_of")


def cuts_ascending(
    points: DataFrame, key: str, long: LongKeys | None, others: Sequence[str] = ()
) -> DataFrame:
    """Add ``_place``, a point's place among the chunks, where chunk ends ascend:
    the index of a chunk and the cut of a turn."""
    kept = [key, *others, "_kind", "_index", "_speaker", "_chunk"]
    # Chunks with one and the same end are represented by the first of them.
    mark = F.when(
        (F.col("_kind") == 0) & ~F.col("_repeats"),
        F.struct(F.col("_at").alias("end"), F.col("_index").alias("index")),
    )
    near = with_running(
        points,
        [key],
        ["_at", "_kind", "_index"],
        long,
        _left=last_seen(mark),
        _right=next_seen(mark),
    ).select(*kept, F.when(F.col("_kind") == 1, _nearer() - F.col("_index")).alias("_drift"))
    drifts = with_running(
        near, [key], ["_kind", "_index"], long, _ahead=running_max(F.col("_drift"))
    )
    cut = F.when(F.col("_kind") == 1, F.col("_index") + F.col("_ahead"))
    return drifts.select(*kept, cut.otherwise(F.col("_index")).alias("_place"))


def _nearer() -> Column:
    """Index of the nearer of ``_left`` and ``_right``, the left one on a tie."""
    left = distance(F.col("_left.end"), F.col("_at"))
    right = distance(F.col("_right.end"), F.col("_at"))
    left_wins = F.col("_left").isNotNull() & (left <= right)
    return F.when(F.col("_right").isNull() | left_wins, F.col("_left.index")).otherwise(
        F.col("_right.index")
    )


def _assign(cuts: DataFrame, key: str, long: LongKeys | None) -> DataFrame:
    """Give each chunk to the first turn whose cut (``_place``) reaches it."""
    owner = F.when(
        F.col("_kind") == 1,
        F.struct(F.col("_index").alias("turn"), F.col("_speaker").alias("speaker")),
    )
    owned = with_running(
        cuts, [key], ["_place", "_kind", "_index"], long, _owner=next_seen(owner)
    )
    return owned.where((F.col("_kind") == 0) & F.col("_owner").isNotNull()).select(
        key,
        F.col("_index").alias("chunk"),
        F.col("_owner.turn").alias("turn"),
        F.col("_owner.speaker").alias("speaker"),
        F.col("_chunk.text").alias("text"),
        F.col("_chunk.start").alias("start"),
        F.col("_chunk.end").alias("end"),
    )


def align_turns(
    aligned: DataFrame,
    key: str = "file_ids",
    long: LongKeys | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """``(key, turn, part, speaker, text, start, end)``: one row per turn that
    took chunks, its texts put together, from the start of its first chunk to the
    end of its last. With ``max_chars`` long turns come in parts (see
    ``concat_ordered``), each with its own span. ``long`` says that these are rows of long files."""

    def texts(long_turns: LongKeys | None, rows: DataFrame) -> DataFrame:
        return concat_ordered(
            rows,
            [key, "turn"],
            ["chunk"],
            "text",
            long_turns,
            max_chars,
            speaker=F.first("speaker"),
            start=F.min_by("start", "chunk"),
            end=F.max_by("end", "chunk"),
        )

    # No turn is longer than its file, so only long files are measured again.
    long_turns = None
    if long is not None:
        long_turns = find_long_keys(aligned, [key, "turn"], long.max_rows)
    return by_length(long_turns, texts, aligned).select(
        key, "turn", "part", "speaker", "text", "start", "end"
    )
