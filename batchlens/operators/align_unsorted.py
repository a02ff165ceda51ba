"""Alignment for files whose chunk ends do not ascend.

Without that order a turn's cut depends on where the turns before it left off:
``cut[k]`` is the nearest of the chunks from ``from[k] = cut[k-1] + 1`` on.

A file of up to ``FOLD_ROWS`` chunks is small enough to walk through its turns
within one row, over arrays of end times; the result is the same either way.
Larger files go by blocks of turns (``align_blocks``). In those that are out of
order nearly throughout, so that a block would need more chunks than a task
should hold, the cuts are found by improving lower bounds of ``from``, for all
turns at once:

    from[k] = k + max(cut[j] - j for j < k)

starting at ``from[k] = k``. A later start never yields an earlier cut, so the
bounds only grow, and once nothing changes they obey the sequential rule. Each
round is a few joins and scans; only turns whose bound moved are asked again.

"Nearest among the chunks from m on" is asked without looking at each of them:
chunk positions are grouped into runs of 1, 2, 4, ... chunks, and every suffix
``[m, 2**levels)`` is made of at most one run of each length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.functions.media import cuts_of, distance
from batchlens.operators.align_blocks import cuts_by_blocks, is_in
from batchlens.operators.ordered import (
    LongKeys,
    by_length,
    find_long_keys,
    last_seen,
    next_seen,
    previous,
    running_max,
    with_running,
)
from batchlens.session import ensure_checkpoint_dir


# Chunks of a file. Walking through it costs at most the square of that.
FOLD_ROWS = 10_000


def find_falling(
    numbered: DataFrame, key: str, fold_rows: int | None = None
) -> tuple[int, LongKeys | None]:
    """Number of files with a falling chunk end, and those of them too large to
    walk through."""
    fold_rows = fold_rows or FOLD_ROWS
    files = (
        numbered.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_falls").alias("_falling"))
        .where("_falling")
    )
    is_bulky = F.col("_rows") > fold_rows
    key_bytes = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 16
    n_files, n_bulky, bulky_rows, n_bytes = files.agg(
        F.count(F.lit(1)),
        F.count_if(is_bulky),
        F.sum(F.when(is_bulky, F.col("_rows"))),
        F.sum(F.when(is_bulky, key_bytes.cast("long"))),
    ).first()
    if not n_bulky:
        return n_files, None
    ensure_checkpoint_dir(numbered.sparkSession)
    frame = files.where(is_bulky).select(F.col(key).alias(f"_long_{key}")).checkpoint()
    return n_files, LongKeys(frame, (key,), n_bulky, bulky_rows, fold_rows, n_bytes)


def cuts_any_order(
    points: DataFrame,
    key: str,
    bulky: LongKeys | None,
    long: LongKeys | None,
    fold_rows: int | None = None,
) -> DataFrame:
    """The turns of files with falling ends, with their cut as ``_place``."""

    def cuts(bulky: LongKeys | None, points: DataFrame) -> DataFrame:
        most = FOLD_ROWS if fold_rows is None else fold_rows
        if bulky is None:
            return _folded(points, key, most)
        placed, wide = cuts_by_blocks(points, key, long)
        if wide is None:
            return placed
        return placed.unionByName(_by_rounds(is_in(points, wide, key, "left_semi"), key, long))

    nothing = F.lit(None).cast(points.schema["_chunk"].dataType)
    return by_length(bulky, cuts, points).select(
        key,
        F.lit(1).alias("_kind"),
        "_index",
        "_speaker",
        nothing.alias("_chunk"),
        "_place",
    )


def _folded(points: DataFrame, key: str, fold_rows: int) -> DataFrame:
    """Small files, each within one row of arrays. Each turn takes a chunk at
    least, so turns past the largest possible number of chunks stay out."""
    is_turn = (F.col("_kind") == 1) & (F.col("_index") < fold_rows)
    ends = F.collect_list(F.when(F.col("_kind") == 0, F.struct("_index", "_at")))
    turns = F.collect_list(F.when(is_turn, F.struct("_index", "_at", "_speaker")))
    files = points.groupBy(key).agg(
        F.array_sort(ends)["_at"].alias("_ends"), F.array_sort(turns).alias("_turns")
    )
    cuts = cuts_of(F.col("_ends"), F.col("_turns"), lambda t: t["_at"])
    taker = F.get("_turns", F.col("_turn"))
    return files.select(key, "_turns", F.posexplode(cuts).alias("_turn", "_cut")).select(
        key,
        taker["_index"].alias("_index"),
        taker["_speaker"].alias("_speaker"),
        F.col("_cut").cast("long").alias("_place"),
    )


def _by_rounds(points: DataFrame, key: str, long: LongKeys | None) -> DataFrame:
    """Files of any size, all turns at once."""
    ensure_checkpoint_dir(points.sparkSession)
    chunks, turns = points.where("_kind = 0"), points.where("_kind = 1")
    last = chunks.agg(F.max("_index")).first()[0] or 0
    levels = max(1, int(last).bit_length())
    every_level = F.sequence(F.lit(0), F.lit(levels))
    run_members = chunks.select(
        key,
        "_at",
        "_kind",
        "_index",
        F.explode(every_level).alias("_level"),
    ).withColumn("_run", F.expr("shiftright(_index, _level)"))
    run = [key, "_level", "_run"]
    long_runs = None if long is None else find_long_keys(run_members, run, long.max_rows)

    def nearest(asked: DataFrame) -> DataFrame:
        """``(key, turn, _found)`` for turns that have chunks left from ``_from`` on."""
        left = F.lit(1 << levels) - F.col("_from")
        questions = (
            asked.withColumn("_left_over", left)
            .where("_left_over > 0")
            .withColumn("_level", F.explode(every_level))
            .where("shiftright(_left_over, _level) % 2 = 1")
            .select(
                key,
                "_at",
                F.lit(1).alias("_kind"),
                "_index",
                "_level",
                F.expr(
                    "shiftright(_from + _left_over % shiftleft(1L, _level), _level)"
                ).alias("_run"),
            )
        )
        line = with_running(
            run_members.unionByName(questions),
            run,
            ["_at", "_kind", "_index"],
            long_runs,
            keep_blocks=True,
            _before=previous(F.struct("_at", "_kind")),
        )
        repeats = F.coalesce(
            (F.col("_before._kind") == 0) & (F.col("_before._at") == F.col("_at")), F.lit(False)
        )
        mark = F.when(
            (F.col("_kind") == 0) & ~repeats,
            F.struct(F.col("_at").alias("end"), F.col("_index").alias("index")),
        )
        seen = with_running(
            line.withColumn("_mark", mark).drop("_before"),
            run,
            ["_at", "_kind", "_index"],
            long_runs,
            _left=last_seen(F.col("_mark")),
            _right=next_seen(F.col("_mark")),
        )

        def candidate(side: str) -> Column:
            far = distance(F.col(f"{side}.end"), F.col("_at")).alias("far")
            return F.when(F.col(side).isNotNull(), F.struct(far, F.col(f"{side}.index")))

        # On a tie the smaller index wins, on whichever side it lies.
        return (
            seen.where(F.col("_kind") == 1)
            .withColumn("_best", F.least(candidate("_left"), candidate("_right")))
            .where(F.col("_best").isNotNull())
            .groupBy(key, "_index")
            .agg(F.min("_best")["index"].alias("_found"))
        )

    state = turns.select(
        key,
        "_index",
        "_at",
        "_speaker",
        F.col("_index").alias("_from"),
        F.lit(None).cast("long").alias("_cut"),
        F.lit(True).alias("_moved"),
    ).checkpoint()
    while True:
        found = nearest(state.where("_moved")).select(
            F.col(key).alias("_k"), F.col("_index").alias("_i"), "_found"
        )
        asked = state.join(
            found, state[key].eqNullSafe(found["_k"]) & (state["_index"] == found["_i"]), "left"
        )
        # A turn with no chunks left cuts where it starts, past the last chunk.
        cut = F.when(F.col("_moved"), F.coalesce("_found", "_from")).otherwise(F.col("_cut"))
        ahead = with_running(
            asked.select(key, "_index", "_at", "_speaker", "_from", cut.alias("_cut")),
            [key],
            ["_index"],
            long,
            keep_blocks=True,
            _ahead=running_max(F.col("_cut") - F.col("_index")),
        )
        bounds = with_running(ahead, [key], ["_index"], long, _before=previous(F.struct("_ahead")))
        start = F.col("_index") + F.coalesce(F.col("_before._ahead"), F.lit(0))
        state = bounds.select(
            key,
            "_index",
            "_at",
            "_speaker",
            start.alias("_from"),
            "_cut",
            (start != F.col("_from")).alias("_moved"),
        ).checkpoint()
        if state.where("_moved").isEmpty():
            break

    return state.select(key, "_index", "_speaker", F.col("_cut").alias("_place"))
