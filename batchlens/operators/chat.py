"""Multi-turn prompts from one row per message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.functions.prompts import chat_piece
from batchlens.operators.concat import concat_ordered
from batchlens.operators.ordered import (
    LongKeys,
    by_length,
    find_long_keys,
    following,
    previous,
    with_running,
)


def chat_prompts(
    messages: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    max_rows: int | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """``(key, part, prompt)``; a conversation is one row, part 0.

    Each message becomes its piece of the prompt from its own role and those of
    its neighbours, and the pieces are joined in order. With ``max_chars`` long
    conversations come in several parts (see ``concat_ordered``). Neighbours,
    sizes and the joining share one shuffle and one sort.
    """

    def prompts(long: LongKeys | None, rows: DataFrame) -> DataFrame:
        near = with_running(
            rows,
            [key],
            [order],
            long,
            _before=previous(F.struct("role")),
            _after=following(F.struct("role")),
        )
        piece = chat_piece(
            F.col("role"), F.col("text"), F.col("_before"), F.col("_after")
        )
        pieces = near.select(key, order, piece.alias("prompt"))
        return concat_ordered(pieces, [key], [order], "prompt", long, max_chars)

    slim = messages.select(key, order, "role", "text")
    return by_length(find_long_keys(slim, [key], max_rows), prompts, slim)
