"""Generated prompt workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The vocabulary and the two questions, wording and spelling as is.
WORDS = [
    "apple", "banana", "carrot", "dog", "elephant",
    "frog", "guitar", "house", "ice cream", "jacket",
    "kite", "lion", "moon", "nest", "orange",
    "piano", "queen", "rabbit", "snake", "tree",
]
SPELL = (
    "[INST] <<SYS>>Answer to my quesiton in one sentence! Here is an example: \n"
    " Question: What day is today? Answer: Today is monday! <</SYS>>"
    " How do you spell '{word}'?[/INST]"
)
DEFINE = (
    "[INST] <<SYS>> Answer to my quesiton in one sentence! Here is an example: \n"
    "Question: What day is today? Answer: Today is monday!<</SYS>>"
    " What is the definition of '{word}'?[/INST]"
)
SPELL_BRIEFLY = (
    "Answer to my quesiton in one sentence! Be extremely brief and succinct."
    " Do not be too wordy! Here is an example: \n"
    " Question: How do you spell today? Answer: T-O-D-A-Y!\n"
    "How do you spell '{word}'?"
)
DEFINE_BRIEFLY = (
    "Answer to my quesiton in one sentence! Be extremely brief and succinct."
    " Do not be too wordy! Here is an example: \n"
    " Question: What day is today? Answer: Today is monday!\n"
    "What is the definition of '{word}'?"
)

_MODULUS = 2_147_483_648


def question(
    row_id: Column, seed: int = 0, spell: str = SPELL, define: str = DEFINE
) -> Column:
    """A spelling or definition question about one of ``WORDS``.

    The choice is integer arithmetic on the row's id (a linear congruential
    step, upper bits used), so it is the same on every run and every engine.
    """
    start = F.pmod(
        F.pmod(row_id.cast("long"), F.lit(_MODULUS)) + seed * 48_271, F.lit(_MODULUS)
    )
    state = F.pmod(start * 1_103_515_245 + 12_345, F.lit(_MODULUS))
    bits = F.floor(state / 65_536)
    words = F.array(*[F.lit(w) for w in WORDS])
    word = F.get(words, F.pmod(F.floor(bits / 2), F.lit(len(WORDS))).cast("int"))
    before_spell, after_spell = spell.split("{word}")
    before_define, after_define = define.split("{word}")
    return F.when(
        F.pmod(bits, F.lit(2)) == 0,
        F.concat(F.lit(before_spell), word, F.lit(after_spell)),
    ).otherwise(F.concat(F.lit(before_define), word, F.lit(after_define)))


def synthetic_prompts(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``(id, text)`` with ``n`` rows, made on the executors."""
    return spark.range(n).select("id", question(F.col("id"), seed).alias("text"))
