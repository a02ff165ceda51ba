"""Quality rules whose cutoffs carry a guarantee: few good documents are lost."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import small_side, written
from batchlens.llm.words import plain_words

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@dataclass(frozen=True)
class Rule:
    """Reject where ``score`` exceeds a cutoff; ``grid`` goes from lenient to strict."""

    name: str
    score: Column
    grid: tuple[float, ...]


def _down(top: float, step: float) -> tuple[float, ...]:
    count = round(top / step)
    return tuple(round(top - step * i, 6) for i in range(count))


#: The cutoffs each rule may take, from lenient to strict.
GRIDS = {
    "symbols": _down(3.0, 0.05),
    "lines": _down(1.0, 0.05),
    "word_length": _down(20.0, 0.25),
}


def default_rules() -> list[Rule]:
    """Symbols per word, share of repeated lines, and mean word length."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    scores = {
        "symbols": F.col("n_symbols") / words,
        "lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "word_length": F.col("word_chars") / words,
    }
    return [Rule(name, score, GRIDS[name]) for name, score in scores.items()]


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``FEATURES`` and ``n_lines`` (lines with a word).

    Everything is computed inside the row. Words in repeated 3-word windows are
    found by sorting the window hashes of a text: n log n, whatever it repeats.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    one = df.withColumns(
        {
            "__words": plain_words(F.col(text)),
            "__lines": F.filter(
                F.split(body, "\n"), lambda s: F.length(F.translate(s, " \t\r\x0b\x0c", "")) > 0
            ),
        }
    )
    n = F.size("__words")
    two = one.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(body, " \t\n\r\x0b\x0c", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__windows": F.when(
                n >= 3,
                F.transform(
                    F.sequence(F.lit(0), n - 3),
                    lambda i: F.xxhash64(
                        F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)
                    ),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Most texts repeat nothing, which a sort of plain numbers shows.
    three = two.withColumn("__sorted", F.sort_array("__windows"))
    any_twice = F.size(F.array_distinct("__windows")) < F.size("__windows")
    four = three.withColumn(
        "__pairs",
        F.when(
            any_twice,
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("__sorted")

    def twice(x: Column, i: Column) -> Column:
        same = lambda j: F.coalesce(F.get("__pairs", j)["h"] == x["h"], F.lit(False))
        return same(i - 1) | same(i + 1)

    covered = F.flatten(
        F.transform(
            F.filter("__pairs", twice),
            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
        )
    )
    five = four.withColumn(
        "n_repeat_words",
        F.coalesce(
            F.when(F.col("__pairs").isNotNull(), F.size(F.array_distinct(covered))), F.lit(0)
        ).cast("long"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return five.withColumn("base_failed", failed).drop(
        "__words", "__lines", "__windows", "__pairs"
    )


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed term by term in logarithms."""
    step = F.log(F.lit(p / (1 - p)))

    def add(state: Column, i: Column) -> Column:
        # state: log of the term i - 1, and log of the sum so far
        term = state["term"] + F.log((n - i + 1) / i) + step
        top = F.greatest(state["total"], term)
        low = F.least(state["total"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("total"))

    first = (n * F.log1p(F.lit(-p))).cast("double")
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    total = F.aggregate(
        terms, F.struct(first.alias("term"), first.alias("total")), add, lambda s: F.exp(s["total"])
    )
    return F.when(k >= n, F.lit(1.0)).otherwise(total)


def choose_cutoffs(
    scored: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    stratum: str = "lang",
    key: str = "doc_id",
    most_lost: float = 0.03,
    error: float = 0.1,
) -> DataFrame:
    """``(stratum, rule, cutoff)``: cutoffs that lose few good documents.

    ``labels`` holds ``(key, quality)``, 1 for good. A cutoff is safe where the
    labelled good documents it rejects are so few that, were the true share of
    good documents lost above ``most_lost / rules``, seeing no more would have a
    binomial probability of at most ``error / (strata * rules)``: the exact
    (Clopper-Pearson) bound, corrected for all strata and rules (Bonferroni).
    Cutoffs of a rule are tested from the most lenient down to the first failure,
    which needs no correction more (fixed sequence). So with probability
    ``1 - error`` every stratum loses at most ``most_lost`` of its good
    documents. Of the safe cutoffs the one that rejects most bad documents less
    good ones is taken, the most lenient of equals; a stratum with too few labels
    for any guarantee, or a rule that rejects nothing bad, gets none.

    Documents that fail the base rules are not counted: they never reach these.
    Documents labelled several times count once, with their lowest label; NULL
    labels and ids do not count. Only counts per (stratum, rule, grid step) leave
    the tasks.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.min("quality").alias("__quality"))
    )
    population = scored.where(~F.col("base_failed")).join(known, F.col(key) == F.col("__key"))
    # The first grid step (from lenient) whose cutoff the score exceeds.
    def first_step(rule: Rule) -> Column:
        grid = F.array(*[F.lit(float(g)) for g in rule.grid])
        passed = F.size(F.filter(grid, lambda g: rule.score <= g))
        return F.struct(F.lit(rule.name).alias("rule"), passed.alias("step"))

    steps = (
        population.select(
            F.col(stratum).alias("stratum"),
            (F.col("__quality") == 1).alias("good"),
            F.explode(F.array(*[first_step(r) for r in rules])).alias("__r"),
        )
        .groupBy("stratum", F.col("__r.rule").alias("rule"), F.col("__r.step").alias("step"))
        .agg(
            F.sum(F.col("good").cast("long")).alias("good"),
            F.sum((~F.col("good")).cast("long")).alias("bad"),
        )
    )
    steps = written(steps, "quality-steps")
    strata = steps.select("stratum").distinct().count()
    grids = reduce(
        DataFrame.unionByName,
        [
            steps.sparkSession.range(1).select(
                F.lit(r.name).alias("rule"),
                F.posexplode(F.array(*[F.lit(float(g)) for g in r.grid])).alias("step", "cutoff"),
            )
            for r in rules
        ],
    )
    level = error / max(1, strata * len(rules))
    allowed = most_lost / len(rules)
    # Rejected at step s: all whose score passed at most s cutoffs.
    totals = steps.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"))
    full = (
        totals.join(F.broadcast(grids), "rule")
        .join(
            steps.select(
                F.col("stratum").alias("__s"),
                F.col("rule").alias("__r"),
                F.col("step").alias("__t"),
                "good",
                "bad",
            ),
            F.col("stratum").eqNullSafe(F.col("__s"))
            & (F.col("rule") == F.col("__r"))
            & (F.col("step") == F.col("__t")),
            "left",
        )
        .fillna(0, ["good", "bad"])
    )
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    tested = full.withColumns(
        {"lost": F.sum("good").over(so_far), "caught": F.sum("bad").over(so_far)}
    )
    # Where more than the allowed share is lost the bound fails without summing.
    safe = F.when(F.col("lost") > F.col("n_good") * allowed, F.lit(False)).otherwise(
        binomial_at_most(F.col("lost"), F.col("n_good"), allowed) <= level
    )
    judged = tested.withColumn("safe", safe)
    certified = judged.withColumn(
        "certified", F.min(F.col("safe").cast("int")).over(so_far) == 1
    ).where(F.col("certified") & (F.col("caught") > 0))
    best = certified.groupBy("stratum", "rule").agg(
        F.max(
            F.struct((F.col("caught") - F.col("lost")).alias("gain"), F.col("cutoff"))
        ).alias("best")
    )
    return best.where(F.col("best.gain") > 0).select(
        "stratum", "rule", F.col("best.cutoff").alias("cutoff")
    )


def with_verdict(
    scored: DataFrame, cutoffs: DataFrame, rules: list[Rule], stratum: str = "lang"
) -> DataFrame:
    """Add ``kept``: false for base failures and scores above a cutoff."""
    wide = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"__cut_{r.name}") for r in rules]
    )
    wide = written(wide, "quality-cutoffs")
    joined = scored.join(
        small_side(wide, wide.count()), F.col(stratum).eqNullSafe(F.col("__stratum")), "left"
    )
    over = reduce(
        lambda a, b: a | b,
        [F.coalesce(r.score > F.col(f"__cut_{r.name}"), F.lit(False)) for r in rules],
    )
    return joined.withColumn("kept", ~(F.col("base_failed") | over)).select(*scored.columns, "kept")


def judge(
    df: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", **bounds: float
) -> DataFrame:
    """``df`` without its text, with ``FEATURES``, ``n_lines`` and ``kept``.

    NULL and empty texts have no words and fail the base rules; a NULL stratum is
    a stratum of its own; columns with the names added are replaced. The features
    are written once, as calibration and verdict both read them.
    """
    rules = default_rules()
    scored = written(with_features(df).drop("text"), "quality-features")
    cutoffs = choose_cutoffs(scored, labels, rules, stratum, key, **bounds)
    return with_verdict(scored, cutoffs, rules, stratum)


def keep_good(
    df: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", **bounds: float
) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with all their columns.

    Texts stay where they lie while the rejected ones, known by id and a hash of
    the text, are few enough to be sent to them.
    """
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    judged = judge(df.select(key, stratum, "text", mark.alias("__m")), labels, stratum, key, **bounds)
    rejected = written(
        judged.where(~F.col("kept")).select(F.col(key).alias("__k"), "__m").distinct(), "rejected"
    )
    marked = df.withColumn("__mark", mark)
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m"))
    return marked.join(small_side(rejected, rejected.count()), same, "left_anti").select(*df.columns)
