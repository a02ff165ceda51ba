"""Templates, totals and alignment as SQL functions, for flows written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from batchlens.functions import media, prompts
from batchlens.operators.totals import CHARS_PER_TOKEN


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _joined(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _distance(end: str, at: str) -> str:
    """As ``media.distance``: the double, then what rounding lost of it."""
    lost = f"(({end} - (({end} - {at}) - (({end} - {at}) - {end}))) - ({at} + (({end} - {at}) - {end})))"
    return f"abs({end} - {at}) AS far, CASE WHEN {end} < {at} THEN -{lost} ELSE {lost} END AS lost"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` evaluated once and bound to ``name``.

    Spark may put an argument's expression wherever the argument is named, inside
    lambdas too; an array or fold named there would be computed for each element.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_NEXT = "coalesce(get(cuts, size(cuts) - 1) + 1, 0)"
# Differences between times up to here cannot overflow, whatever a chunk's end.
_FAR = "1e290D"


def _first_at_or_after(at: str, low: str, high: str) -> str:
    """As in ``media``: the first index of ``both.ends`` not before ``at``, by halving."""
    middle = "shiftright(s.lo + s.hi, 1)"
    return f"""aggregate(sequence(1, length(bin(size(both.ends)))), struct({low} AS lo, {high} AS hi), (s, _) ->
        CASE WHEN s.lo >= s.hi THEN s
             WHEN get(both.ends, {middle}) < {at} THEN struct({middle} + 1 AS lo, s.hi AS hi)
             ELSE struct(s.lo AS lo, {middle} AS hi) END, s -> s.lo)"""


def _nearest(low: str) -> str:
    """As in ``media``: the first index from ``low`` on that is nearest, where ends ascend."""
    far = lambda index: f"struct({_distance(f'get(both.ends, {index})', 'at')})"
    pick = f"""CASE WHEN r = {low} THEN r
        WHEN r < size(both.ends) AND {far('r')} < {far('r - 1')} THEN r
        WHEN r - 1 = {low} OR get(both.ends, r - 2) <> get(both.ends, r - 1) THEN r - 1
        ELSE {_first_at_or_after('get(both.ends, r - 1)', low, 'r')} END"""
    return _let("r", _first_at_or_after("at", low, "size(both.ends)"), pick)


# Cuts go to short lists and these to a list, since each step copies what it adds to.
_CUTS_ASCENDING = f"""aggregate(both.ats,
    struct(CAST(array() AS ARRAY<ARRAY<INT>>) AS lists, CAST(array() AS ARRAY<INT>) AS cuts, 0 AS low),
    (found, at) -> CASE WHEN found.low >= size(both.ends) THEN found ELSE {_let("cut", _nearest("found.low"), f"""
        CASE WHEN size(found.cuts) < {media.CUTS_PER_LIST}
             THEN struct(found.lists AS lists, concat(found.cuts, array(cut)) AS cuts, cut + 1 AS low)
             ELSE struct(concat(found.lists, array(found.cuts)) AS lists, array(cut) AS cuts, cut + 1 AS low) END""")} END,
    found -> flatten(concat(found.lists, array(found.cuts))))"""
_CUTS_ANY_ORDER = f"""aggregate(both.ats, CAST(array() AS ARRAY<INT>), (cuts, at) ->
    CASE WHEN {_NEXT} >= size(both.ends) THEN cuts
         ELSE concat(cuts, array(array_min(transform(
             sequence({_NEXT}, size(both.ends) - 1),
             i -> struct({_distance("get(both.ends, i)", "at")}, i AS i))).i)) END)"""
_ASCEND = f"""both.ends = array_sort(both.ends) AND NOT exists(both.ends, e -> e IS NULL)
    AND NOT exists(both.ats, at -> at IS NOT NULL AND abs(at) >= {_FAR})"""
_FIRST = "coalesce(get(own.cuts, n - 1) + 1, 0)"

# Signature, type and body of each function.
FUNCTIONS = {
    "llama_prompt(system STRING, user STRING)": (
        "STRING",
        _joined(_literal(prompts.LLAMA_OPEN), "system", _literal(prompts.LLAMA_MIDDLE), "user", _literal(prompts.LLAMA_CLOSE)),
    ),
    "mistral_prompt(user STRING)": (
        "STRING",
        _joined(_literal(prompts.INSTRUCTION_OPEN), "user", _literal(prompts.INSTRUCTION_CLOSE)),
    ),
    "chatml_prompt(system STRING, user STRING)": (
        "STRING",
        _joined(_literal(prompts.CHATML_SYSTEM), "system", _literal(prompts.CHATML_USER), "user", _literal(prompts.CHATML_ASSISTANT)),
    ),
    "n_tokens(chars BIGINT)": ("DOUBLE", f"chars / {CHARS_PER_TOKEN}"),
    "join_candidates(candidates ARRAY<STRING>)": (
        "STRING",
        "CASE WHEN candidates IS NOT NULL THEN concat_ws(' ', candidates) END",
    ),
    f"chunk_ends(chunks {media.CHUNKS})": (
        "ARRAY<DOUBLE>",
        f"transform(chunks, c -> coalesce(try_element_at(c.timestamp, -1), {media.OPEN_END!r}D))",
    ),
    f"turn_ends(turns {media.TURNS})": ("ARRAY<DOUBLE>", "transform(turns, t -> t.segment.`end`)"),
    # The last chunk of each turn, until the chunks are used up.
    "turn_cuts(chunk_ends ARRAY<DOUBLE>, turn_ends ARRAY<DOUBLE>)": (
        "ARRAY<INT>",
        _let("both", "struct(chunk_ends AS ends, turn_ends AS ats)", f"CASE WHEN {_ASCEND} THEN {_CUTS_ASCENDING} ELSE {_CUTS_ANY_ORDER} END"),
    ),
    f"turns_by_cuts(chunks {media.CHUNKS}, turns {media.TURNS}, cuts ARRAY<INT>)": (
        media.ATTRIBUTED,
        _let("own", "struct(chunks, turns, cuts)", f"""transform(own.cuts, (cut, n) -> struct(
            get(own.turns, n).speaker AS speaker,
            array_join(transform(slice(own.chunks, {_FIRST} + 1, cut - {_FIRST} + 1), c -> c.text), '') AS text,
            array(get(get(own.chunks, {_FIRST}).timestamp, 0), get(get(own.chunks, cut).timestamp, 1)) AS timestamp))"""),
    ),
    f"align_by_turn(chunks {media.CHUNKS}, turns {media.TURNS})": (
        media.ATTRIBUTED,
        "turns_by_cuts(chunks, turns, turn_cuts(chunk_ends(chunks), turn_ends(turns)))",
    ),
}


def register(spark: SparkSession) -> None:
    """Create the functions of ``FUNCTIONS`` for this session.

    They give what their namesakes in ``functions.prompts`` and ``functions.media``
    give. ``align_by_turn`` searches where chunk ends ascend and else looks at
    every chunk left for each turn; for long files use the rows of
    ``operators.align``. NULL arguments give NULL.
    """
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
