"""Long word sequences that earlier documents hold already."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import BROADCAST_ROWS, small_side, written
from batchlens.llm.words import WordHashes, mixed, window_hashes, words_of

WINDOW = 13
SEED_WORDS = 5
# Seeds or edges a task looks at together before it sends them on.
ROWS_AT_ONCE = 1_000_000
# Windows of a run; cut at fixed places of the source, so that few differ.
MOST_WINDOWS = 256
# Rows of one seed that are known to be shared are spread over so many salts, half
# of them in use; more would only take more bytes.
SALTS = 1 << 16
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``written``, with the shuffles of that job removed at its end: nothing reads
    them again, and else they stay on disk until the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES, "false")
    conf.set(_DROP_SHUFFLES, "true")
    try:
        return written(df.select("*"), name)  # a new plan takes the setting
    finally:
        conf.set(_DROP_SHUFFLES, before)


def _seeds(hashes: np.ndarray) -> np.ndarray:
    """For each 13-word window the least hash of its 5-word sequences, so that
    equal windows have equal seeds and neighbours mostly share theirs."""
    least = window_hashes(hashes, SEED_WORDS)
    span = WINDOW - SEED_WORDS + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, list[str]]]:
    """Row, id, mark and words of the texts that can hold a window."""
    columns = [batch.column(c).to_pylist() for c in ("key", "mark", "text")]
    for row, (key, mark, text) in enumerate(zip(*columns, strict=True)):
        words = words_of(text)
        if key is not None and len(words) >= WINDOW:
            yield row, key, mark, words


def _seed_rows(docs: DataFrame) -> DataFrame:
    """``(seed, salt, known, key, mark)``: the distinct seeds of each document.

    Of documents that share a seed within a task only the first is sent to meet
    the other tasks' (salt 0); the others are known to share it, and are spread.
    So a seed in very many documents sends a row or two per task to one place.
    """

    def settled(seeds: list[np.ndarray], keys: list[int], marks: list[int]) -> pa.RecordBatch:
        flat = np.concatenate(seeds) if seeds else np.zeros(0, dtype=np.uint64)
        sizes = [len(s) for s in seeds]
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        owner = np.repeat(np.array(keys, dtype=np.int64), sizes)[order]
        mark = np.repeat(np.array(marks, dtype=np.int64), sizes)[order]
        again = np.concatenate([[False], flat[1:] == flat[:-1]]) if len(flat) else np.zeros(0, bool)
        shared = again.copy()
        shared[:-1] |= again[1:]
        salt = np.where(again, mixed(owner.view(np.uint64)).view(np.int64) % SALTS | 1, 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(flat.view(np.int64)), pa.array(salt), pa.array(shared), pa.array(owner), pa.array(mark)],
            ["seed", "salt", "known", "key", "mark"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seeds, keys, marks, held = WordHashes(), [], [], [], 0
        for batch in batches:
            for _, key, mark, words in _texts(batch):
                own = np.unique(_seeds(hashes.of(words)))
                seeds.append(own), keys.append(key), marks.append(mark)
                held += len(own)
                if held >= ROWS_AT_ONCE:
                    yield settled(seeds, keys, marks)
                    seeds, keys, marks, held = [], [], [], 0
        yield settled(seeds, keys, marks)

    return docs.mapInArrow(run, "seed bigint, salt bigint, known boolean, key bigint, mark bigint")


def runs_of(
    key: np.ndarray, mark: np.ndarray, at: np.ndarray, source: np.ndarray, source_mark: np.ndarray, source_at: np.ndarray
) -> list[np.ndarray]:
    """Windows held at an earlier place, put together where they follow it window
    by window: the six columns of each run's first window, and its words."""
    order = np.lexsort((at, source_at - at, source_mark, source, mark, key))
    columns = [c[order] for c in (key, mark, at, source, source_mark, source_at)]
    if not len(order):
        return [*columns, order]
    # Repeated rows give each window more than once.
    new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
    columns = [c[new] for c in columns]
    follows = np.logical_and.reduce([np.diff(c) == step for c, step in zip(columns, (0, 0, 1, 0, 0, 1), strict=True)])
    first = np.flatnonzero(np.append(True, ~follows | (columns[5][1:] % MOST_WINDOWS == 0)))
    windows = np.diff(np.append(first, len(columns[0])))
    return [*(c[first] for c in columns), windows + WINDOW - 1]


# Columns of the edges a task sends on; runs have neither nodes nor ``several``.
_EDGE = {
    "from_node": "bigint", "to_node": "bigint", "enter": "bigint", "leave": "bigint",
    "key": "bigint", "mark": "bigint", "pos": "int", "several": "boolean",
    "n_words": "int", "source": "bigint", "source_mark": "bigint", "source_pos": "int",
}


def _agreed(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each group the value all its rows have, else 0."""
    least, most = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
    return np.repeat(np.where(least == most, least, 0), sizes)


def _edge_rows(seeded: DataFrame) -> DataFrame:
    """``_EDGE``: windows with a shared seed, as edges between 12-word nodes.

    ``enter`` is the node before ``from_node`` and ``leave`` the one after
    ``to_node``, 0 at the ends of a text and where the task's holders of the edge
    disagree. Only windows of the earliest of these holders are sent as edges,
    ``several`` if there are others; those have a source at once and are sent as
    runs. So an edge in very many documents is a row or two per task.
    """

    def settled(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        left, right, enter, leave, key, mark, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((pos, mark, key, right, left))
        left, right, enter, leave, key, mark, pos = (c[order] for c in (left, right, enter, leave, key, mark, pos))
        if not len(left):
            return
        first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        sizes = np.diff(np.append(first, len(left)))
        at_first = [np.repeat(c[first], sizes) for c in (key, mark, pos)]
        several = np.repeat(np.maximum.reduceat(key, first) > key[first], sizes)
        enter, leave = _agreed(enter, first, sizes), _agreed(leave, first, sizes)
        later = key > at_first[0]
        edges = [c[~later] for c in (left, right, enter, leave, key, mark, pos, several)]
        yield _batch(dict(zip(list(_EDGE)[:8], edges, strict=True)), len(edges[0]))
        runs = runs_of(key[later], mark[later], pos[later], *(c[later] for c in at_first))
        names = ("key", "mark", "pos", "source", "source_mark", "source_pos", "n_words")
        yield _batch(dict(zip(names, runs, strict=True)), len(runs[0]))

    def _batch(columns: dict[str, np.ndarray], rows: int) -> pa.RecordBatch:
        kinds = {"bigint": np.int64, "int": np.int32, "boolean": np.bool_}
        arrays = [
            pa.array(columns[c].astype(kinds[t])) if c in columns else pa.nulls(rows, pa.from_numpy_dtype(kinds[t]))
            for c, t in _EDGE.items()
        ]
        return pa.RecordBatch.from_arrays(arrays, list(_EDGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, parts, held = WordHashes(), [], 0
        for batch in batches:
            shared = batch.column("seeds")
            for row, key, mark, words in _texts(batch):
                if not shared[row].is_valid:
                    continue
                seeds = np.sort(shared[row].values.to_numpy().view(np.uint64))
                coded = hashes.of(words)
                own = _seeds(coded)
                at = np.minimum(np.searchsorted(seeds, own), len(seeds) - 1)
                starts = np.flatnonzero(seeds[at] == own)
                nodes = np.concatenate([[0], window_hashes(coded, WINDOW - 1).view(np.int64), [0]])
                ends = [nodes[starts + i] for i in (1, 2, 0, 3)]
                parts.append((*ends, np.full(len(starts), key), np.full(len(starts), mark), starts))
                held += len(starts)
                if held >= ROWS_AT_ONCE:
                    yield from settled(parts)
                    parts, held = [], 0
        yield from settled(parts)

    return seeded.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in _EDGE.items()))


def _repeated_edges(rows: DataFrame) -> DataFrame:
    """Edges that two documents hold, and runs.

    The row at an edge's first place has its nodes, with ``enter`` and ``leave``
    NULL unless all holders agree; the rows of later documents have that place as
    ``source`` instead. Runs stay as they are.
    """
    # Runs have no nodes; their own hash deals them out.
    dealt = rows.withColumn("__deal", F.coalesce("from_node", F.xxhash64("key", "mark", "pos", "source_pos")))
    alike = Window.partitionBy("__deal", "to_node").orderBy("key", "mark", "pos")
    whole = alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    agreed = lambda c: F.when((F.min(c).over(whole) == F.max(c).over(whole)) & (F.col(c) != 0), F.col(c))
    met = dealt.select(
        "from_node", "to_node", agreed("enter").alias("enter"), agreed("leave").alias("leave"), "key", "mark", "pos", "n_words",
        *(
            F.when(F.col("n_words").isNotNull(), F.col(c)).otherwise(F.first(own).over(whole)).alias(c)
            for c, own in (("source", "key"), ("source_mark", "mark"), ("source_pos", "pos"))
        ),
        (F.max("several").over(whole) | (F.max("key").over(whole) > F.first("key").over(whole))).alias("__repeated"),
        (F.col("n_words").isNull() & (F.row_number().over(alike) == 1)).alias("__first"),
    )
    told = F.col("n_words").isNotNull() | (F.col("__first") & F.col("__repeated")) | (F.col("source") < F.col("key"))
    only = lambda here, *names: [F.when(here, F.col(c)).alias(c) for c in names]
    return met.where(told).select(
        *only(F.col("__first"), "from_node", "to_node", "enter", "leave"),
        "key", "mark", "pos", "n_words",
        *only(~F.col("__first"), "source", "source_mark", "source_pos"),
    )


def _paths(edges: DataFrame) -> DataFrame:
    """``(source, source_mark, source_pos, n_edges)``: the nonbranching paths of the
    graph of repeated edges, at the first place of their first edge.

    Two edges are joined at a node if whoever holds the first goes on with the
    second, and whoever holds the second comes from the first. So all edges of a
    path have the same holders, and its places are as consecutive in each as they
    are in the graph. Edges that miss a partner on one side end a path there.
    """
    place = F.struct("source", "source_mark", "source_pos")
    before = edges.where(F.col("leave").isNotNull()).select(
        F.col("from_node").alias("a"), F.col("to_node").alias("b"), F.col("leave").alias("c"), place.alias("before")
    )
    after = edges.where(F.col("enter").isNotNull()).select(
        F.col("enter").alias("a"), F.col("from_node").alias("b"), F.col("to_node").alias("c"), place.alias("after")
    )
    met = before.join(after, ["a", "b", "c"], "full").select("before", "after")
    alone = met.where(F.col("before").isNull() | F.col("after").isNull()).select(
        F.coalesce("after", "before").alias("at"), F.col("after").isNull().alias("last")
    )
    open_ends = edges.select(
        place.alias("at"),
        F.explode(
            F.filter(
                F.array(F.when(F.col("enter").isNull(), F.lit(False)), F.when(F.col("leave").isNull(), F.lit(True))),
                lambda last: last.isNotNull(),
            )
        ).alias("last"),
    )
    ends = alone.unionByName(open_ends).select("at.*", "last")
    following = F.lead("source_pos").over(Window.partitionBy("source", "source_mark").orderBy("source_pos", "last"))
    return (
        ends.withColumn("n_edges", following - F.col("source_pos") + 1)
        .where(~F.col("last"))
        .select("source", "source_mark", "source_pos", "n_edges")
    )


def _marked(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, mark, text)``: ``mark`` tells apart different texts under one key.

    It goes with every seed, edge and span, so it is 0, which takes hardly any
    bytes, unless the key has several texts; then it is a hash of the text.
    """
    docs = df.select(
        F.col(key).cast("bigint").alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text")
    )
    several = docs.groupBy(F.col("key").alias("__several")).agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
    several = _kept(several.where(F.col("least") < F.col("most")).select("__several"), "several-texts")
    if (n_several := several.count()) > BROADCAST_ROWS:
        return docs
    if not n_several:
        return docs.withColumn("mark", F.lit(0).cast("bigint"))
    met = docs.join(F.broadcast(several), F.col("key") == F.col("__several"), "left")
    return met.select("key", F.when(F.col("__several").isNull(), F.lit(0)).otherwise(F.col("mark")).alias("mark"), "text")


def _exact_copies(docs: DataFrame) -> DataFrame:
    """``(copy, copy_mark)``: documents whose whole text an earlier one has."""
    slim = docs.where(F.col("key").isNotNull() & F.col("text").isNotNull()).select(
        "key", "mark", F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"), F.length("text").alias("n")
    )
    least = slim.groupBy("a", "b", "n").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    several = least.where(F.col("least") < F.col("most")).drop("most")
    later = slim.join(several, ["a", "b", "n"]).where(F.col("key") > F.col("least"))
    return later.select(F.col("key").alias("copy"), F.col("mark").alias("copy_mark")).distinct()


def _spans(docs: DataFrame, copies: DataFrame, n_copies: int) -> DataFrame:
    """``(key, mark, pos, n_words, source, source_mark, source_pos)``: stretches of
    words that an earlier document holds too, as the hashes say. Together they
    cover each repeated window of the documents that are not ``copies``."""
    is_copy = (F.col("key") == F.col("copy")) & (F.col("mark") == F.col("copy_mark"))
    firsts = docs.join(small_side(copies, n_copies), is_copy, "left_anti").select("key", "mark", "text")
    alike = Window.partitionBy("seed", "salt")
    shared = (
        _seed_rows(firsts)
        .withColumn("holders", F.count(F.lit(1)).over(alike))
        .where(F.col("known") | (F.col("holders") > 1))
        .groupBy(F.col("key").alias("__key"), F.col("mark").alias("__mark"))
        .agg(F.collect_set("seed").alias("seeds"))
    )
    shared = _kept(shared, "seeds")
    seeded = docs.join(shared, _own()).select("key", "mark", "text", "seeds")
    met = _kept(_repeated_edges(_edge_rows(seeded)), "edges")
    places = ["source", "source_mark", "source_pos"]
    first = [F.col(own).alias(c) for c, own in zip(places, ("key", "mark", "pos"), strict=True)]
    edges = met.where("from_node IS NOT NULL").select("from_node", "to_node", "enter", "leave", *first)
    paths = _kept(_paths(edges), "paths")
    # Who holds the first edge of a path holds all of it.
    held = (
        met.where("from_node IS NULL AND n_words IS NULL")
        .drop("n_words")
        .join(small_side(paths, paths.count()), places)
        .withColumn("n_words", F.col("n_edges") + (WINDOW - 1))
    )
    columns = ["key", "mark", "pos", "n_words", *places]
    return _kept(held.select(columns).unionByName(met.where("n_words IS NOT NULL").select(columns)), "spans")


def _own() -> Column:
    """A text's own row of a table with one row per text."""
    return (F.col("key") == F.col("__key")) & (F.col("mark") == F.col("__mark"))


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _read_at_source(found: DataFrame) -> DataFrame:
    """``(source, source_mark, source_pos, n_words, digest)`` of the words at the
    places listed as ``wanted``, once for repeated rows that follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = []
            wanted = batch.column("wanted")
            for row, key, mark, words in _texts(batch):
                if wanted[row].is_valid and (key, mark) != last:
                    last = key, mark
                    for w in wanted[row].as_py():
                        start, n = w["source_pos"], w["n_words"]
                        rows.append((key, mark, start, n, _digest(words[start : start + n])))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["source", "source_mark", "source_pos", "n_words", "digest"],
            )

    return found.mapInArrow(run, "source bigint, source_mark bigint, source_pos int, n_words int, digest binary")


def repeated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text, copy, spans)`` per row of ``df``: ``spans`` lists stretches of
    words that a document with a smaller key holds too, as structs of ``pos``,
    ``n_words``, the coordinates ``source`` and ``source_pos`` of one such place
    and a ``digest`` of the words there; NULL where there are none. They cover
    every 13-word window that an earlier document holds. ``copy`` marks later
    copies of a whole text, of which that is true throughout; theirs are not listed.

    The windows are the edges of a De Bruijn graph of words, from their first
    twelve words to their last twelve. Edges that occur once need not be known: a
    window is only looked at if the least of its 5-word hashes, its seed, occurs
    in another document, and neighbouring windows mostly share a seed. The edges
    meet in one shuffle; joins at their nodes compact those that have no branch
    between them into paths; and a document gets the paths whose first edge it
    holds. Windows that an earlier document of the same task holds are runs along
    that document at once. Nodes are 64-bit hashes, an edge is two of them; the
    words of each span are compared with those at its source before they go
    (``_verified``).

    ``mark`` tells apart different texts under one key (``_marked``). A seed or
    edge in very many documents is settled inside each task first.
    """
    docs = _marked(df, key, text)
    copies = _kept(_exact_copies(docs), "copies")
    n_copies = copies.count()
    spans = _spans(docs, copies, n_copies)
    places = ["source", "source_mark", "source_pos", "n_words"]
    wanted = (
        spans.select(places)
        .distinct()
        .groupBy(F.col("source").alias("__key"), F.col("source_mark").alias("__mark"))
        .agg(F.collect_list(F.struct("source_pos", "n_words")).alias("wanted"))
    )
    # Left joins, alike but for their right sides: Spark shuffles the texts once.
    at_source = docs.join(wanted.hint("merge"), _own(), "left").select("key", "mark", "text", "wanted")
    per_text = (
        spans.join(_read_at_source(at_source).hint("merge"), places)
        .groupBy(F.col("key").alias("__key"), F.col("mark").alias("__mark"))
        .agg(F.collect_set(F.struct("pos", "n_words", "source", "source_pos", "digest")).alias("spans"))
    )
    found = docs.join(per_text.hint("merge"), _own(), "left").select("key", "mark", "text", "spans")
    is_copy = (F.col("key") == F.col("copy")) & (F.col("mark") == F.col("copy_mark"))
    flagged = found.join(small_side(copies, n_copies), is_copy, "left")
    return flagged.select(
        F.col("key").alias(key), F.col("text").alias(text), F.col("copy").isNotNull().alias("copy"), "spans"
    )


def _verified(words: list[str], listed: list[dict] | None) -> list[dict]:
    """The spans whose words are those at their source."""
    return [s for s in listed or () if _digest(words[s["pos"] : s["pos"] + s["n_words"]]) == s["digest"]]


def _kept_words(words: list[str], copy: bool, listed: list[dict] | None) -> list[str]:
    if copy:
        return [] if len(words) >= WINDOW else words
    if not listed:
        return words
    opened = np.zeros(len(words) + 1, dtype=np.int64)
    for span in _verified(words, listed):
        opened[span["pos"]] += 1
        opened[span["pos"] + span["n_words"]] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(opened[:-1]) == 0)]


def spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start, n_words, source, source_start)``: the verified spans of
    ``repeated``, in words; copies of whole texts left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t, listed in zip(*(batch.column(c).to_pylist() for c in (key, text, "spans")), strict=True):
                for s in _verified(words_of(t), listed):
                    rows.append((k, s["pos"], s["n_words"], s["source"], s["source_pos"]))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], [key, "start", "n_words", "source", "source_start"]
            )

    return repeated(df, key, text).where(F.col("spans").isNotNull()).mapInArrow(
        run, f"{key} bigint, start bigint, n_words bigint, source bigint, source_start bigint"
    )


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept)``: the words of each text that no span
    of ``repeated`` covers, joined by single spaces.

    Windows are judged on the input, so what one removal leaves does not bring
    about others. NULL and empty texts have no words, texts of fewer than 13
    words keep theirs; of rows with one key none counts as earlier than another,
    and rows with a NULL key neither lose words nor take them from others.
    """
    return _cleaned(df, key, text, False)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``without_repeats`` with ``kept_sha256`` in place of the words kept."""
    return _cleaned(df, key, text, True)


def _cleaned(df: DataFrame, key: str, text: str, digest: bool) -> DataFrame:
    last = "kept_sha256" if digest else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            columns = [batch.column(c).to_pylist() for c in (text, "copy", "spans")]
            for t, copy, listed in zip(*columns, strict=True):
                words = words_of(t)
                left = _kept_words(words, copy, listed)
                counts.append(len(words)), gone.append(len(words) - len(left))
                joined = " ".join(left)
                kept.append(hashlib.sha256(joined.encode()).hexdigest() if digest else joined)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                [key, "n_words", "n_removed", last],
            )

    return repeated(df, key, text).mapInArrow(
        run, f"{key} bigint, n_words bigint, n_removed bigint, {last} string"
    )
