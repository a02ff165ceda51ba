"""Similar texts by shared word shingles: a chosen-path join."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.components import components
from batchlens.llm.tables import small_side, written
from batchlens.llm.words import WordHashes, mixed, window_hashes, words_of

SHINGLE = 5
SIMILAR = (4, 5)  # at least four fifths
# Shared tokens that a set is expected to be split on at each level.
BRANCHES = 2.0
SKETCH = 64
# Of SKETCH values a pair of similarity 0.8 shares 51.2, with a deviation of 3.2:
# fewer than these are 5.4 deviations off.
SKETCH_SHARED = 34
_ODD = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)


@dataclass(frozen=True)
class Plan:
    """How far to split and how often to start anew."""

    recall: float = 0.9999
    depth: int = 3
    bucket: int = 2048
    cluster_texts: int = 400
    cluster_bytes: int = 8_000_000

    @property
    def runs(self) -> int:
        """Runs until a pair at the threshold is missed with at most 1 - recall,
        even where every split goes down to ``depth`` (most end after one). Fewest
        tokens are shared where one set holds the other: the chance to be chosen
        is that of the larger set."""
        shared = BRANCHES * SIMILAR[0] / SIMILAR[1]
        meets = 0.0
        survive = 1.0
        for _ in range(self.depth):
            # a branching process: some child of a shared path is shared and survives
            meets = 1 - math.exp(-shared * survive)
            survive = meets
        return math.ceil(math.log(1 - self.recall) / math.log(1 - meets))


def shingles(words: list[str], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of a shorter text its
    whole word sequence; none of a text without words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(SHINGLE, len(words))))


def _chosen(tokens: np.ndarray, path: int) -> np.ndarray:
    """Paths one token longer: each token is taken with the same chance in every
    set of this size, by a hash of path and token that all sets share."""
    values = mixed(tokens ^ mixed(np.array([path], dtype=np.uint64)))
    limit = np.uint64(min(2**64 - 1, int(2.0**64 * min(1.0, BRANCHES / max(1, len(tokens))))))
    taken = values[values <= limit]
    return mixed(taken + np.uint64(path))


def _sketch(tokens: np.ndarray) -> bytes:
    lowest = np.full(SKETCH, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(tokens), 4096):
        lowest = np.minimum(lowest, (tokens[at : at + 4096, None] * _ODD[None, :]).min(axis=0))
    return (mixed(lowest) >> np.uint64(56)).astype(np.uint8).tobytes()


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _mark(text: str) -> Column:
    """What tells texts apart that share an id; NULL for NULL alone."""
    return F.unhex(F.md5(F.col(text)))


def _described(df: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """``(key, mark, node, n_shingles, sketch, paths)``; ``mark`` names the text and
    ``node`` the shingle set, NULL for a text without words."""
    runs = [int(v) for v in mixed(np.arange(1, plan.runs + 1, dtype=np.uint64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                nodes, counts, sketches, paths = [], [], [], []
                for t in part.column("text").to_pylist():
                    tokens = shingles(words_of(t), hashes)
                    counts.append(len(tokens))
                    if not len(tokens):
                        nodes.append(None), sketches.append(None), paths.append([])
                        continue
                    nodes.append(xxhash.xxh128_digest(tokens.tobytes()))
                    sketches.append(_sketch(tokens))
                    paths.append(_signed(np.concatenate([_chosen(tokens, r) for r in runs])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("mark"),
                        pa.array(nodes, pa.binary()),
                        pa.array(counts, pa.int32()),
                        pa.array(sketches, pa.binary()),
                        pa.array(paths, pa.list_(pa.int64())),
                    ],
                    ["key", "mark", "node", "n_shingles", "sketch", "paths"],
                )

    kind = df.schema[key].dataType.simpleString()
    slim = df.select(F.col(key).alias("key"), _mark(text).alias("mark"), F.col(text).alias("text"))
    return slim.mapInArrow(
        run, f"key {kind}, mark binary, node binary, n_shingles int, sketch binary, paths array<bigint>"
    )


def _stars(sketches: np.ndarray) -> np.ndarray:
    """For each row the first row of its group of rows linked by their sketches."""
    root = np.full(len(sketches), -1, dtype=np.int64)
    open_ = np.arange(len(sketches))
    while len(open_):
        first, waiting = open_[0], [open_[0]]
        root[first] = first
        open_ = open_[1:]
        while waiting and len(open_):
            near = (sketches[open_] == sketches[waiting.pop()]).sum(axis=1) >= SKETCH_SHARED
            root[open_[near]] = first
            waiting.extend(open_[near])
            open_ = open_[~near]
    return root


_EDGES = "u binary, v binary"


def _edges_in_buckets(buckets: DataFrame) -> DataFrame:
    """Links within ``members`` (sorted structs of node and sketch): each node to
    the first of its group, so that their number is that of the members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            flat = lists.flatten()
            sizes = lists.value_lengths().to_numpy()
            nodes = flat.field("node").to_pylist()
            raw = b"".join(flat.field("sketch").to_pylist())
            sketches = np.frombuffer(raw, dtype=np.uint8).reshape(-1, SKETCH)
            starts = np.cumsum(sizes) - sizes
            left, right = [], []
            pairs = starts[sizes == 2]
            near = (sketches[pairs] == sketches[pairs + 1]).sum(axis=1) >= SKETCH_SHARED
            left.extend(pairs[near] + 1), right.extend(pairs[near])
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                root = _stars(sketches[start : start + size])
                own = np.flatnonzero(root != np.arange(size))
                left.extend(start + own), right.extend(start + root[own])
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in left], pa.binary()), pa.array([nodes[i] for i in right], pa.binary())],
                ["u", "v"],
            )

    return buckets.select("members").mapInArrow(run, _EDGES)


def _gathered(members: DataFrame, nodes: DataFrame, *by: str) -> DataFrame:
    """Buckets of bounded size with the sketches of their members."""
    slim = nodes.select("node", "sketch")
    return members.join(slim, "node").groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("node", "sketch"))).alias("members")
    )


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("__key"), _mark(text).alias("__mark"), F.col(text).alias("text"))


def _is_rep() -> Column:
    """A row of ``_texts`` is the one that stands for a set, or equal to it."""
    return F.col("__key").eqNullSafe(F.col("rep")) & (F.col("__mark") == F.col("mark"))


def _children(df: DataFrame, frontier: DataFrame, key: str, text: str) -> DataFrame:
    """``(path, node)`` one level deeper: the texts of ``frontier(node, rep, mark,
    path)`` are read again and split on tokens chosen for each of their paths."""
    per_text = frontier.groupBy("rep", "mark", "node").agg(F.collect_set("path").alias("paths"))
    per_text = written(per_text, "frontier")
    joined = (
        _texts(df, key, text)
        .join(small_side(per_text, per_text.count()), _is_rep())
        .select("node", "paths", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows: list[bytes] = []
            found = [np.zeros(0, dtype=np.uint64)]
            for node, paths, t in zip(*(batch.column(c).to_pylist() for c in ("node", "paths", "text")), strict=True):
                tokens = shingles(words_of(t), hashes)
                for path in paths:
                    longer = _chosen(tokens, path & (2**64 - 1))
                    rows.extend([node] * len(longer))
                    found.append(longer)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.concatenate(found)), pa.int64()), pa.array(rows, pa.binary())], ["path", "node"]
            )

    return joined.mapInArrow(run, "path bigint, node binary").distinct()


def _candidates(df: DataFrame, nodes: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """``(u, v)``: links between sets that met in a bucket and whose sketches agree."""
    rows = nodes.select("node", F.explode("paths").alias("path"))
    found = []
    for level in range(plan.depth):
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        met = written(rows.join(sizes, "path"), "buckets")
        small = met.where(F.col("size") <= plan.bucket)
        found.append(written(_edges_in_buckets(_gathered(small, nodes, "path")), "candidates"))
        large = met.where(F.col("size") > plan.bucket)
        if large.isEmpty():
            break
        if level + 1 < plan.depth:
            frontier = large.join(nodes.select("node", "rep", "mark"), "node").select("node", "rep", "mark", "path")
            rows = written(_children(df, frontier, key, text), "children")
            continue
        # Too alike to be split: compared in blocks, every block with every other.
        blocks = F.ceil(F.col("size") / (plan.bucket // 2)).cast("int")
        own = F.pmod(F.xxhash64("node", "path"), F.col("blocks")).cast("int")
        paired = (
            large.withColumn("blocks", blocks)
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("path", "node", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        )
        found.append(written(_edges_in_buckets(_gathered(paired, nodes, "path", "a", "b")), "candidates"))
    return reduce(DataFrame.unionByName, found).distinct()


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each pair of sets shares."""
    m = len(sets)
    shared = np.zeros((m, m), dtype=np.float32)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    used = times[column] > 1
    owner, column = owner[used], number[column[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 8192
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + width, width))
    for k in range(len(edges) - 1):
        part = slice(edges[k], edges[k + 1])
        held = np.zeros((m, width), dtype=np.float32)
        held[owner[part], column[part] - k * width] = 1
        shared += held @ held.T
    return shared


def _verified(clusters: DataFrame) -> DataFrame:
    """Exact similarities within ``members`` (node, copies, side, across, text).

    A row per member: the copies of all texts similar to it here, and the member
    it is linked to, directly or not. Between two blocks only pairs across their
    sides are counted: those within are counted elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[tuple[bytes, int, bytes]] = []
            for members in batch.column("members"):
                rows = members.as_py()
                if len(rows) < 2:
                    continue
                sets = [shingles(words_of(r["text"]), hashes) for r in rows]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                shared = _shared_counts(sets).astype(np.int64)
                union = sizes[:, None] + sizes[None, :] - shared
                alike = (SIMILAR[1] * shared >= SIMILAR[0] * union) & (shared > 0)
                np.fill_diagonal(alike, False)
                if rows[0]["across"]:
                    side = np.array([r["side"] for r in rows])
                    alike &= side[:, None] != side[None, :]
                links = alike.astype(np.int64) @ np.array([r["copies"] for r in rows], dtype=np.int64)
                root = np.full(len(rows), -1)
                for i in range(len(rows)):
                    if root[i] >= 0:
                        continue
                    root[i], waiting = i, [i]
                    while waiting:
                        near = np.flatnonzero(alike[waiting.pop()] & (root < 0))
                        root[near] = i
                        waiting.extend(near)
                for i in np.flatnonzero(links):
                    out.append((rows[i]["node"], int(links[i]), rows[root[i]]["node"]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.binary()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.binary()),
                ],
                ["node", "links", "linked"],
            )

    return clusters.select("members").mapInArrow(run, "node binary, links bigint, linked binary")


def similar_texts(
    df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()
) -> DataFrame:
    """One row per row of ``df``: ``(key, class_id, n_links)``.

    Two texts are linked when at least four fifths of their distinct five-word
    shingles are shared (words as they are; a text of one to four words is one
    shingle). ``class_id`` is the least key among all texts linked to this one,
    directly or through others; ``n_links`` counts the other rows it is linked
    to. Texts with equal shingle sets are taken together from the start and
    counted, never paired. NULL texts and texts without words are linked to
    nothing and keep their own key as class. Repeated rows are copies. Different
    texts may share a key or have none; a NULL key is the last of a class.

    Chosen-path join: in each of several runs every set is split on shared tokens
    that a hash chooses, about two of its own; sets that chose the same token
    meet in a bucket. Buckets of up to ``plan.bucket`` sets are compared by their
    sketches; larger ones are split again on further tokens, and what cannot be
    split is compared block by block. Met sets form clusters (large ones in
    blocks too), in which every pair is verified on the exact sets. So a pair at
    the threshold is missed with a chance of ``1 - plan.recall``, and links are
    always true.
    """
    return _classified(df, key, text, plan).select(
        F.col("key").alias(key),
        F.col("class_id"),
        F.col("n_links"),
    )


def _least(key: str, mark: str) -> Column:
    """The least row by key and text, NULL keys last."""
    return F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(mark).alias("mark")))


def _classified(df: DataFrame, key: str, text: str, plan: Plan) -> DataFrame:
    """``(key, mark, class_id, class_mark, n_links)`` per row: ``class_id`` and
    ``class_mark`` are key and mark of the least row of its class."""
    described = written(_described(df, plan, key, text), "shingles")
    held = described.where(F.col("node").isNotNull())
    copies = (
        held.groupBy("node")
        .agg(_least("key", "mark").alias("least"), F.count(F.lit(1)).alias("copies"))
        .select("node", "copies", F.col("least.key").alias("rep"), F.col("least.mark").alias("rep_mark"))
    )
    one = held.select(F.col("node").alias("__n"), "key", "mark", "n_shingles", "sketch", "paths")
    is_rep = F.col("rep").eqNullSafe(F.col("key")) & (F.col("rep_mark") == F.col("mark"))
    nodes = written(
        copies.join(one, (F.col("node") == F.col("__n")) & is_rep)
        .dropDuplicates(["node"])
        .select("node", "rep", "mark", "copies", "n_shingles", "sketch", "paths"),
        "sets",
    )
    clusters = components(_candidates(df, nodes, plan, key, text))
    clustered = written(clusters.join(nodes.select("node", "rep", "mark", "copies"), "node"), "clusters")
    texts = _texts(df, key, text).join(small_side(clustered, clustered.count()), _is_rep())
    texts = written(texts.select("root", "node", "copies", "text").dropDuplicates(["node"]), "cluster-texts")
    sizes = texts.groupBy(F.col("root").alias("__root")).agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / plan.cluster_texts),
            F.ceil(F.sum(F.octet_length("text")) / plan.cluster_bytes),
        )
        .cast("int")
        .alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = (
        texts.join(sizes, F.col("root") == F.col("__root"))
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("a", F.least("own", "other"))
        .withColumn("b", F.greatest("own", "other"))
        .withColumn("side", F.col("own") == F.col("b"))
        .withColumn("across", F.col("a") != F.col("b"))
        .groupBy("root", "a", "b")
        .agg(F.sort_array(F.collect_list(F.struct("node", "copies", "side", "across", "text"))).alias("members"))
    )
    verified = written(_verified(grouped), "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("node").alias("u"), F.col("linked").alias("v")))
    placed = roots.join(nodes.select("node", "rep", "mark"), "node")
    least = placed.groupBy(F.col("root").alias("__r")).agg(_least("rep", "mark").alias("__least"))
    linked = placed.join(least, F.col("root") == F.col("__r")).join(links, "node", "left")
    known = nodes.select("node", "rep", "mark", "copies").join(
        linked.select(F.col("node").alias("__l"), "__least", "links"), F.col("node") == F.col("__l"), "left"
    )
    alone = F.col("__least").isNull()
    known = known.select(
        F.col("node").alias("__node"),
        F.when(alone, F.col("rep")).otherwise(F.col("__least.key")).alias("__class"),
        F.when(alone, F.col("mark")).otherwise(F.col("__least.mark")).alias("__class_mark"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("__links"),
    )
    own = F.col("__node").isNull()
    return described.join(known, F.col("node") == F.col("__node"), "left").select(
        "key",
        "mark",
        F.when(own, F.col("key")).otherwise(F.col("__class")).alias("class_id"),
        F.when(own, F.col("mark")).otherwise(F.col("__class_mark")).alias("class_mark"),
        F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """One row of ``df`` per class: that of the least key, and of its texts under
    that key the one of the least hash. Rows without words are collapsed only
    where key and text are equal; NULL keys are equal, and last."""
    classes = written(_classified(df, key, text, plan), "classes")
    least = F.col("key").eqNullSafe(F.col("class_id")) & F.col("mark").eqNullSafe(F.col("class_mark"))
    gone = classes.where(~least).select(F.col("key").alias("__gone"), F.col("mark").alias("__gone_mark")).distinct()
    marked = df.withColumn("__mark", _mark(text))
    same = F.col(key).eqNullSafe(F.col("__gone")) & F.col("__mark").eqNullSafe(F.col("__gone_mark"))
    kept = marked.join(small_side(gone, gone.count()), same, "left_anti")
    rows, different = classes.where(least).agg(F.count(F.lit(1)), F.count_distinct(F.struct("key", "mark"))).first()
    return (kept.dropDuplicates([key, "__mark"]) if rows > different else kept).drop("__mark")
