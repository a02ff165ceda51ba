"""Near copies by their min-hash signatures: an inverted join of coordinates."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.components import components
from batchlens.llm.tables import small_side, written
from batchlens.llm.words import LOWER, UPPER, mixed, window_hashes

SHINGLE = 2
SIMILAR = (80, 100)  # shared * 100 >= union * 80
# Two different sets of fewer shingles can't be that similar.
LEAST = 4
# Min-hashes in a posted coordinate: unlike sets rarely agree in two.
WIDTH = 2
# Leaders that each set is held against first.
LEADERS = 2


@dataclass(frozen=True)
class Plan:
    """``missed``: the chance, for a pair at the threshold, to have too few equal
    coordinates, and again to meet in no list. Lists are compared within blocks of
    ``block`` sets; those whose comparisons exceed ``block`` squared are dealt anew
    by further coordinates first."""

    coordinates: int = 128
    missed: float = 1e-6
    block: int = 1024

    @cached_property
    def posted(self) -> int:
        """Coordinates of ``WIDTH`` min-hashes that each set is posted under: a pair
        agrees in one with the chance of its similarity to that power."""
        return math.ceil(math.log(self.missed) / math.log(1 - (SIMILAR[0] / SIMILAR[1]) ** WIDTH))

    @cached_property
    def matches(self) -> int:
        """Least number of equal coordinates: fewer have a chance of ``missed`` at most."""
        p, total = SIMILAR[0] / SIMILAR[1], 0.0
        for k in range(self.coordinates + 1):
            total += math.comb(self.coordinates, k) * p**k * (1 - p) ** (self.coordinates - k)
            if total > self.missed:
                return k
        raise ValueError("no coordinates")


_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


class _Hashes(dict):
    """64-bit hashes of words, of which at most ``most`` are kept."""

    most = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes | None, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct hashes of all pairs of neighbouring words, A-Z lower-cased;
    of a single word itself; none of a text without words. Bytes are split at the
    very characters that part words."""
    words = text.translate(_FOLD).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    return np.unique(window_hashes(own, min(SHINGLE, len(words))))


def _lowest(tokens: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Per coordinate the least value of a hash of its own."""
    lowest = np.full(len(odd), 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(tokens), 2048):
        np.minimum(lowest, (tokens[at : at + 2048, None] * odd[None, :]).min(axis=0), out=lowest)
    return lowest


def _mark(text: str) -> Column:
    """What tells texts apart that share an id; NULL for NULL alone."""
    return F.unhex(F.md5(F.col(text)))


def _described(df: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """``(key, mark, node, n, signature, posts)``: ``node`` names the set, NULL
    where it is empty; ``posts`` are its lists, the prefix and then those by which
    long lists are dealt anew, none for sets that only equal ones are similar to."""
    used = 2 * plan.posted * WIDTH
    odd = mixed(np.arange(1, max(plan.coordinates, used) + 1, dtype=np.uint64)) | np.uint64(1)
    places = mixed(np.arange(1, used + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                nodes, counts, signatures, posts = [], [], [], []
                for t in part.column("text").to_pylist():
                    tokens = shingles(t, hashes)
                    counts.append(len(tokens))
                    nodes.append(xxhash.xxh128_digest(tokens.tobytes()) if len(tokens) else None)
                    if len(tokens) < LEAST:
                        signatures.append(None), posts.append([])
                        continue
                    lowest = _lowest(tokens, odd)
                    signatures.append((mixed(lowest[: plan.coordinates]) >> np.uint64(56)).astype(np.uint8).tobytes())
                    own = mixed(lowest[:used] ^ places).reshape(-1, WIDTH)
                    posts.append(mixed(own.sum(axis=1, dtype=np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("mark"),
                        pa.array(nodes, pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array(signatures, pa.binary()),
                        pa.array(posts, pa.list_(pa.int64())),
                    ],
                    ["key", "mark", "node", "n", "signature", "posts"],
                )

    kind = df.schema[key].dataType.simpleString()
    slim = df.select(F.col(key).alias("key"), _mark(text).alias("mark"), F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, f"key {kind}, mark binary, node binary, n bigint, signature binary, posts array<bigint>")


def _near_sizes(a: str, b: str) -> Column:
    return (F.col(a) * SIMILAR[1] >= F.col(b) * SIMILAR[0]) & (F.col(b) * SIMILAR[1] >= F.col(a) * SIMILAR[0])


def _side(nodes: DataFrame, name: str, *columns: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def _matched(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs ``(u, v)`` of near sizes with enough equal coordinates, and how many:
    the coordinates outside the posted ones are not merged but looked up."""
    both = pairs.join(_side(nodes, "u", "n", "signature"), "u").join(_side(nodes, "v", "n", "signature"), "v")
    least = plan.matches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_signatures(batch.column(f"signature_{c}").to_pylist()) for c in "uv")
            equal = (left == right).sum(axis=1)
            kept = pa.array(np.flatnonzero(equal >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u").take(kept), batch.column("v").take(kept), pa.array(equal[equal >= least], pa.int64())],
                ["u", "v", "equal"],
            )

    return both.where(_near_sizes("n_u", "n_v")).select("u", "v", "signature_u", "signature_v").mapInArrow(
        run, "u binary, v binary, equal bigint"
    )


def _signatures(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1 if values else 1)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()


def _confirmed(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Those of ``(u, v)`` whose full sets are similar."""
    pairs = written(pairs, "pairs")
    sets = sets_of(_ends(pairs))
    both = pairs.select("u", "v").join(_side(sets, "u", "tokens"), "u").join(_side(sets, "v", "tokens"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(batch.column("tokens_u"), batch.column("tokens_v"), strict=True)):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if shared * SIMILAR[1] >= (len(a) + len(b) - shared) * SIMILAR[0]:
                    kept.append(i)
            yield batch.select(["u", "v"]).take(pa.array(kept, pa.int64()))

    return both.select("u", "v", "tokens_u", "tokens_v").mapInArrow(run, "u binary, v binary")


def _is_rep() -> Column:
    return F.col("__key").eqNullSafe(F.col("rep")) & (F.col("__mark") == F.col("mark"))


def _sets(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``(node, tokens)`` of ``wanted(node, rep, mark)``, from the texts once more."""
    texts = df.select(F.col(key).alias("__key"), _mark(text).alias("__mark"), F.col(text).cast("binary").alias("text"))
    wanted = written(wanted.select("node", "rep", "mark"), "wanted")
    found = texts.join(small_side(wanted, wanted.count()), _is_rep()).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                tokens = [shingles(t, hashes).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(tokens, pa.binary())], ["node", "tokens"])

    return written(found.mapInArrow(run, "node binary, tokens binary"), "sets").dropDuplicates(["node"])


def _lists(posts: DataFrame) -> DataFrame:
    """``(post, node, size)``: lists with two members at least."""
    sizes = posts.groupBy("post").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return written(posts.join(sizes, "post"), "lists")


def _led(lists: DataFrame) -> DataFrame:
    """``(u, v)``: each member of a list with the one that stands in most and
    longest lists, the likeliest to be the original of many near copies."""
    weight = lists.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = lists.select("post", "node").join(weight, "node")
    leads = weighed.groupBy("post").agg(F.max(F.struct("weight", "node")).alias("m")).select("post", F.col("m.node").alias("v"))
    pairs = lists.select("post", F.col("node").alias("u")).join(leads, "post")
    return pairs.where(F.col("u") != F.col("v")).select("u", "v").distinct()


def _placed(rows: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component so far of ``node``, itself where it has none."""
    known = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return rows.join(known, F.col(node) == F.col("__n"), "left").withColumn(name, F.coalesce("__r", node)).drop("__n", "__r")


def _open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """``(post, node, root, main, n_main, n_side)`` of lists that still hold several
    components; ``main`` tells members of the largest one."""
    own = _placed(lists.select("post", "node"), roots, "node", "root")
    parts = own.groupBy("post", "root").agg(F.count(F.lit(1)).alias("c"))
    main = parts.groupBy("post").agg(
        F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("size"), F.count(F.lit(1)).alias("parts")
    )
    main = main.where(F.col("parts") > 1).select(
        "post", F.col("m.root").alias("__main"), F.col("m.c").alias("n_main"), (F.col("size") - F.col("m.c")).alias("n_side")
    )
    return own.join(main, "post").withColumn("main", F.col("root") == F.col("__main")).drop("__main")


def _cells(open_: DataFrame, members: DataFrame, plan: Plan) -> DataFrame:
    """``(left, right)`` members of each block of comparisons.

    Blocks of a list's lesser components meet each other and those of its largest;
    the latter are of one component and need not meet among themselves. ``left`` is
    NULL where a block meets itself.
    """
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / plan.block), F.lit(1)).cast("int")
    part = lambda n: F.pmod(F.xxhash64("node", "post"), n).cast("int")
    side, main = blocks("n_side"), blocks("n_main")
    all_of = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda kind, a, b, left: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), left.alias("left"))
    own = F.col("own")
    with_main = F.transform(all_of(main), lambda b: cell("main", own, b, F.lit(True)))
    with_side = F.transform(all_of(side), lambda b: cell("side", F.least(own, b), F.greatest(own, b), own < b))
    met_by_main = F.transform(all_of(side), lambda a: cell("main", a, own, F.lit(False)))
    dealt = open_.withColumn("own", F.when(F.col("main"), part(main)).otherwise(part(side)))
    cells = F.when(F.col("main"), met_by_main).otherwise(F.concat(with_main, with_side))
    dealt = dealt.select("post", "node", "root", F.explode(cells).alias("c")).select("post", "c.*", "node", "root")
    row = F.struct("node", "root", *[c for c in members.columns if c != "node"])
    return dealt.join(members, "node").groupBy("post", "kind", "a", "b").agg(
        F.collect_list(F.when(F.col("left"), row)).alias("left"), F.collect_list(F.when(~F.col("left"), row)).alias("right")
    )


def _near(n: np.ndarray, size: int) -> np.ndarray:
    return (n * SIMILAR[1] >= size * SIMILAR[0]) & (size * SIMILAR[1] >= n * SIMILAR[0])


def _similar(a: bytes, b: bytes) -> bool:
    left, right = (np.frombuffer(x, dtype=np.uint64) for x in (a, b))
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared * SIMILAR[1] >= (len(left) + len(right) - shared) * SIMILAR[0]


def _across(open_: DataFrame, members: DataFrame, plan: Plan) -> DataFrame:
    """``(u, v)``: components (by their roots) that matching members of a list join;
    a list gives fewer pairs than it has components, however many members match.
    Where ``members`` have ``tokens``, matches count that the full sets confirm."""
    exact = "tokens" in members.columns
    least = plan.matches

    def joined(left: pa.StructArray, right: pa.StructArray) -> Iterator[tuple[bytes, bytes]]:
        rows = right if not len(left) else pa.concat_arrays([left, right])
        name, root = np.unique(np.array(rows.field("root").to_pylist(), dtype=object), return_inverse=True)
        n, signature = rows.field("n").to_numpy(), _signatures(rows.field("signature").to_pylist())
        tokens = rows.field("tokens") if exact else None
        for i in range(len(left) or len(rows)):
            first = len(left) or i + 1
            others = first + np.flatnonzero((root[first:] != root[i]) & _near(n[first:], n[i]))
            same = (signature[others] == signature[i]).sum(axis=1)
            order = np.argsort(-same, kind="stable")
            for j in others[order][same[order] >= least]:
                if root[i] != root[j] and (not exact or _similar(tokens[i].as_py(), tokens[j].as_py())):
                    yield name[root[i]], name[root[j]]
                    root[root == root[j]] = root[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                if len(right):
                    found.extend(joined(left.values, right.values))
            columns = [pa.array([f[i] for f in found], pa.binary()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    return _cells(open_, members, plan).select("left", "right").mapInArrow(run, "u binary, v binary").distinct()


def _links(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], plan: Plan) -> DataFrame:
    """``(node, root)`` of all sets linked to another one."""
    posted = nodes.where(F.size("posts") > 0)
    lists = _lists(posted.select(F.explode(F.slice("posts", 1, plan.posted)).alias("post"), "node"))
    most = F.slice(F.sort_array(F.collect_list(F.struct("equal", "v")), asc=False), 1, LEADERS)
    best = _matched(_led(lists), nodes, plan).groupBy("u").agg(most.alias("m")).select("u", F.explode("m.v").alias("v"))
    edges = written(_confirmed(best, sets_of), "links")
    roots = written(components(edges), "roots")
    slim = nodes.select("node", "n", "signature")
    open_ = written(_open_lists(lists, roots), "open")
    long = F.col("n_side").cast("double") * (F.col("n_side") + F.col("n_main")) > plan.block**2
    matched = written(_across(open_.where(~long), slim, plan), "matched")
    if not open_.where(long).isEmpty():
        again = open_.where(long).select("post", "node").join(posted.select("node", "posts"), "node")
        again = again.select("post", "node", F.explode(F.slice("posts", plan.posted + 1, plan.posted)).alias("p"))
        deeper = _lists(again.select(F.xxhash64("post", "p").alias("post"), "node"))
        deeper = written(_open_lists(deeper, roots), "open")
        matched = matched.unionByName(written(_across(deeper, slim, plan), "matched")).distinct()
    if matched.isEmpty():
        return roots
    # Components that matches connect, compared on their members' full sets.
    clusters = components(matched).select(F.col("node").alias("root"), F.col("root").alias("post"))
    inside = _placed(posted.select("node"), roots, "node", "root").join(clusters, "root").select("post", "node")
    inside = written(_open_lists(inside, roots), "clusters")
    more = _across(inside, slim.join(sets_of(inside.select("node").distinct()), "node"), plan)
    # Links between components stand for links between their roots' members.
    return written(components(edges.unionByName(written(more, "links"))), "roots")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``df``: ``(key, n_shingles, component_id, kept)``.

    Texts are linked when 100 times the shingles they share are 80 times their
    union at least (two words, A-Z lower-cased; a single word is one shingle).
    ``component_id`` is the least key that links lead to. Equal sets are one node
    from the start. NULL texts and texts without words have no shingles and keep
    their own key. Repeated rows, and different texts under one key, are rows of
    their own; a NULL key is the last of a component. ``kept`` marks the rows whose
    key is that of their component.

    Every set is posted under the values of its first coordinates.
    Members of a list are first held against its leader, the set in most lists,
    so that copies of one original fall into one component without being paired. Where a list still holds several components,
    members of different ones are counted against each other in blocks; too long
    lists are dealt anew by further coordinates before. Components joined
    by a pair with ``plan.matches`` equal coordinates form clusters, in which such
    pairs are confirmed on the full sets. So links are always true, one at the
    threshold is missed with a chance of three times ``plan.missed`` at most, and
    rows never outnumber members, however many pairs match.
    """
    described = written(_described(df, plan, key, text), "signatures")
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("l")
    held = described.where(F.col("node").isNotNull()).groupBy("node").agg(
        least, F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("posts").alias("posts")
    )
    nodes = written(held.select("node", F.col("l.key").alias("rep"), F.col("l.mark").alias("mark"), "n", "signature", "posts"), "nodes")
    sets_of = lambda wanted: _sets(df, nodes.join(wanted, "node"), key, text)
    roots = _links(nodes, sets_of, plan)
    placed = roots.join(nodes.select("node", "rep"), "node")
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep")).alias("m"))
    linked = placed.join(first, "root").select(F.col("node").alias("__l"), F.col("m.rep").alias("__first"))
    known = nodes.join(linked, F.col("node") == F.col("__l"), "left").select(
        F.col("node").alias("__node"), F.when(F.col("__l").isNull(), F.col("rep")).otherwise(F.col("__first")).alias("__id")
    )
    own = F.col("__node").isNull()
    found = described.select("key", "node", "n").join(known, F.col("node") == F.col("__node"), "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(own, F.col("key")).otherwise(F.col("__id")).alias("component_id")
    )
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
