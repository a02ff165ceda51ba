"""Damaged conversations set right by the cheapest edits: branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlens.llm.tables import written
from batchlens.operators.positions import number_rows

# What has been said so far: nothing, a system turn, a user turn, an answer.
START, SYSTEM, USER, ANSWER = range(4)
# Where a role's initial may stand, and what it leads to.
STEPS = {"u": {START: USER, SYSTEM: USER, ANSWER: USER}, "a": {USER: ANSWER}, "s": {START: SYSTEM}}
# The one role that may be inserted or given next.
NEXT = {START: USER, SYSTEM: USER, USER: ANSWER, ANSWER: USER}
ROLE = {USER: "user", ANSWER: "assistant"}
# Insertions that end a conversation which stops there.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ANSWER: 0}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}

Code = tuple[str, bool, bool]  # initial of the role, has to go, ends too early
Solved = dict[tuple[int, int], tuple[int, str]]  # (entry, exit): (cost, audit)


@dataclass(frozen=True)
class Sizes:
    """Conversations of more rows or bytes are solved in parts of ``rows``;
    ``block`` rows are searched at once."""

    rows: int = 5000
    bytes: int = 16_000_000
    block: int = 64


def least_edits(rows: list[Code], entry: int, leave: int) -> tuple[int, str] | None:
    """The cheapest edits of ``rows`` that lead from state ``entry`` to ``leave``
    and end with a row's own edit; of equal cost the ASCII-least letters.

    Depth first with an explicit stack. A node (rows done, state) is given up where
    its cost and the least that the rows left can cost exceed the incumbent, or
    equal it with greater letters, and where the dominance table of that node holds
    a prefix no worse. Two prefixes of one cost at one node never begin one
    another, since a further insertion costs, so the lesser stays lesser whatever
    follows.
    """
    lower = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        initial, gone, early = rows[i]
        kept = (0 if initial in STEPS else REROLE) + TRUNCATED * early
        lower[i] = lower[i + 1] + (DELETE if gone else min(DELETE, kept))
    table: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None:
            bound = cost + lower[i]
            if bound > best[0] or (bound == best[0] and audit > best[1][: len(audit)]):
                continue
        met = table.get((i, state))
        if met is not None and met <= (cost, audit):
            continue
        table[i, state] = (cost, audit)
        if i == len(rows):
            if state == leave and (best is None or (cost, audit) < best):
                best = (cost, audit)
            continue
        initial, gone, early = rows[i]
        moves = [(cost + INSERT, "I", i, NEXT[state]), (cost + DELETE, "D", i + 1, state)]
        if not gone:
            moves.append((cost + REROLE + TRUNCATED * early, "R", i + 1, NEXT[state]))
            if state in STEPS.get(initial, ()):
                moves.append((cost + TRUNCATED * early, "K", i + 1, STEPS[initial][state]))
        # The most promising is pushed last and met first.
        moves.sort(key=lambda m: (m[0] + lower[m[2]], m[1]), reverse=True)
        stack.extend((j, after, c, audit + letter) for c, letter, j, after in moves)
    return best


def solve_block(rows: list[Code]) -> Solved:
    pairs = {(e, x): least_edits(rows, e, x) for e in range(4) for x in range(4)}
    return {k: v for k, v in pairs.items() if v is not None}


def joined(first: Solved, then: Solved) -> Solved:
    out: Solved = {}
    for (e, m), (cost, audit) in first.items():
        for (m2, x), (cost2, audit2) in then.items():
            if m == m2:
                found = (cost + cost2, audit + audit2)
                if (e, x) not in out or found < out[e, x]:
                    out[e, x] = found
    return out


def solve(rows: list[Code], block: int) -> Solved:
    """Blocks are searched apart and put together; no rows need no edits."""
    nothing = {(s, s): (0, "") for s in range(4)}
    return reduce(joined, (solve_block(rows[at : at + block]) for at in range(0, len(rows), block)), nothing)


def closed(solved: Solved) -> tuple[int, str]:
    """The best of a whole conversation, insertions at its end included."""
    ends = ((x, c, a) for (e, x), (c, a) in solved.items() if e == START)
    return min((c + INSERT * CLOSING[x], a + "I" * CLOSING[x]) for x, c, a in ends)


def applied(rows: list[Code], audit: str, state: int) -> Iterator[tuple[list[str], bool, str | None]]:
    """Per row the roles inserted before it, whether it stays, and the role it is
    given if any; last, beyond the rows, the roles inserted at the end."""
    at, inserted = 0, []
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            inserted.append(ROLE[state])
            continue
        given = None
        if letter == "K":
            state = STEPS[rows[at][0]][state]
        elif letter == "R":
            state = NEXT[state]
            given = ROLE[state]
        yield inserted, letter != "D", given
        at, inserted = at + 1, []
    yield inserted, False, None


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Harm rows by the crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties
    its text, 2 takes its ``.!?``, 3 repeats it, 4 gives it to the user. NULLs are
    one space. Dropped rows stay, with ``dropped`` set, so that no conversation is
    lost; other columns go."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = F.crc32(named) % 20
    said = F.coalesce(F.col(text), F.lit(" "))
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said)
    by = F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" ")))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"),
                     (kind == 0).alias("dropped"), F.explode(times).alias("time"))
    return rows.drop("time")


NOT_BLANK = r"[^\x20\x09-\x0D]"


def _blank(text: Column) -> Column:
    return ~text.rlike(NOT_BLANK)


def _early(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_LINES = "array<struct<role:string,text:string>>"


def _initial(role: str) -> str:
    return role[:1]


def _codes(roles: list[str], blank: list[bool], twice: list[bool], early: list[bool]) -> list[Code]:
    rows = zip(roles, blank, twice, early, strict=True)
    return [(_initial(r), b or d, not b and not d and e) for r, b, d, e in rows]


def _whole(grouped: DataFrame, sizes: Sizes) -> DataFrame:
    """Conversations of bounded size: ``rows`` sorted, solved where they are."""

    def one(rows: list[dict]) -> dict:
        said = [(r["role"], r["text"]) for r in rows]
        first: dict[tuple[str, str], int] = {}
        for i, s in enumerate(said):
            first.setdefault(s, i)
        blank = [r["blank"] for r in rows]
        twice = [not b and first[s] < i for i, (s, b) in enumerate(zip(said, blank, strict=True))]
        codes = _codes([r for r, _ in said], blank, twice, [r["early"] for r in rows])
        cost, audit = closed(solve(codes, sizes.block))
        lines = []
        for (inserted, stays, given), (role, text) in zip(applied(codes, audit, START), [*said, ("", "")], strict=True):
            lines.extend({"role": r, "text": ""} for r in inserted)
            if stays:
                lines.append({"role": given or role, "text": text})
        turns = {r["turn"] for r in rows} - {None}
        pairs = zip(codes, codes[1:], strict=False)
        return {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "blank": sum(blank),
            "duplicate": sum(twice),
            "truncated": sum(c[2] for c in codes),
            "illegal": sum(a[0] + b[0] not in LEGAL for a, b in pairs),
            "cost": cost,
            "audit": audit,
            "lines": lines,
        }

    schema = f"conv {grouped.schema['conv'].dataType.simpleString()}, {_REPORT}, lines {_LINES}"
    names = T.StructType.fromDDL(schema).names
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(rows.as_py()) for rows in batch.column("rows")]
            columns = [pa.array([f[n] for f in found], k) for n, k in zip(names[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *columns], names)

    return grouped.mapInArrow(run, schema)


_SOLVED = "array<struct<entry:int,leave:int,cost:bigint,audit:string,rank:int>>"


def _solved_parts(parts: DataFrame, sizes: Sizes) -> DataFrame:
    """``(conv, part, solved, codes, first, last, illegal)``; ``codes`` sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables, firsts, lasts, illegal = [], [], [], []
            for codes in batch.column("codes").to_pylist():
                rows = [(c["initial"], c["gone"], c["early"]) for c in codes]
                solved = solve(rows, sizes.block)
                # Audits of a part end with a row's edit and so never begin one
                # another: their ranks order whole conversations too.
                ranks = {a: i for i, a in enumerate(sorted({a for _, a in solved.values()}))}
                tables.append([{"entry": e, "leave": x, "cost": c, "audit": a, "rank": ranks[a]} for (e, x), (c, a) in solved.items()])
                firsts.append(rows[0][0])
                lasts.append(rows[-1][0])
                illegal.append(sum(a[0] + b[0] not in LEGAL for a, b in zip(rows, rows[1:], strict=False)))
            kind = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("rank", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("part"), pa.array(tables, pa.list_(kind)), pa.array(firsts), pa.array(lasts), pa.array(illegal, pa.int64())],
                ["conv", "part", "solved", "first", "last", "illegal"],
            )

    kind = parts.schema["conv"].dataType.simpleString()
    return parts.mapInArrow(run, f"conv {kind}, part bigint, solved {_SOLVED}, first string, last string, illegal bigint")


def _chosen(parts: DataFrame) -> DataFrame:
    """``(conv, cost, illegal, closing, path array<(part, entry, leave)>)`` from a few
    numbers per part of each long conversation."""
    kept = F.transform("solved", lambda s: F.struct(s["entry"].alias("entry"), s["leave"].alias("leave"), s["cost"].alias("cost"), s["rank"].alias("rank")))
    grouped = parts.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("part", kept.alias("solved"), "first", "last", "illegal"))).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                # State: cost, ranks of the parts so far as one order number, way back.
                ways: dict[int, tuple[int, int]] = {START: (0, 0)}
                back: list[dict[int, int]] = []
                for p in parts:
                    found: dict[int, tuple[int, int, int, int]] = {}
                    for s in p["solved"]:
                        if s["entry"] in ways:
                            cost, order = ways[s["entry"]]
                            way = (cost + s["cost"], order, s["rank"], s["entry"])
                            if s["leave"] not in found or way < found[s["leave"]]:
                                found[s["leave"]] = way
                    orders = {o: i for i, o in enumerate(sorted({w[1:3] for w in found.values()}))}
                    ways = {x: (w[0], orders[w[1:3]]) for x, w in found.items()}
                    back.append({x: w[3] for x, w in found.items()})
                cost, _, state = min((c + INSERT * CLOSING[x], o, x) for x, (c, o) in ways.items())
                closing, path = state, []
                for p, came in zip(reversed(parts), reversed(back), strict=True):
                    path.append({"part": p["part"], "entry": came[state], "leave": state})
                    state = came[state]
                seams = zip(parts, parts[1:], strict=False)
                illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in seams)
                out.append((cost, illegal, closing, path[::-1]))
            kind = pa.struct([("part", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *[pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.list_(kind)))]],
                ["conv", "cost", "illegal", "closing", "path"],
            )

    kind = parts.schema["conv"].dataType.simpleString()
    return grouped.mapInArrow(run, f"conv {kind}, cost bigint, illegal bigint, closing int, path array<struct<part:bigint,entry:int,leave:int>>")


def _edited(rows: DataFrame) -> DataFrame:
    """``(conv, at, inserted, stays, given)`` of parts with ``codes``, ``audit`` and
    ``entry``; rows inserted at the end of a conversation follow its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, rows in zip(batch.column("conv"), batch.select(["part", "codes", "audit", "entry"]).to_pylist(), strict=True):
                codes = [(c["initial"], c["gone"], c["early"]) for c in rows["codes"]]
                edits = list(applied(codes, rows["audit"], rows["entry"]))
                at = [c["at"] for c in rows["codes"]] + [rows["codes"][-1]["at"] + 1]
                edits, at = (edits, at) if edits[-1][0] else (edits[:-1], at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv.as_py()] * len(at), conv.type),
                        pa.array(at, pa.int64()),
                        *[pa.array([e[i] for e in edits], k) for i, k in enumerate((pa.list_(pa.string()), pa.bool_(), pa.string()))],
                    ],
                    ["conv", "at", "inserted", "stays", "given"],
                )

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv {kind}, at bigint, inserted array<string>, stays boolean, given string")


def _joined(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on columns of one name, NULL with NULL."""
    own = right.select(*[F.col(n).alias(f"__{n}") if n in names else F.col(n) for n in right.columns])
    on = reduce(lambda a, b: a & b, (left[n].eqNullSafe(own[f"__{n}"]) for n in names))
    return left.join(own, on, how).drop(*[f"__{n}" for n in names])


def _in_parts(rows: DataFrame, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """Report and lines of conversations too large for one task's memory."""
    numbered = number_rows(rows, ["conv", "turn", "role", "head", "mark"], "number")
    first = numbered.groupBy("conv").agg(F.min("number").alias("zero"))
    placed = _joined(numbered, first, "conv").withColumn("at", F.col("number") - F.col("zero"))
    said = placed.groupBy("conv", "role", "mark").agg(F.min("at").alias("once"))
    placed = _joined(placed, said, "conv", "role", "mark")
    twice = ~F.col("blank") & (F.col("at") > F.col("once"))
    placed = written(
        placed.select("conv", "turn", "role", "text", "at", "blank", twice.alias("twice"),
                      (F.col("early") & ~F.col("blank") & ~twice).alias("early")),
        "long-conversations",
    )
    code = F.struct("at", F.substring("role", 1, 1).alias("initial"), (F.col("blank") | F.col("twice")).alias("gone"), "early")
    part = F.floor(F.col("at") / sizes.rows).cast("long").alias("part")
    coded = written(placed.groupBy("conv", part).agg(F.sort_array(F.collect_list(code)).alias("codes")), "codes")
    solved = written(_solved_parts(coded, sizes), "solved")
    chosen = written(_chosen(solved), "chosen")
    steps = chosen.select("conv", "closing", F.size("path").alias("n"), F.explode("path").alias("p")).select(
        "conv", "closing", (F.col("p.part") == F.col("n") - 1).alias("ends"), F.col("p.part").alias("part"), "p.entry", "p.leave"
    )
    closing = F.create_map(*[F.lit(v) for s, n in CLOSING.items() for v in (s, "I" * n)])
    picked = F.filter("solved", lambda s: (s["entry"] == F.col("entry")) & (s["leave"] == F.col("leave")))[0]["audit"]
    audits = written(
        _joined(solved.select("conv", "part", "solved"), steps, "conv", "part").select(
            "conv", "part", "entry", F.concat(picked, F.when(F.col("ends"), closing[F.col("closing")]).otherwise("")).alias("audit")
        ),
        "audits",
    )
    audit = audits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "audit"))).alias("a")).select(
        "conv", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit")
    )
    counts = placed.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col(c)).alias(n) for c, n in (("blank", "blank"), ("twice", "duplicate"), ("early", "truncated"))],
    )
    report = _joined(_joined(counts, chosen.select("conv", "illegal", "cost"), "conv"), audit, "conv")
    edits = _edited(_joined(coded, audits, "conv", "part"))
    own = F.when(F.col("stays"), F.array(F.struct(F.coalesce("given", "role").alias("role"), F.col("text").alias("text"))))
    added = F.transform("inserted", lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    lines = _joined(edits, placed.select("conv", "at", "role", "text"), "conv", "at", how="left").select(
        "conv", "at", F.concat(added, F.coalesce(own, F.array().cast(_LINES))).alias("lines")
    )
    return report, lines


def repair(damaged: DataFrame, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """``(report, lines)`` of ``damaged(conv, turn, role, text, dropped)``.

    The report has a row per conversation, those without rows left included:
    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``. Lines are
    the repaired turns: ``conv, at, lines``, the turns of each row of ``lines``
    following those of a lesser ``at``; a conversation that fits in a task has one
    row (``at`` is NULL), a longer one a row per turn.

    Rows are taken by turn (NULLs first), then role and text; equal rows are
    duplicates. A row is at fault once: blank, else duplicate, else truncated. An
    empty role has no initial, can't be kept and makes its neighbours illegal.
    Edits: keep (0), give to the user or the assistant (3), delete (4, the only
    way with blanks and duplicates), insert an empty turn of either (3); a
    truncated row that stays costs 3 more. The outcome is a system turn or none,
    then pairs of user and assistant, or nothing at all.

    ``least_edits`` searches a few rows at once, for each state before and after;
    results are put together in order, first inside a task, then over the parts of
    a long conversation, of which a few numbers are gathered.
    """
    text = F.col("text")
    left = damaged.where(~F.col("dropped")).select(
        "conv", "turn", "role", "text", F.substring(text, 1, 500).alias("head"), F.md5(text).alias("mark"),
        _blank(text).alias("blank"), _early(text).alias("early"),
    )
    n_bytes = F.sum(F.octet_length("role") + F.octet_length("text"))
    long = damaged.where(~F.col("dropped")).groupBy("conv").agg(F.count(F.lit(1)).alias("n"), n_bytes.alias("b"))
    long = written(long.where((F.col("n") > sizes.rows) | (F.col("b") > sizes.bytes)).select("conv"), "long")
    some = not long.isEmpty()
    here = _joined(left, long, "conv", how="left_anti") if some else left
    row = F.struct("turn", "role", "head", "mark", "text", "blank", "early")
    grouped = here.groupBy("conv").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    found = written(_whole(grouped, sizes), "repaired")
    report, lines = found.drop("lines"), found.select("conv", F.lit(None).cast("long").alias("at"), "lines")
    if some:
        more, more_lines = _in_parts(_joined(left, long, "conv", how="left_semi"), sizes)
        report, lines = report.unionByName(more), lines.unionByName(more_lines)
    counts = [c for c in report.columns if c not in ("conv", "audit")]
    everyone = damaged.select("conv").distinct()
    report = _joined(everyone, report, "conv", how="left").select(
        "conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit")
    )
    return report, lines


def _shown(lines: str) -> Column:
    return F.array_join(F.transform(lines, lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")


def digests(report: DataFrame, lines: DataFrame) -> DataFrame:
    """``report`` with ``repaired_sha256`` of ``role:text`` lines, newline-joined.
    A conversation of many rows streams through one task a batch at a time, as the
    hash of a text can't be taken in parts; its text is never held."""
    whole = lines.where(F.col("at").isNull()).select("conv", F.sha2(_shown("lines"), 256).alias("repaired_sha256"))
    rest = lines.where(F.col("at").isNotNull() & (F.size("lines") > 0))
    names = ["conv", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, state = False, None, None
        kind = None
        for batch in batches:
            kind = batch.schema.field("conv").type
            for c, shown in zip(batch.column("conv").to_pylist(), batch.column("shown").to_pylist(), strict=True):
                if not begun or c != conv:
                    if begun:
                        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], names)
                    begun, conv, state = True, c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(shown.encode())
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], names)

    sorted_ = rest.select("conv", "at", _shown("lines").alias("shown")).repartition("conv").sortWithinPartitions("conv", "at")
    kind = lines.schema["conv"].dataType.simpleString()
    streamed = sorted_.mapInArrow(run, f"conv {kind}, repaired_sha256 string")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    both = _joined(report, whole.unionByName(streamed), "conv", how="left")
    return both.withColumn("repaired_sha256", F.coalesce("repaired_sha256", nothing))
