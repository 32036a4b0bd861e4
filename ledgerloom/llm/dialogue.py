"""Repair of the order of roles in conversations by the cheapest edits.

Square-root checkpointed dynamic programme. A state is the role that came last; a vector has, for each state, the cost of the
cheapest edits for the rows that follow. Vectors are computed backwards and stored at checkpoints only, a square root of the
rows apart; walking forward, the vectors of a stretch are computed again from the checkpoint behind it, and of all edits that keep
the cost least the first in ASCII order is taken.

Rows lie in ranges of (conversation, turn), so a conversation may go on over many tasks. One that ends where it began is
settled there. Of the others each block of rows is reduced to the least costs between the states before and after it; these
few numbers give the vector behind every block (checkpoints again), each block is walked from each of the four states, and the
state in which it is entered picks the walk. Repeated rows are one row with a count. No task holds more than one block, except
that SHA-256 is serial by nature: it streams over the lines of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import shuffle_tasks
from .shared import written

#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after the system's row, after a user's, after an assistant's; and where the role due next leads.
NEXT = (2, 2, 3, 2)
DUE = ("user", "user", "assistant", "user")
#: Costs behind the last row: only nothing and an assistant may come last, the others insert what is due.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 65_536
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

#: A row of the programme: initial of the role (blank: none), must go, is truncated, copies.
Row = tuple[str, bool, bool, int]
Vector = tuple[int, int, int, int]


def _closed(b: Sequence[int]) -> Vector:
    """With rows inserted in front, as far as that is cheaper."""
    second, third = min(b[2], INSERT + b[3]), min(b[3], INSERT + b[2])
    return min(b[0], INSERT + second), min(b[1], INSERT + second), second, third


def before(row: Row, v: Vector) -> Vector:
    """The vector before a row from that behind it. Copies after the first always go."""
    kind, dead, cut, n = row
    if dead:
        return tuple(x + DELETE * n for x in v)
    more, cut = DELETE * (n - 1), TRUNCATED if cut else 0
    to_user = cut + (0 if kind == "u" else REROLE) + v[2]
    to_assistant = cut + (0 if kind == "a" else REROLE) + v[3]
    first = min(DELETE + v[0], to_user)
    if kind == "s":
        first = min(first, cut + v[1])
    return tuple(x + more for x in _closed((first, min(DELETE + v[1], to_user), min(DELETE + v[2], to_assistant), min(DELETE + v[3], to_user))))


def backward(rows: Sequence[Row], v: Vector, step: int | None = None) -> tuple[Vector, list[Vector]]:
    """The vector before the first row, and with ``step`` those behind each stretch of so many rows."""
    kept = []
    for i in range(len(rows) - 1, -1, -1):
        if step and (i + 1 == len(rows) or (i + 1) % step == 0):
            kept.append(v)
        v = before(rows[i], v)
    return v, kept[::-1]


def walk(rows: Sequence[Row], behind: Vector, state: int = 0, last: bool = True) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits and the state that they end in. ``last``: nothing follows the rows."""
    step = isqrt(len(rows)) + 1
    _, marks = backward(rows, behind, step)
    out = []
    for k, mark in enumerate(marks):
        part = rows[k * step : (k + 1) * step]
        vectors = [mark]
        for row in reversed(part):
            vectors.append(before(row, vectors[-1]))
        vectors.reverse()
        for row, v, after in zip(part, vectors, vectors[1:]):
            kind, dead, cut, n = row
            more, cut = DELETE * (n - 1), TRUNCATED if cut else 0
            while True:
                left = v[state] - more
                if dead or DELETE + after[state] == left:
                    out.append("D")
                elif INSERT + v[NEXT[state]] == v[state]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                elif kind == DUE[state][0] and cut + after[NEXT[state]] == left:
                    out.append("K")
                    state = NEXT[state]
                elif kind == "s" and state == 0 and cut + after[1] == left:
                    out.append("K")
                    state = 1
                else:
                    out.append("R")
                    state = NEXT[state]
                break
            if n > 1:
                out.append("D" * (n - 1))
    while last and END[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def _illegal(rows: Sequence[Row]) -> int:
    pairs = sum(a[0] + b[0] not in LEGAL for a, b in zip(rows, rows[1:]))
    return pairs + sum(r[3] - 1 for r in rows)


def _facts(turns: DataFrame) -> DataFrame:
    """Rows without their texts: (conv, turn, role, sha, n, blank, again, cut)."""
    end = F.rtrim("text", F.lit(SPACE))
    thin = turns.select("conv", "turn", "role", "sha", "n", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # The first turn of each role and text; no turn comes first.
    firsts = turns.groupBy("conv", "role", "sha").agg(F.min("turn").alias("turn"), F.bool_or(F.col("turn").isNull()).alias("none"))
    firsts = firsts.select("conv", "role", "sha", F.when(~F.col("none"), F.col("turn")).alias("__first"), F.lit(True).alias("__new"))
    same = ["conv", "role", "sha"]
    on = [thin[c] == firsts[c] for c in same] + [thin["turn"].eqNullSafe(firsts["__first"])]
    return thin.join(firsts, on, "left").select(*[thin[c] for c in thin.columns], F.col("__new").isNull().alias("again"))


ITEM = "struct<turn:long,role:string,sha:string>"
BLOCK = f"conv string, seg int, block int, open boolean, kinds array<string>, dead array<boolean>, cut array<boolean>, n array<long>, items array<{ITEM}>, illegal long, cost long, audit string, steps array<long>"


def _rows(kinds: Sequence[str], dead: Sequence[bool], cut: Sequence[bool], n: Sequence[int]) -> list[Row]:
    return list(zip(kinds, dead, cut, n))


def _blocks(thin: DataFrame, most: int) -> DataFrame:
    """Blocks of rows in order; those of a conversation that lies within one range as one, with its edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId()
        done, size = [], 0
        name, block, first, buffer = None, 0, True, []

        def flush(open_: bool) -> None:
            nonlocal size, buffer, block
            rows = [(r[1][:1] if r[1] else "", r[4], r[5], r[3]) for r in buffer]
            kinds, dead, cut, n = map(list, zip(*rows))
            audit = cost = steps = None
            if open_:
                ways = [backward(rows, tuple(0 if q == p else FAR for q in range(4)))[0] for p in range(4)]
                steps = [min(ways[q][p], FAR) for p in range(4) for q in range(4)]
            else:
                cost, audit = backward(rows, END)[0][0], walk(rows, END)[0]
            items = [{"turn": r[0], "role": r[1], "sha": r[2]} for r in buffer]
            done.append((name, seg, block, open_, kinds, dead, cut, n, items, _illegal(rows), cost, audit, steps))
            size += len(buffer)
            buffer, block = [], block + 1

        def batch() -> pa.RecordBatch:
            nonlocal done, size
            columns = [pa.array(list(c), t) for c, t in zip(zip(*done), schema.types)]
            done, size = [], 0
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for conv, *row in zip(*columns):
                if conv != name:
                    if buffer:
                        # The first of a range may have begun in the one before.
                        flush(first or block > 0)
                        first = False
                    name, block = conv, 0
                elif len(buffer) == most:
                    flush(True)
                buffer.append(row)
                if size >= BLOCK_ROWS:
                    yield batch()
        if buffer:
            flush(True)
        if done:
            yield batch()

    schema = _arrow(BLOCK)
    thin = thin.select("conv", "turn", "role", "sha", "n", (F.col("blank") | F.col("again")).alias("dead"), "cut")
    order = ["conv", "turn", "role", "sha"]
    return thin.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, BLOCK)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _vectors(group: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each block of a conversation; cost and illegal pairs of the whole go with its first block."""
    group = group.sort_values(["seg", "block"])
    v, out = END, []
    ends = group[["first", "final"]].to_numpy().tolist()
    for steps in reversed(group["steps"].tolist()):
        out.append(list(v))
        v = _closed([min(int(steps[4 * p + q]) + v[q] for q in range(4)) for p in range(4)])
    group = group[["conv", "seg", "block"]].assign(behind=out[::-1], last=False, cost=None, seams=0)
    group.iloc[-1, group.columns.get_loc("last")] = True
    group = group.astype({"cost": "Int64"})
    group.iloc[0, group.columns.get_loc("cost")] = v[0]
    group.iloc[0, group.columns.get_loc("seams")] = sum(a[1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:]))
    return group


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of a conversation is entered."""
    group = group.sort_values(["seg", "block"])
    state, out = 0, []
    for goes in group["goes"].tolist():
        out.append(state)
        state = int(goes[state])
    return group[["conv", "seg", "block"]].assign(entry=out)


def _walked(blocks: DataFrame) -> DataFrame:
    """Edits of open blocks from each state, and the states that they end in."""
    kind = "conv string, seg int, block int, audits array<string>, goes array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one in range(b.num_rows):
                conv, seg, block, kinds, dead, cut, n, behind, last = (c[one].as_py() for c in b.columns)
                ways = [walk(_rows(kinds, dead, cut, n), tuple(behind), p, last) for p in range(4)]
                columns = [[conv], [seg], [block], [[w[0] for w in ways]], [[w[1] for w in ways]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    schema = _arrow(kind)
    return blocks.select("conv", "seg", "block", "kinds", "dead", "cut", "n", "behind", "last").mapInArrow(run, kind)


def _lines(decided: DataFrame) -> DataFrame:
    """The rows of the repaired conversations in order; inserted ones have no ``sha``."""
    kind = "conv string, seg int, block int, line long, turn long, was string, sha string, role string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, seg, block, state, audit, items, n in zip(*(c.to_pylist() for c in b.columns)):
                at = line = 0
                left = n[0]
                for edit in audit:
                    if edit != "I":
                        item, left = items[at], left - 1
                        if not left:
                            at += 1
                            left = n[at] if at < len(n) else 0
                    if edit == "D":
                        continue
                    if edit == "I":
                        out.append((conv, seg, block, line, None, None, None, DUE[state]))
                    else:
                        out.append((conv, seg, block, line, item["turn"], item["role"], item["sha"], item["role"] if edit == "K" else DUE[state]))
                    line += 1
                    state = 1 if edit == "K" and state == 0 and item["role"][:1] == "s" else NEXT[state]
                if len(out) >= BLOCK_ROWS:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    schema = _arrow(kind)
    return decided.select("conv", "seg", "block", "entry", "audit", "items", "n").mapInArrow(run, kind)


def _hashed(lines: DataFrame) -> DataFrame:
    """SHA-256 over the lines of each conversation, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, names, hashes = None, None, [], []
        for b in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if conv != name:
                    if state:
                        names.append(name)
                        hashes.append(state.hexdigest())
                    name, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.string())], ["conv", "repaired_sha256"])
                names, hashes = [], []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([state.hexdigest()], pa.string())], ["conv", "repaired_sha256"])

    ordered = lines.repartition(shuffle_tasks(lines.sparkSession), "conv").sortWithinPartitions("conv", "seg", "block", "line")
    return ordered.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


@dataclass(frozen=True)
class Repaired:
    """``summary`` has a row for each conversation, ``lines`` the repaired rows: (conversation, seg, block, line, role, text)."""

    summary: DataFrame
    lines: DataFrame


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS) -> Repaired:
    """Faults, cheapest edits and repaired rows of every conversation.

    Null roles and texts are one space; null conversations are one conversation. Rows go by turn, null first; rows of one turn by
    role and then by the SHA-256 of the text, so repeated rows are adjacent. A role without a first letter is never kept.
    Other columns are not looked at. No rows: no conversations. A conversation that loses all its rows has the hash of nothing.
    """
    blank = F.lit(" ")
    name = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))
    plain = rows.select(name.alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), blank).alias("role"), F.coalesce(F.col(text).cast("string"), blank).alias("text"))
    turns = written(plain.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n")).withColumn("sha", F.sha2("text", 256)), "turns")
    thin = written(_facts(turns), "facts")
    clean = ~F.col("blank") & ~F.col("again")
    counts = [
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum(F.when(clean & F.col("cut"), 1).otherwise(0).cast("long")).alias("truncated"),
    ]
    by_turn = thin.groupBy("conv", "turn").agg(*counts)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    faults = by_turn.groupBy("conv").agg(gaps, *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])

    blocks = written(_blocks(thin, block_rows), "blocks")
    split = blocks.where("open")
    ends = [F.get("kinds", F.lit(0)).alias("first"), F.element_at("kinds", -1).alias("final")]
    behind = written(split.select("conv", "seg", "block", "steps", *ends).groupBy("conv").applyInPandas(_vectors, "conv string, seg int, block int, behind array<long>, last boolean, cost long, seams long"), "vectors")
    walked = written(_walked(split.join(behind, ["conv", "seg", "block"])), "walks")
    entries = walked.select("conv", "seg", "block", "goes").groupBy("conv").applyInPandas(_entries, "conv string, seg int, block int, entry int")
    picked = walked.join(entries, ["conv", "seg", "block"]).select("conv", "seg", "block", "entry", F.get("audits", F.col("entry")).alias("audit"))
    costs = behind.select("conv", "seg", "block", "cost", "seams")
    rest = split.drop("audit", "cost").join(picked, ["conv", "seg", "block"]).join(costs, ["conv", "seg", "block"])
    chosen = ["conv", "seg", "block", "entry", "audit", "items", "n", "illegal", "cost"]
    whole = blocks.where("not open").withColumn("entry", F.lit(0))
    decided = written(whole.select(chosen).unionByName(rest.withColumn("illegal", F.col("illegal") + F.col("seams")).select(chosen)), "decided")

    pieces = F.array_sort(F.collect_list(F.struct("seg", "block", "audit")))
    verdicts = decided.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
    lines = written(_lines(decided), "lines")
    place = ["conv", "seg", "block", "line", "role"]
    texts = turns.select(F.col("conv").alias("__conv"), F.col("turn").alias("__turn"), F.col("role").alias("__role"), F.col("sha").alias("__sha"), "text")
    same = (F.col("conv") == F.col("__conv")) & F.col("turn").eqNullSafe(F.col("__turn")) & (F.col("was") == F.col("__role")) & (F.col("sha") == F.col("__sha"))
    left = lines.where("sha is not null").join(texts, same).select(*place, "text")
    full = left.unionByName(lines.where("sha is null").select(*place, F.lit("").alias("text")))
    ids = rows.select(F.col(conv).alias("__id")).distinct().withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("__id").cast("string")), F.lit("")))
    summary = ids.join(faults, "conv").join(verdicts, "conv").join(_hashed(full), "conv", "left").select(
        F.col("__id").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256")
    )
    back = full.join(ids, "conv").select(F.col("__id").alias(conv), "seg", "block", "line", "role", "text")
    return Repaired(summary, back)
