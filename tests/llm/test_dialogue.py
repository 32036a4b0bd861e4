from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest

from ledgerloom.llm import catalog, dialogue

END = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cheapest(rows):
    """(cost, audit, lines) by a search over all edits in the order of (cost, audit); rows are (role, text, fault)."""
    import heapq

    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and END.fullmatch(roles):
            return cost, audit, lines
        tail = roles[-1:] or "^"
        if (at, tail) in seen:
            continue
        seen.add((at, tail))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role[0], (*lines, f"{role}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1]:
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role[0], (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, roles + new[0], (*lines, f"{new}:{text}")))
        heap = [h for h in heap if re.fullmatch(r"s?(ua)*u?", h[3])]
        heapq.heapify(heap)
    raise AssertionError


def brute(rows):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2])))
        seen, marked = set(), []
        for _, role, text in mine:
            found = WORD.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, sha("\n".join(lines)))
    return out


def random_rows(seed, conversations=12, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"])
            text = rng.choice(["a.", "b!", "c", " ", "", None, f"w{t}? \n", f"é{rng.randrange(4)}", "x.y", "z.\x0b"])
            rows += [(None if c == 3 else c, None if rng.random() < 0.1 else t, role, text)] * rng.choice([1, 1, 1, 2, 4])
    return rows


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_equals_brute_force(spark, conf, block):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = random_rows(block)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seg string, conv int")
    got = {r[0]: tuple(r) for r in dialogue.repaired(df, block_rows=block).summary.collect()}
    assert got == brute(rows)


def test_lines_of_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again?"), (1, 2, "assistant", "Yes."), (2, 0, "system", "Be."), (2, 1, "assistant", "No.")]
    done = dialogue.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    lines = [(r.conv_id, r.role, r.text) for r in done.lines.orderBy("conv_id", "seg", "block", "line").collect()]
    assert lines == [(1, "user", "Again?"), (1, "assistant", "Yes."), (2, "user", "Be."), (2, "assistant", "No.")]
    assert {r.conv_id: (r.cost, r.audit) for r in done.summary.collect()} == {1: (2, "DKK"), 2: (1, "RK")}
    assert dialogue.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).summary.count() == 0


def test_a_conversation_over_many_tasks(spark, conf):
    """One conversation has nearly all rows; it is split, and its edits equal those of one walk."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t % 40}." if rng.random() < 0.9 else f"{t}") for t in range(4000)] + [(7, 1, "user", "y.")] * 500
    df = spark.createDataFrame(rows + [(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (got,) = dialogue.repaired(df, block_rows=100).summary.where("conv_id = 7").collect()
    mine = sorted(rows, key=lambda r: (r[1], r[2], sha(r[3])))
    seen, steps = set(), []
    for _, _, role, text in mine:
        steps.append((role[0], (role, text) in seen, text[-1] != ".", 1))
        seen.add((role, text))
    assert (got.cost, got.audit) == (dialogue.backward(steps, dialogue.END)[0][0], dialogue.walk(steps, dialogue.END)[0])


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        damaged += [row] * {0: 0, 3: 2}.get(kind, 1)
    want = {r[0]: (r[0], 0, 0, 0, 0, 0, 0, "", sha("")) for r in rows} | brute(damaged)
    got = {r[0]: tuple(r) for r in catalog.queries()["op11_conversation_repair"](spark, folder).collect()}
    assert got == want
