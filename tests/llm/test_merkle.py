from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings of each leaf as a list of (left, right))."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            low = p // 16 * 16
            paths[i].append(("".join(nodes[low:p]), "".join(nodes[p + 1 : low + 16])))
        at = [p // 16 for p in at]
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0], leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        below[s] = tree([x for _, x in groups[s]])
    root, above = tree([below[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (key, x), path in zip(groups[s], below[s][1]):
            out.append((key, x, below[s][0], root, [tuple(p) for p in path + up]))
    return sorted(out, key=repr)


def got(df):
    values = [F.col(c) for c in ("doc_id", "source", "text")]
    found = merkle.manifest(df, merkle.leaf_of(*values)).collect()
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in found], key=repr)


def test_odd_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "a", "x"), (None, "a", None), (2, None, ""), (3, "", "z" * 100_000), (4, "é", "é"), (5, "z", "1")]
    rows += [(i, f"s{i % 40}", str(i)) for i in range(100, 190)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, source string, text string, tree string, pos int, n int")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 4097, 8300])
def test_sizes(spark, conf, n):
    """One source with most rows over many ranges, up to a second round of blocks."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(random.Random(i).randrange(10**6), "s", str(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert got(df) == brute(rows)


def test_fold_and_proof(spark):
    rows = [(i, f"s{i % 3}", f"Text {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    values = [F.col("doc_id"), F.col("source")]
    found = merkle.manifest(df, merkle.leaf_of(*values, F.col("text")), carry={"other": merkle.leaf_of(*values, F.lower("text"))})
    out = found.select("path", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("same"), merkle.folded(F.col("other"), F.col("path")).alias("changed"), merkle.proof_of(F.col("path")).alias("proof"))
    for r in out.collect():
        assert r.same == r.root != r.changed
        assert r.proof == h(*[a + b for a, b in r.path])
