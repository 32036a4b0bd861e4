"""SimHash near-duplicates: fingerprints, and a self-join of the binary trie that they form.

Fingerprints are grouped below trie nodes of at most ``leaf`` different ones. Pairs of nodes are walked down together
from the pair of roots, four levels a step, with the differing bits so far; a pair over the budget goes. Pairs of small
nodes are finished in tasks, which walk the rest of both subtries in the same way on arrays. Only nodes of more than
``leaf`` fingerprints are split in Spark, so the table of node pairs is small, and no task gets an unbounded node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .shared import written
from .words import as_bytes

BITS, STEP = 64, 4
#: Different fingerprints below a node that one task takes; a pair of nodes has twice as many at most.
LEAF = 1 << 15


def fingerprint_of(text: bytes, shingle: int) -> int:
    """Bit is 1 if set in over half of the shingles' hashes; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    flat, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(flat, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[: n - shingle] + 1).tolist()]
    digest = xxhash.xxh64_digest
    found = b"".join([digest(flat[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())])
    total, count, block = np.zeros(64, np.int64), n - shingle + 1, 1 << 16
    for k in range(0, count, block):
        rows = np.frombuffer(found, np.uint8, 8 * min(block, count - k), 8 * k).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` without the text, with the fingerprint as a long of the same 64 bits; a null text counts as empty."""
    keep = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(len(keep)))
            made = np.array([fingerprint_of(t, shingle) if t else 0 for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made.view(np.int64))], [*keep, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    return plain.mapInArrow(run, f"{kinds}{', ' if kinds else ''}`{out}` bigint")


def _prefix(column: str, depth: int) -> Column:
    """The first ``depth`` bits, the others zero."""
    return F.col(column).bitwiseAND(F.lit(-(1 << (BITS - depth))).cast("long"))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def node_pairs(points: DataFrame, bits: int, leaf: int) -> DataFrame:
    """(depth, a, b): pairs of trie nodes for the tasks. ``points``: different fingerprints (fp).

    Together the pairs cover every pair of fingerprints within ``bits`` exactly once.
    """
    spark = points.sparkSession
    # The pair of roots, walked down by one step.
    top = [(a, b, (a ^ b).bit_count()) for a in range(1 << STEP) for b in range(a, 1 << STEP)]
    top = [(_signed(a << (BITS - STEP)), _signed(b << (BITS - STEP)), d) for a, b, d in top if d <= bits]
    pairs = spark.createDataFrame(top, "a long, b long, diff int")
    done, depth = None, STEP
    while True:
        nodes = written(points.groupBy(_prefix("fp", depth).alias("node")).agg(F.count("*").alias("n")), "nodes")
        sized = pairs.join(nodes.toDF("a", "na"), "a").join(nodes.toDF("b", "nb"), "b")
        large = (F.greatest("na", "nb") > leaf) if depth < BITS else F.lit(False)
        sized = written(sized.withColumn("large", large), "pairs")
        ready = sized.where("not large").select(F.lit(depth).alias("depth"), "a", "b")
        done = ready if done is None else done.unionByName(ready)
        pairs = sized.where("large").select("a", "b", "diff")
        if depth == BITS or pairs.isEmpty():
            return done
        # Children: the next four bits of both sides; a pair of equal nodes takes each pair of children once.
        below = points.select(_prefix("fp", depth).alias("up"), _prefix("fp", depth + STEP).alias("node")).distinct()
        down = pairs.join(below.toDF("a", "ca"), "a").join(below.toDF("b", "cb"), "b")
        diff = F.col("diff") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) - F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        pairs = down.where("a <> b or ca <= cb").withColumn("diff", diff).where(F.col("diff") <= bits).select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("diff").cast("int"))
        depth += STEP


def _ranges(a: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the bit turns to one inside each sorted range whose higher bits are equal."""
    ones = np.concatenate(([0], np.cumsum((a >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)))
    return hi - (ones[hi] - ones[lo])


def close_pairs(a: np.ndarray, b: np.ndarray, depth: int, bits: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted arrays of uint64 within ``bits``; ``same``: one array with itself, i < j.

    Walks both subtries below ``depth`` together. Node pairs over the budget are dropped; pairs with few members are
    compared directly. The walk goes depth first in blocks, so memory stays bounded.
    """
    if not len(a) or not len(b):
        return
    start = np.array([[0], [len(a)], [0], [len(b)], [0]], np.int64)
    base = int(a[0] ^ b[0]) >> (BITS - depth) if depth else 0
    start[4] = base.bit_count()
    stack = [(depth, start)]
    while stack:
        at, s = stack.pop()
        if s.shape[1] > 1 << 18:
            half = s.shape[1] // 2
            stack += [(at, s[:, :half]), (at, s[:, half:])]
            continue
        small = ((s[1] - s[0]) * (s[3] - s[2]) <= 16) | (at == BITS)
        few = s[:, small]
        if few.shape[1]:
            wide = few[3] - few[2]
            n = (few[1] - few[0]) * wide
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w = np.repeat(wide, n)
            i, j = np.repeat(few[0], n) + k // w, np.repeat(few[2], n) + k % w
            good = np.bitwise_count(a[i] ^ b[j]) <= bits
            if same:
                good &= i < j
            if good.any():
                yield i[good], j[good]
        s = s[:, ~small]
        if not s.shape[1]:
            continue
        bit = BITS - 1 - at
        am, bm = _ranges(a, s[0], s[1], bit), _ranges(b, s[2], s[3], bit)
        out = []
        for x in (0, 1):
            for y in (0, 1):
                lo, hi = (s[0], am) if x == 0 else (am, s[1])
                lo2, hi2 = (s[2], bm) if y == 0 else (bm, s[3])
                diff = s[4] + (x != y)
                good = (hi > lo) & (hi2 > lo2) & (diff <= bits)
                if same:
                    good &= lo < hi2
                out.append(np.stack([lo, hi, lo2, hi2, diff])[:, good])
        stack.append((at + 1, np.concatenate(out, axis=1)))


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``pairs`` connects: every member to the least of its group."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            ri, rj = root[i], root[j]
            differ = ri != rj
            if not differ.any():
                break
            i, j, ri, rj = i[differ], j[differ], ri[differ], rj[differ]
            np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
            while (root[root] != root).any():
                root = root[root]
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def links(points: DataFrame, bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """(a, b) long: links whose components are those of all fingerprint pairs within ``bits``.

    Each pair of trie nodes gives a spanning forest of its links, so groups of near copies give as many rows as members.
    """
    pairs = written(node_pairs(points, bits, leaf).withColumn("pair", F.xxhash64("depth", "a", "b")), "pairs")
    depths = [r[0] for r in pairs.select("depth").distinct().collect()]  # 17 at most
    sides = None
    for d in depths:
        here = pairs.where(F.col("depth") == d)
        keyed = points.withColumn("node", _prefix("fp", d))
        for side, own in (("a", here), ("b", here.where("a <> b"))):
            one = keyed.join(own.select(F.col(side).alias("node"), "pair", "depth", F.col("a"), F.col("b")), "node").select("depth", "a", "b", F.lit(side == "b").alias("second"), "fp")
            sides = one if sides is None else sides.unionByName(one)

    def finish(table: pa.Table) -> pa.Table:
        depth = table.column("depth")[0].as_py()
        fp = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
        second = table.column("second").combine_chunks().to_numpy(zero_copy_only=False)
        a, b = np.sort(fp[~second]), np.sort(fp[second])
        same = not len(b)
        every = a if same else np.concatenate([a, b])
        found = close_pairs(a, a if same else b, depth, bits, same)
        member, root = _forest(len(every), found if same else ((i, j + len(a)) for i, j in found))
        return pa.table({"a": pa.array(every[member].view(np.int64)), "b": pa.array(every[root].view(np.int64))})

    if sides is None:
        return points.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    return sides.groupBy("depth", "a", "b").applyInArrow(finish, "a long, b long")


def _classes(docs: DataFrame, key: str, text: str, shingle: int, bits: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Rows (key, raw, fingerprint), and for each fingerprint its component and the least key in that."""
    raw = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("raw")
    marked = written(fingerprints(docs.select(F.col(key).alias("key"), raw, F.col(text).alias("text")), "text", shingle), "fingerprints")
    # Copies are one point; bit order of the unsigned value does not matter for links.
    points = written(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("least")), "points")
    found = components(links(points.select("fp"), bits, leaf))
    named = points.join(found.toDF("fp", "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = written(named.select("fp", "component").join(least, "component").select(F.col("fp").alias("fingerprint"), "component", "component_id"), "classes")
    return marked, known


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """(key, fingerprint long, component_id): the component is the smallest key whose fingerprint can be reached by links.

    Null and empty texts have fingerprint 0 and link like any other. Rows with equal keys each give a row. A null key gets
    the component of its fingerprint, which is null only if no linked row has a key. Other columns are not looked at.
    """
    marked, known = _classes(docs, key, text, shingle, bits, leaf)
    return marked.join(known, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest key, null last, and of equal keys the least hash of the text."""
    marked, known = _classes(docs, key, text, shingle, bits, leaf)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "raw")).alias("r")
    kept = written(marked.join(known, "fingerprint").groupBy("component").agg(first).select("r.key", "r.raw"), "kept")
    own = docs.withColumn("__raw", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    out = own.join(kept.toDF("__key", "__kept"), (F.col("__raw") == F.col("__kept")) & F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    # Rows that repeat key and text are the only ones that can be left twice; the text is shuffled for them only if there are any.
    repeated = marked.groupBy("key", "raw").agg(F.count("*").alias("n")).where("n > 1")
    return (out if repeated.isEmpty() else out.dropDuplicates([key, "__raw"])).drop("__raw")
