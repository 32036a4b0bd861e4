from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, shingle=3):
    words = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_fingerprints_of_odd_texts():
    for t in ["", "a", "A b", "a b c", "Éa É\tb\nc d", "x " * 500, "one two three four " * 20]:
        assert simhash.fingerprint_of(t.encode(), 3) == plain_fingerprint(t)


def test_links_equal_all_pairs(spark):
    rng = random.Random(0)
    points = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(30):
            x = base
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            points.add(x - (1 << 64) if x >> 63 else x)
    points = sorted(points)
    bits = np.array(points).view(np.uint64)
    want = Union(points)
    for k, p in enumerate(points):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[k]) <= 2):
            want.join(p, points[j])
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    for leaf in (20, 1 << 15):
        got = {r.node: r.component for r in components(simhash.links(df, 2, leaf)).collect()}
        assert all(got.get(p, p) == want.find(p) for p in points)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(3, "a b c d e"), (1, "A b c d e"), (9, None), (7, ""), (8, " \n"), (3, "a b c d e"), (None, "a b c d e"), (None, "alone in the world of words")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    got = sorted(simhash.near_duplicates(df).collect(), key=str)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[3] == by[1] == {1} and by[7] == by[8] == by[9] == {7} and by[None] == {1, None}
    kept = sorted((r.doc_id, r.text) for r in simhash.representatives(df).where("doc_id is not null").collect())
    assert kept == [(1, "A b c d e"), (7, "")]
    assert simhash.representatives(df).count() == 3
    assert simhash.near_duplicates(df.limit(0)).count() == 0
