from __future__ import annotations

import collections
import hashlib
import random

import pytest

from ledgerloom.llm import repeats


def brute(rows, window):
    seen, words = collections.Counter(), [(t or "").encode().split() for _, t in rows]
    for w in words:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [3, 6, 35])
def test_equals_brute_force(spark, window):
    rng = random.Random(window)
    base = [[rng.choice("abcdefgh") if rng.random() < 0.3 else str(rng.randrange(10**6)) for _ in range(200)] for _ in range(5)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(4)):
            source, at = rng.choice(base), rng.randrange(150)
            parts += source[at : at + rng.randrange(60)] + [rng.choice("abc") for _ in range(rng.randrange(12))]
        rows.append((i if i % 7 else 3, " \n".join(parts)))
    rows += [(None, None), (5, ""), (6, rows[3][1]), (6, rows[3][1]), (8, "a " * 300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, seq string")
    got = repeats.repeated_words(df, window=window).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, window)


def test_rewritten_text(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"one {shared} two"), (2, f"three {shared}"), (3, "left  alone\n"), (4, None)], "doc_id long, text string")
    found = repeats.repeated_words(df)
    assert {r.doc_id: r.text for r in repeats.kept_text(df, found).collect()} == {1: "one two", 2: "three", 3: "left  alone\n", 4: None}
    assert repeats.repeated_words(df.limit(0)).count() == 0
