from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity

SMALL = toxicity.Shape(window=8, stride=6, hidden=6, word_buckets=1 << 10, char_buckets=1 << 10)


def texts(n=600):
    rng = random.Random(1)
    plain = ["".join(rng.choice("aeiou") + rng.choice("bdfgklmnprst") for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows = []
    for k in range(n):
        words, bad = [rng.choice(plain) for _ in range(rng.randrange(3, 60))], k % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = "zorq" + rng.choice(plain)
        rows.append((k, " ".join(words), int(bad)))
    return rows


def test_gradients():
    shape = toxicity.Shape(window=5, stride=3, hidden=4, word_buckets=16, char_buckets=16, word_size=3, char_size=3)
    net, rng = toxicity.Network(shape, 1), np.random.default_rng(0)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    mask, y = np.ones((6, 5), bool), np.array([1.0, 0, 1, 1, 0, 0])
    mask[2, 3:] = False
    gates = {k: rng.standard_normal((6, 5, 12)) for k in "fb"}

    def loss():
        kept = net.run(lambda k, t: gates[k][:, t], mask, keep=True)
        return (np.logaddexp(0, kept[0]) - y * kept[0]).sum(), kept

    kept = loss()[1]
    weights, inputs = net.gradients(toxicity._sigmoid(kept[0]) - y, mask, kept)
    pairs = [(net.p[k], weights[k]) for k in ("uf", "ub", "attend", "out")] + [(gates[k], inputs[k]) for k in "fb"]
    for array, gradient in pairs:
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in array.shape)
            was, sides = array[at], []
            for d in (1e-3, -1e-3):
                array[at] = was + d
                sides.append(loss()[0])
            array[at] = was
            assert abs((sides[0] - sides[1]) / 2e-3 - gradient[at]) < 1e-4


def test_windows_cover_every_word():
    for n in range(1, 80):
        covered = {i for a in toxicity.starts(n, 8, 6) for i in range(a, min(n, a + 8))}
        assert covered == set(range(n))


def test_held_out_accuracy_and_odd_rows(spark):
    rows = texts()
    df = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    net = toxicity.train(df, labels, shape=SMALL)
    assert toxicity.train(df, labels.limit(0), shape=SMALL) is None
    got = toxicity.scored(df.withColumn("out", toxicity.held_out("doc_id")), net).where("out").collect()
    truth = {k: y for k, _, y in rows}
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in got) / len(got) > 0.95
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "\n "), (3, "zorqa"), (4, rows[1][1] * 300)], "doc_id long, text string")
    scores = [r.score for r in toxicity.scored(odd, net).orderBy(F.col("doc_id").asc_nulls_first()).collect()]
    assert scores[:3] == [0.0, 0.0, 0.0] and all(0 <= s <= 1 for s in scores)
    assert toxicity.scored(odd.limit(0), net).count() == 0 and {r.score for r in toxicity.scored(odd, None).collect()} == {0.0}
    again = odd.select("doc_id", F.lit("old").alias("score"), "text")
    for by in (net, None):
        named = toxicity.scored(again, by)
        assert named.columns == ["doc_id", "text", "score"] and all(isinstance(r.score, float) for r in named.collect())


def test_every_window_is_learned_from(monkeypatch):
    read = []
    gradients = toxicity.Network.gradients
    monkeypatch.setattr(toxicity.Network, "gradients", lambda net, d, mask, kept: read.append(len(d)) or gradients(net, d, mask, kept))
    texts = [b" ".join(b"w%d" % ((k * 7 + i) % 50) for i in range(32 + 24 * 9)) for k in range(8)]
    assert toxicity.fit(texts, [k % 2 for k in range(8)], weak=3, sharp=0, batch=8)
    assert sum(read) >= 80


def test_the_fit_is_bounded_by_bytes(spark):
    rows = texts(60)
    long = [(100, "zorqa " * 4000, 1), (101, "plain " * 4000, 0)]
    df = spark.createDataFrame([(k, t, "x") for k, t, _ in rows + long], "doc_id long, text string, hash string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows + long], "doc_id long, toxic int")
    net = toxicity.train(df, labels, shape=SMALL, sample_bytes=1 << 19)
    same = toxicity.train(df.where("doc_id < 100"), labels, shape=SMALL, sample_bytes=1 << 19)
    assert net.p.keys() == toxicity.Network(SMALL).p.keys() and all(np.array_equal(net.p[k], same.p[k]) for k in net.p)
    less = toxicity.train(df, labels, shape=SMALL, sample_bytes=1 << 14)
    assert not np.array_equal(net.p["out"], less.p["out"])
    assert toxicity.train(df, labels, shape=SMALL, sample_bytes=64) is None


def test_scores_are_those_of_every_window_alone(monkeypatch):
    """Windows are read in blocks of columns, with a mask where places are left over; the table of words starts anew in between."""
    net, rng = toxicity.Network(SMALL, 3), random.Random(5)
    plain = [f"{rng.choice('abc')}{k}".encode() for k in range(300)]
    texts = [None, b"", b" \n", b"One", b"\tone\x0bTWO\r\n"] + [b" ".join(rng.choice(plain) for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    masks, real = [], toxicity.Network.read
    monkeypatch.setattr(toxicity.Network, "read", lambda net, table, ids, mask: masks.append((mask is None, (ids > 0).all())) or real(net, table, ids, mask))
    monkeypatch.setattr(toxicity, "REMEMBERED", 250)
    scorer = toxicity.Scorer(net)
    texts += [b" ".join(plain[:20])] * (50 - len(texts) % 50) + [b" ".join(plain[k : k + 9]) for k in range(50)]
    got = np.concatenate([scorer.scores(texts[k : k + 50]) for k in range(0, len(texts), 50)])
    assert {m for m, _ in masks} == {True, False} and all(m == whole for m, whole in masks)
    for text, score in zip(texts, got):
        words = (text or b"").lower().split()
        worst = 0.0
        for a in toxicity.starts(len(words), SMALL.window, SMALL.stride) if words else []:
            here = words[a : a + SMALL.window]
            ids = np.array([[*range(1, len(here) + 1), *[0] * (SMALL.window - len(here))]])
            x = net.vectors(*net.inputs([b"", *here]))
            gates = {k: (x @ net.p[f"x{k}"] + net.p[f"c{k}"])[ids] for k in "fb"}
            worst = max(worst, float(toxicity._sigmoid(net.run(lambda k, t: gates[k][:, t], ids > 0, keep=True)[0].astype(float))[0]))
        assert abs(score - worst) < 1e-6
