from __future__ import annotations

import math
import random
import re

from pyspark.sql import functions as F

from ledgerloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, at, covered = WORD.findall(text), {}, set()
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            for i in places:
                covered |= {i, i + 1, i + 2}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "a", "a b c a b c a b c", "a a a a", "x y z\nx y z\n\nx y z", "é à ü é à ü #", " lead", "a b c d a b c", "##|| <>"]
    texts += [rng.choice([" ", "\n", "\t"]).join(rng.choice("aabcd*") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts.append(" ".join(str(rng.randrange(3000)) for _ in range(20000)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.counts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 10, 100, 3000) for k in (0, 1, 5, 9, 50) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", quality.tail(F.col("k"), F.col("n"), 0.02))
    for r in df.collect():
        want = 1.0 if r.k >= r.n * 0.02 else sum(math.comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert abs(r.p - want) < 1e-9


def test_cutoffs_are_the_strictest_safe_ones(spark):
    rng = random.Random(5)
    rows = [(i, "en" if i % 2 else None, rng.random() ** 6) for i in range(6000)]
    rule = quality.Rule("m", F.col("m"), tuple(round(1 - k / 20, 2) for k in range(21)))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, m double").withColumn("lang", F.coalesce("lang", F.lit("")))
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i, _, _ in rows if i % 3], "doc_id long, quality int")
    got = {r.lang: r.cutoff for r in quality.cutoffs(measured, labels, [rule], "lang", "doc_id", F.col("quality") == 1, 0.1, 0.05).collect()}
    for lang in ("en", ""):
        good = [m for i, name, m in rows if (name or "") == lang and i % 3 and i % 5]
        best = None
        for c in rule.cutoffs:
            k, n = sum(m > c for m in good), len(good)
            p = 1.0 if k >= 0.1 * n else sum(math.comb(n, i) * 0.1**i * 0.9 ** (n - i) for i in range(k + 1))
            if p > 0.05 / 2:
                break
            best = c
        assert got.get(lang) == best and best is not None


def test_verdicts_of_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, "en", 0.5), (1, text, None, 0.1), (None, None, "en", None), (2, "b " * 80, "de", 0.0)], "doc_id long, text string, lang string, symbols double")
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.verdicts(df, labels, F.col("quality") == 1).collect()), key=str)
    assert got == sorted([(1, 60, False, True), (1, 60, False, True), (None, 0, True, False), (2, 80, True, False)], key=str)
    assert quality.verdicts(df.limit(0), labels.limit(0), F.col("quality") == 1).count() == 0
