from __future__ import annotations

import random
from collections import Counter

import numpy as np

from ledgerloom.llm import decontaminate

LATENT = decontaminate.Latent(buckets=1 << 10, skip=2, rank=24, extra=4)


def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bdfgklmnprst") for _ in range(rng.randrange(1, 5)))
    lexicon = [word() for _ in range(3000)]
    say = lambda n: " ".join(rng.choice(lexicon[: 60 if rng.random() < 0.5 else 3000]) for _ in range(n))
    items = [(k, say(rng.randrange(12, 50)).capitalize() + ".\n" + say(6) + ".") for k in range(30)]
    docs, want = [(k, say(rng.randrange(1, 400))) for k in range(300)], set()
    for k in range(60):
        item, body = rng.choice(items)
        words = body.split()
        if k % 2:
            words = [w if rng.random() > 0.12 else "changed" for w in words]
        host = say(rng.randrange(200)).split()
        at = rng.randrange(len(host) + 1)
        docs.append((1000 + k, " ".join(host[:at] + words + host[at:])))
        want.add((1000 + k, item))
    return docs, items, want


def test_exact_and_changed_items_are_found_and_nothing_else(spark):
    docs, items, want = texts()
    df = spark.createDataFrame([*docs, (None, None), (2000, ""), (1001, docs[301][1])], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (900, None), (901, "Too short"), (None, items[0][1])], "item_id long, text string")
    got = decontaminate.leaks(df, bench, latent=LATENT)
    pairs = [(r.doc_id, r.item_id) for r in got.collect()]
    assert len(want & set(pairs)) >= 0.95 * len(want)
    assert all(d >= 1000 for d, _ in pairs)
    # In blocks the result is the same.
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, latent=LATENT, block=7).collect()) == sorted(pairs)


def test_svd_finds_the_leading_space(spark):
    docs, _, _ = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = decontaminate._table(df, "doc_id", "text")
    model = decontaminate.fit(table, decontaminate.Latent(buckets=256, skip=0, rank=8, extra=200))
    terms, first = decontaminate.terms_of([t.encode() for _, t in docs])
    latent = decontaminate.Latent(buckets=256)
    row, bucket, count, n = decontaminate._rows(terms, first, latent)
    seen = np.bincount(bucket, minlength=256)
    idf = np.log((1 + n) / (1 + seen))
    dense = np.zeros((n, 256))
    dense[row, bucket] = decontaminate._weights(row, bucket, count, n, idf)
    exact = np.linalg.svd(dense, compute_uv=False)[:8]
    # Noise has a flat spectrum, which takes a wide block.
    assert np.allclose(model.values, exact, rtol=0.02)


def test_common_subsequence_and_nothing_to_do(spark):
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == table[-1, -1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(empty, bench, latent=LATENT).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontaminate.leaks(one, bench.limit(0), latent=LATENT).count() == 0


def test_an_item_in_a_third_of_the_documents_is_found(spark):
    rng = random.Random(5)
    lexicon = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("a", "e", "ion", "ur") for c in ("", "x", "la", "mes", "tik", "vor")]
    lexicon += [f"w{k}" for k in range(3000)]
    say = lambda n: " ".join(rng.choice(lexicon[: 60 if rng.random() < 0.5 else len(lexicon)]) for _ in range(n))
    items = [(k, say(30) + ". " + say(6)) for k in range(12)]
    docs, want = [], set()
    for k in range(600):
        words = say(rng.randrange(60, 260)).split()
        at = rng.randrange(len(words))
        if k % 3 == 0:
            words[at:at] = items[0][1].split()
            want.add((k, 0))
        docs.append((k, " ".join(words)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.common == 1 for r in got)


def test_paraphrases_down_to_the_rule_are_found_with_production_parameters(spark):
    assert (decontaminate.Latent().rank, decontaminate.Rules().cosine) == (64, 0.55)
    docs, items, _ = texts()
    rng, want = random.Random(7), set()
    for k in range(120):
        item, body = rng.choice(items)
        words = body.split()
        n, answer = len(words), min(decontaminate.answer_words(body.encode()), len(words))
        kept = set(rng.sample(range(n - answer, n), -(-answer // 2)))
        need = -(-n * (6 + k % 4) // 10)
        kept |= set(rng.sample([i for i in range(n) if i not in kept], max(0, need - len(kept))))
        host = docs[rng.randrange(300)][1].split()
        at = rng.randrange(len(host) + 1)
        docs.append((5000 + k, " ".join([*host[:at], *(w if i in kept else f"other{rng.randrange(500)}" for i, w in enumerate(words)), *host[at:]])))
        want.add((5000 + k, item))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert want <= {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}


def test_very_long_texts_and_columns_of_any_name(spark):
    docs, items, _ = texts()
    filler = [t for _, t in docs[:300]]
    body = " ".join(filler * 8).split()
    long = " ".join([*body, *items[3][1].split(), *body])
    kind = "doc_id long, text string, key string, terms string, item string, item_id string, start string, words string, common string"
    rows = [(k, t, *["x"] * 7) for k, t in [*docs[:300], (5000, long), (5001, " ".join(body))]]
    bench = spark.createDataFrame([(k, t, "x", "x", "x") for k, t in items], "item_id long, text string, t string, key string, words string")
    got = decontaminate.leaks(spark.createDataFrame(rows, kind), bench, latent=LATENT)
    assert got.columns == ["doc_id", "item_id", "start", "words", "common"]
    found = got.collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(5000, items[3][0])}
    assert all(len(body) - 60 <= r.start <= len(body) + 60 for r in found)


def test_shared_words_of_regions_are_exact():
    """Words in common, each as often as in the item, in one call for all regions, against counting; more items than a group."""
    rng = np.random.default_rng(3)
    pool = rng.integers(-(2**31), 2**31, 12).astype(np.int32)
    items = [(k, rng.choice(pool, rng.integers(5, 12)), 4) for k in range(20)]
    runs = decontaminate._Runs(items, np.full(20, 8), 0.6)
    terms = rng.choice(np.append(pool, rng.integers(-(2**31), 2**31, 12).astype(np.int32)), 300)
    item = np.sort(rng.integers(0, 20, 500))
    low = rng.integers(0, 300, 500)
    high = np.minimum(low + rng.integers(0, 20, 500), 300)
    brute = []
    for i, x, y in zip(item, low, high):
        brute.append((Counter(terms[x:y].tolist()) & Counter(items[i][1].tolist())).total())
    brute = np.array(brute)
    for group in (4, 256):
        use, shared = runs.enough(terms, item, low, high, group)
        assert (use == (brute >= runs.least[item])).all() and use.any() and not use.all()
        assert (shared[use] == brute[use]).all()


def test_sums_and_products_in_pieces():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((50, 6)).astype(np.float32)
    for n in (0, 1, 16, 100):
        at = rng.integers(0, 50, n)
        whole = np.concatenate((np.zeros((1, 6)), np.cumsum(vectors[at], axis=0)))
        assert np.allclose(decontaminate._sums(vectors, at), whole, atol=1e-4)
    row = np.sort(rng.integers(0, 30, 400))
    bucket, value = rng.integers(0, 50, 400), rng.random(400).astype(np.float32)
    dense = np.zeros((30, 50), np.float32)
    np.add.at(dense, (row, bucket), value)
    for cells in (1, 64, 4096):
        out, at = decontaminate._times(row, bucket, value, vectors, cells)
        assert np.allclose(out, (dense @ vectors)[np.unique(row)], atol=1e-4) and (np.unique(row)[at] == row).all()


def test_counts_of_ranges_in_pieces():
    rng = np.random.default_rng(6)
    has = (rng.random((9, 5)) < 0.5).astype(np.uint8)
    has[0] = 0
    rows = rng.integers(0, 9, 333)
    low = rng.integers(0, 333, 400)
    high, column = np.minimum(low + rng.integers(0, 90, 400), 333), rng.integers(0, 5, 400)
    want = [has[rows[x:y], c].sum() for x, y, c in zip(low, high, column)]
    for most in (32, 48, 1 << 15):
        assert (decontaminate._counts(has, rows, low, high, column, most=most) == want).all()


def test_words_are_bytes_and_portions_are_whole(spark):
    """Spark hands words on and does not take them one by one."""
    df = spark.createDataFrame([(1, "b a, c"), (None, None), (2, ""), (3, "a b " * 50)], "doc_id long, text string")
    table = decontaminate._table(df.coalesce(1), "doc_id", "text")
    assert dict(table.dtypes)["terms"] == "binary"
    batch = table.toArrow().combine_chunks().to_batches()[0]
    got = [(rows.column(0).to_pylist(), terms, first) for rows, terms, first in decontaminate._portions(iter([batch]), 4)]
    assert sum((keys for keys, _, _ in got), []) == [1, None, 2, 3]
    terms, first = decontaminate.terms_of([b"b a, c", None, b"", b"a b " * 50])
    assert (np.concatenate([t for _, t, _ in got]) == terms).all() and [int(f[-1]) for _, _, f in got] == [3, 100]
