from __future__ import annotations

import hashlib
import random

import pytest

from ledgerloom.llm import catalog, suffixes


def brute(rows, width):
    """Rows in the order of (key, hash of the text); a string counts where it first starts."""
    data = [(k, (t or "").encode()) for k, t in rows]
    data.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1]).digest()))
    seen, out = set(), []
    for key, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - width + 1):
            if text[i : i + width] in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(text[i : i + width])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((key, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, width):
    found = suffixes.repeated_bytes(df, width=width).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("width", [5, 12, 100])
def test_equals_brute_force(spark, width):
    rng = random.Random(width)
    base = ["".join(rng.choice("abé \n") if rng.random() < 0.4 else chr(97 + rng.randrange(26)) for _ in range(600)) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(4)):
            source, at = rng.choice(base), rng.randrange(450)
            parts += [source[at : at + rng.randrange(3 * width)], "".join(rng.choice("xyz") for _ in range(rng.randrange(9)))]
        rows.append((i if i % 7 else 3, "".join(parts)))
    rows += [(None, None), (None, base[0][:200]), (5, ""), (6, rows[3][1]), (6, rows[3][1]), (6, rows[3][1]), (8, "a" * 900), (9, "ab" * 300), (2, "b" * 300)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, seq string, start int")
    assert got(df, width) == brute(rows, width)


def test_hot_passages_and_a_long_text(spark, conf):
    """A passage in most documents, in different texts, a near copy of a long text, and copies."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(1)

    def noise(n):
        return "".join(chr(97 + rng.randrange(26)) for _ in range(n))

    passage, long_text = noise(180), noise(60_000)
    rows = [(i, noise(30) + passage + noise(40)) for i in range(400)] + [(500 + i, "same " * 40) for i in range(200)]
    rows += [(900, long_text), (901, long_text[:30_000] + "#" + long_text[30_000:]), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 100) == brute(rows, 100)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string"), 100) == []


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, catalog.queries()["op13_bucket_pointer_dedup"](spark, folder).collect()), key=str) == brute(rows, 100)


def test_texts_are_dealt_out_once(spark, monkeypatch):
    """Beyond the bound of broadcasts only numbers are joined: one shuffle of texts, no bytes in blocks and sections."""
    rng = random.Random(7)
    base = "".join(chr(97 + rng.randrange(26)) for _ in range(2_000))
    rows = [(i, base[a : a + rng.randrange(100, 700)] + str(i) * 9 + base[: rng.randrange(90, 300)]) for i, a in enumerate(rng.choices(range(1500), k=60))]
    tables, dealt = {}, []
    written, texts = suffixes.written, suffixes._texts
    monkeypatch.setattr(suffixes, "narrow_side", lambda df, row_bytes: df)
    monkeypatch.setattr(suffixes, "written", lambda df, name: tables.setdefault(name, df.schema) and written(df, name))
    monkeypatch.setattr(suffixes, "_texts", lambda *a: dealt.append(a) or texts(*a))
    before = spark.catalog.listTables()
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 100) == brute(rows, 100)
    assert len(dealt) == 1
    assert {f.dataType.simpleString() for name in ("blocks", "sections") for f in tables[name]} == {"bigint"}
    assert spark.catalog.listTables() == before
