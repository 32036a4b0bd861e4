from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import packing
from ledgerloom.llm.vocabulary import RANKS, TOKENIZER


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_units_give_the_ids_of_whole_texts(ranks):
    rng = random.Random(1)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "it's we'll", "x \t y", "<|endoftext|>", "a <|endoftext|> b", "é" * 50, "😀 😀a", "a\x1c b"]
    texts += ["".join(rng.choice("ab 'é1#\n\t 日 ") for _ in range(rng.randrange(40))) for _ in range(1500)]
    encoder = packing.Encoder(TOKENIZER, ranks)
    for _ in range(2):
        assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def docs(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "word", "Ünder", "x1"]) for _ in range(rng.randrange(900)))) for i in range(150)]
    return rows + [(None, "null key"), (900, None), (901, ""), (7, rows[7][1]), (7, rows[7][1])]


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_pieces_and_places(spark, rule):
    rows = docs(spark)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, length string")
    got = packing.packed(df, TOKENIZER, capacity=packing.Capacity(tokens=256), rule=rule, ids=True).collect()
    encoder, want = packing.Encoder(TOKENIZER), []
    for key, text in rows:
        ids = np.frombuffer(encoder.whole(text or "") + b"\0\0\0\0", "<u4")
        cuts = [len(ids) - 256 * k for k in range((len(ids) - 1) // 256, -1, -1)]
        for k, (a, b) in enumerate(zip([0, *cuts], cuts)):
            want.append((key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    assert len(by) <= -(-sum(r.length for r in got) // 256) * 1.03 + 1


def test_every_capacity_holds():
    rng = np.random.default_rng(3)
    length = np.sort(rng.integers(1, 100, 2000))[::-1]
    sizes = np.stack([length, np.ones_like(length), length * length], axis=1)
    for limits in ([200, 3, 40000], [200, 50, 11000], [100, 50, 10000]):
        for rule in ("dot", "norm"):
            number = packing.best_fit(sizes, np.array(limits), np.array([1.0, 1.0, 1.0]), rule)
            for k in range(3):
                assert np.bincount(number, sizes[:, k]).max() <= limits[k]


def test_empty_table_and_too_large_piece(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(df, TOKENIZER).count() == 0
    with pytest.raises(Exception, match="larger than a sequence"):
        packing.pack(spark.createDataFrame([(5,)], "length long"), packing.Capacity(tokens=4)).count()
