"""Substring dedup: words covered by a window of ``window`` words that starts anywhere else too.

Level-wise doubling. Lengths double from a quarter of the window over its half to the window itself, and only what is
repeated at one length is looked at at the next. On the two short lengths a window stands for itself by its least run
of that length (by hash, leftmost of equals): equal windows choose the same run at the same place, so a window that
is repeated has a repeated run at each length, and a few runs in a hundred words are enough to shuffle. On the full
length neighbouring windows with the same run form a block. A run whose blocks are all alike needs no look at single
windows; the others are taken apart into windows, which are then compared one by one.

Copies of a whole word sequence take part once. Places are compared by minimum and maximum, which Spark merges before the
shuffle, so a passage that a third of all documents share is one row per task. Windows are told apart by 128 bits
of two independent hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from .shared import narrow_side, written
from .words import Words, as_bytes, chunks, lists, mix, signed

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def levels(window: int) -> tuple[int, int]:
    return -(-window // 4), -(-window // 2)


def _choices(words: Words, length: int, window: int, family: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the start of the run that each chooses, and the hashes of runs by start."""
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    runs = words.hashes(words.starts[: n - length + 1], words.ends[length - 1 :], family)
    at = np.arange(n - window + 1)
    chosen = at + sliding_window_view(runs, window - length + 1).argmin(axis=1)
    inside = words.text_of[at] == words.text_of[at + window - 1]
    return at[inside], chosen[inside], runs


def _place(seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(seq * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64))


def _sequences(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Per row: key, raw (hash of the text), seq, n_words, and hash and place of each chosen short run."""
    length = levels(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for part in chunks(texts):
                words = Words(texts[part])
                digests = [hashlib.sha256(t).digest() for t in words.texts]
                seq = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)[:, 0]
                _, chosen, runs = _choices(words, length, window, 0)
                chosen = np.unique(chosen)
                of = words.text_of[chosen]
                first = np.searchsorted(of, np.arange(len(words.texts) + 1))
                place = _place(seq[of], chosen - words.first[of])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        batch.column(1)[part.start : part.stop],
                        pa.array(digests, pa.binary()),
                        pa.array(words.counts.astype(np.int64)),
                        lists(signed(runs[chosen]), first, pa.int64()),
                        lists((chosen - words.first[of]).astype(np.int32), first, pa.int32()),
                        lists(signed(place), first, pa.int64()),
                    ],
                    ["key", "raw", "seq", "n_words", "runs", "at", "places"],
                )

    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("raw"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, f"key {kind}, raw long, seq binary, n_words long, runs array<long>, at array<int>, places array<long>")


def _repeated(rows: DataFrame, *by: str) -> DataFrame:
    """Values of ``by`` that stand at two places at least."""
    return rows.groupBy(*by).agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low <> high").select(*by)


def _blocks(carriers: DataFrame, window: int) -> DataFrame:
    """Blocks of windows whose short run is repeated, by their run of half the window."""
    short, half = levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            live = batch.column(2).to_pylist()
            for part in chunks(texts):
                words = Words(texts[part])
                good = np.zeros(len(words), bool)
                for i, mine in enumerate(live[part]):
                    good[words.first[i] + np.array(mine, np.int64)] = True
                at, chosen, _ = _choices(words, short, window, 0)
                _, halves, runs = _choices(words, half, window, 1)
                kept = good[chosen]
                at, halves = at[kept], halves[kept]
                if not len(at):
                    continue
                new = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(halves) != 0) | (np.diff(words.text_of[at]) != 0))))
                begin, end = at[new], at[np.concatenate((new[1:], [len(at)])) - 1]
                of = words.text_of[begin]
                span = words.hashes(words.starts[begin], words.ends[end + window - 1])
                anchor = halves[new]
                shape = mix(span ^ mix(((anchor - begin) * (2 * window) + (end - begin)).astype(np.uint64)))
                seq = np.frombuffer(b"".join(s[:8] for s in seqs[part]), "<u8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([seqs[part.start + i] for i in of], pa.binary()),
                        pa.array(signed(runs[anchor])),
                        pa.array(signed(shape)),
                        pa.array(signed(_place(seq[of], anchor - words.first[of]))),
                        pa.array((begin - words.first[of]).astype(np.int32)),
                        pa.array((end - begin + 1).astype(np.int32)),
                        pa.array((anchor - begin).astype(np.int32)),
                        lists(signed(words.hashes(words.starts[at], words.ends[at + window - 1])), np.concatenate((new, [len(at)])), pa.int64()),
                    ],
                    ["seq", "run", "shape", "place", "begin", "n", "back", "windows"],
                )

    return carriers.select("seq", "text", "at").mapInArrow(run, "seq binary, run long, shape long, place long, begin int, n int, back int, windows array<long>")


def _covered(carriers: DataFrame, window: int) -> DataFrame:
    """Per sequence: number of removed words, spans (start, length) of them, and the SHA-256 of what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, texts, found = batch.column(0), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            removed, spans, kept = [], [], []
            for t, ranges in zip(texts, found):
                words = t.split()
                edge = np.zeros(len(words) + 1, np.int64)
                start = np.array([r["begin"] for r in ranges], np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + np.array([r["size"] for r in ranges], np.int64), -1)
                gone = np.concatenate(([0], np.cumsum(edge[:-1]) > 0, [0])).astype(np.int8)
                turn = np.flatnonzero(np.diff(gone))
                starts, ends = turn[::2].tolist(), turn[1::2].tolist()
                spans.append([{"start": a, "length": b - a} for a, b in zip(starts, ends)])
                removed.append(sum(ends) - sum(starts))
                rest = [words[a:b] for a, b in zip([0, *ends], [*starts, len(words)])]
                kept.append(hashlib.sha256(b" ".join([w for part in rest for w in part])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [seqs, pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(kept, pa.string())],
                ["seq", "n_removed", "removed", "kept_sha256"],
            )

    return carriers.select("seq", "text", "ranges").mapInArrow(run, "seq binary, n_removed long, removed array<struct<start:long,length:long>>, kept_sha256 string")


def repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """(key, n_words, n_removed, removed, kept_sha256) for every row of ``docs``.

    ``removed`` are spans (start, length) in words; kept words are joined by one space. Null and empty texts have no
    words. A text of fewer than ``window`` words loses none. Repeated rows are copies of each other and lose all words of any
    window. Null keys are kept; other columns are not looked at.
    """
    rows = written(_sequences(docs, key, text, window), "sequences")
    copies = rows.groupBy("seq").agg(F.count("*").alias("copies"), F.min("raw").alias("raw"))
    runs = rows.select("seq", F.explode(F.arrays_zip("runs", "at", "places")).alias("r")).select("seq", "r.runs", "r.at", F.col("r.places").alias("place"))
    live = narrow_side(written(_repeated(runs, "runs"), "level"), 8)
    # One text of each sequence that has a repeated run, with the places of its runs.
    found = runs.join(live, "runs").groupBy("seq").agg(F.collect_set("at").alias("at"))
    wanted = written(found.join(copies, "seq"), "wanted")
    thin = narrow_side(wanted.select("raw").distinct(), 8)
    texts = docs.select(F.xxhash64(F.coalesce(text, F.lit(""))).alias("raw"), F.col(text).cast("string").alias("text")).join(thin, "raw", "left_semi").groupBy("raw").agg(F.first("text").alias("text"))
    carriers = written(wanted.join(texts, "raw").select("seq", "at", "text", "copies"), "carriers")
    blocks = written(_blocks(carriers, window), "blocks")
    level = blocks.groupBy("run").agg(*[f(c).alias(f"{n}_{c}") for c in ("place", "shape") for n, f in (("min", F.min), ("max", F.max))])
    verdict = narrow_side(written(level.where("min_place <> max_place").select("run", (F.col("min_shape") == F.col("max_shape")).alias("alike")), "level"), 16)
    alive = blocks.join(verdict, "run")
    whole = alive.where("alike").select("seq", "begin", (F.col("n") + (window - 1)).alias("size"))
    single = alive.where("not alike").select("seq", "run", "place", "begin", "back", F.posexplode("windows").alias("i", "window"))
    single = single.select("seq", "run", "window", (F.col("back") - F.col("i")).alias("offset"), "place", (F.col("begin") + F.col("i")).alias("begin"))
    # Written, so that a window which very many texts share is a join that adaptive execution can split.
    twice = written(_repeated(single, "run", "offset", "window"), "twice")
    parts = single.join(twice, ["run", "offset", "window"]).select("seq", "begin", F.lit(window).alias("size"))
    ranges = whole.unionByName(parts).groupBy("seq").agg(F.collect_list(F.struct("begin", "size")).alias("ranges"))
    lost = written(_covered(carriers.where("copies = 1").join(ranges, "seq"), window), "covered")
    all_gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    out = rows.select("key", "seq", "n_words").join(copies.select("seq", "copies"), "seq").join(lost, "seq", "left")
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length")))).otherwise(F.coalesce("removed", F.array().cast("array<struct<start:long,length:long>>"))).alias("removed"),
        F.when(all_gone, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("seq")))).alias("kept_sha256"),
    )


def kept_text(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with removed words cut out of the text; rows match by ``key``, which must be unique. Untouched texts stay."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(batch.schema.get_field_index(text)), batch.column(batch.num_columns - 1).to_pylist()
            out = []
            for t, spans in zip(texts.to_pylist(), gone):
                if t is not None and spans:
                    words, parts, at = t.encode().split(), [], 0
                    for s in spans:
                        parts += words[at : s["start"]]
                        at = s["start"] + s["length"]
                    t = b" ".join(parts + words[at:]).decode()
                out.append(t)
            arrays = list(batch.columns[:-1])
            arrays[batch.schema.get_field_index(text)] = pa.array(out, texts.type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1])

    both = docs.join(found.select(key, "removed"), key, "left").select(*docs.columns, "removed")
    return both.mapInArrow(cut, docs.schema)
