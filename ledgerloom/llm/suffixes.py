"""Substring dedup by a suffix array over bytes: what a string of ``width`` bytes covers goes if that string starts earlier too.

Bucket-pointer refinement. Suffixes are put into buckets by their first bytes (q-grams, a quarter of the width long), and the
places of a bucket are refined by the identifiers of the bytes at later offsets, before and behind: the identifier of a refined
bucket follows from that of the bucket it came from and those of the offsets that are new. Refined buckets are refined in
turn, until ``width`` bytes are told apart. A bucket points to its earliest place, and a bucket with one place is done.

Not every suffix is sorted. A window stands by its least q-gram (leftmost of equals), and equal windows choose the same q-gram at
the same place, so a few suffixes in a hundred bytes fill the first buckets. Windows that are next to each other and chose the same
suffix form a block. Blocks of a bucket whose bytes are all equal need no refinement: all but the earliest lose all their
windows. Only where a bucket holds different blocks, the earliest of each kind is cut into sections, whose windows have more
bytes in common, and these into smaller ones down to single windows. A place is a byte of all texts put one after the other,
so earlier is smaller.

The texts that take part are written once in buckets by their SHA-256. Blocks and sections are a few numbers each; what needs bytes
again is sent to the texts, which stay where they are.

Copies of a text take part once. Minima and counts are merged before a shuffle, so a passage in a third of all documents is a
row per task. Identifiers are 64-bit hashes from two families, of the bytes that a bucket shares and of all bytes of a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .ranks import placed
from .shared import bucketed, narrow_side, written
from .words import Words, as_bytes, chunks, lists, mix, signed

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
PAIR = np.uint64(0x9E3779B97F4A7C15)


def first(width: int) -> int:
    """Length of the q-grams: a quarter of the window."""
    return -(-width // 4)


def sections(width: int) -> list[int]:
    """Windows to a section: all that can stand by one q-gram, a third, a twelfth, one."""
    span = width - first(width) + 1
    return sorted({span, -(-span // 3), -(-span // 12), 1}, reverse=True)


class Bytes(Words):
    """Texts byte by byte: every byte is a place of its own, and no run crosses the end of a text."""

    def __init__(self, texts: Sequence[bytes | None]):
        self.texts = [t or b"" for t in texts]
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.buffer = np.frombuffer(b"".join(self.texts), np.uint8)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.counts = sizes
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, at: np.ndarray) -> np.ndarray:
        """Text of each place."""
        return np.searchsorted(self.first, at, side="right") - 1

    def identifiers(self, length: int, family: int) -> np.ndarray:
        """Bucket identifier of every place that has ``length`` bytes behind it in the buffer."""
        at = np.arange(len(self.buffer) - length + 1)
        return self.hashes(at, at + length, family)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows, the q-gram that each stands by, and the identifiers of all q-grams."""
        q = first(width)
        if len(self.buffer) < width:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64)
        grams = self.identifiers(q, 0)
        chosen = _least(grams, width - q + 1)
        at = np.flatnonzero(_inside(self.first, len(self.buffer), width))
        return at, chosen[at], grams


def _inside(first: np.ndarray, size: int, width: int) -> np.ndarray:
    """Whether a window that starts at a byte ends in the same text."""
    edge = np.zeros(size + 1, np.int32)
    sizes = np.diff(first)
    np.add.at(edge, first[:-1][sizes >= width], 1)
    np.add.at(edge, (first[1:] - width + 1)[sizes >= width], -1)
    return np.cumsum(edge[:size]) > 0


#: Low bits of a packed identifier that hold its index.
INDEX = np.uint64((1 << 20) - 1)


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the least of ``span`` values from each place on, leftmost of equals; by the upper 44 bits.

    The least of a window is that of the rest of one aligned piece and of the start of the next.
    """
    out = np.empty(len(values) - span + 1, np.int64)
    for a in range(0, len(out), 1 << 18):
        part = values[a : a + (1 << 18) + span - 1]
        packed = np.full(-(-len(part) // span) * span, ~np.uint64(0))
        packed[: len(part)] = (part & ~INDEX) | np.arange(len(part), dtype=np.uint64)
        pieces = packed.reshape(-1, span)
        upto = np.minimum.accumulate(pieces, axis=1).ravel()
        rest = np.minimum.accumulate(pieces[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - span + 1
        out[a : a + n] = (np.minimum(rest[:n], upto[span - 1 : span - 1 + n]) & INDEX).astype(np.int64) + a
    return out


def _rows(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per row: key, row, seq (SHA-256), n_bytes, and identifier and place of each q-gram that a window stands by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for part in chunks(texts):
                data = Bytes(texts[part])
                _, chosen, grams = data.windows(width)
                chosen = chosen[np.concatenate(([True], np.diff(chosen) != 0))] if len(chosen) else chosen
                of = data.of(chosen)
                ends = np.searchsorted(of, np.arange(len(data.texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        batch.column(1)[part.start : part.stop],
                        pa.array([hashlib.sha256(t).digest() for t in data.texts], pa.binary()),
                        pa.array(data.counts),
                        lists(signed(grams[chosen]), ends, pa.int64()),
                        lists((chosen - data.first[of]).astype(np.int32), ends, pa.int32()),
                    ],
                    ["key", "row", "seq", "n_bytes", "grams", "at"],
                )

    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, f"key {kind}, row long, seq binary, n_bytes long, grams array<long>, at array<int>")


#: A block or section; ``form`` has the number of windows, how far the q-gram is behind the first of them, and ``low``, in 20 bits each.
LEVEL = "start long, place long, form long, core long, shape long"
PART = 20


def _level(start, place, n, high, low, core, shape) -> pa.RecordBatch:
    form = (n.astype(np.int64) << 2 * PART) | (high.astype(np.int64) << PART) | low.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (start, place, form, signed(core), signed(shape))], ["start", "place", "form", "core", "shape"])


def _shape(data: Bytes, begin: np.ndarray, n: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """Equal for equal bytes with the q-gram at the same place."""
    return mix(data.hashes(begin, begin + n + (width - 1), 1) ^ mix((high * (2 * width) + n).astype(np.uint64)))


def _blocks(texts: DataFrame, width: int) -> DataFrame:
    """Blocks of windows that stand by a q-gram which another place has too.

    ``place`` is that of the first window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, texts, live = batch.column(0).to_numpy(), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            for part in chunks(texts):
                data = Bytes(texts[part])
                at, chosen, grams = data.windows(width)
                good = np.zeros(len(data.buffer), bool)
                for i, mine in enumerate(live[part]):
                    good[data.first[i] + np.array(mine, np.int64)] = True
                kept = good[chosen]
                at, chosen = at[kept], chosen[kept]
                if not len(at):
                    continue
                new = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(chosen) != 0))))
                begin, n = at[new], np.diff(np.concatenate((new, [len(at)])))
                high, of = chosen[new] - begin, data.of(begin)
                start = starts[part][of]
                yield _level(start, start + begin - data.first[of], n, high, np.zeros(len(n)), grams[begin + high], _shape(data, begin, n, high, width))

    return texts.select("start", "text", "at").mapInArrow(run, LEVEL)


def _sections(texts: DataFrame, width: int, size: int, smaller: int) -> DataFrame:
    """Sections of ``smaller`` windows of the ``models`` (place, form, core) of each text, which are of ``size``, in refined buckets.

    A section holds the windows whose q-gram starts ``low`` to ``low + size - 1`` bytes behind them, as far as they are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, texts, column = batch.column(0).to_numpy(), as_bytes(batch.column(1)), batch.column(2)
            first = column.offsets.to_numpy().astype(np.int64) - column.offsets[0].as_py()
            every = [x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten()]
            for part in chunks(texts):
                data = Bytes(texts[part])
                place, form, core = (x[first[part.start] : first[part.stop]] for x in every)
                of = np.repeat(np.arange(part.stop - part.start), np.diff(first[part.start : part.stop + 1]))
                start, core = starts[part][of], core.view(np.uint64)
                n, high, low = form >> 2 * PART, (form >> PART) & ((1 << PART) - 1), form & ((1 << PART) - 1)
                at = data.first[of] + place - start + high
                for k in range(0, size, smaller):
                    down = low + k
                    up = np.minimum(down, low + size - 1) + min(smaller, size - k) - 1
                    top, bottom = np.minimum(high, up), np.maximum(high - n + 1, down)
                    rows = np.flatnonzero(top >= bottom)
                    if not len(rows):
                        continue
                    top, bottom, up_, down_, gram = top[rows], bottom[rows], up[rows], down[rows], at[rows]
                    # Bytes that all windows of the section share and those of the wider one did not: at offsets before and behind.
                    left = data.hashes(gram - down_, gram - low[rows], 0)
                    right = data.hashes(gram - low[rows] - (size - 1) + width, gram - up_ + width, 0)
                    refined = mix(mix(mix(core[rows] + down_.astype(np.uint64)) * PAIR + left) * PAIR + right)
                    begin, m = gram - top, top - bottom + 1
                    yield _level(start[rows], place[rows] + high[rows] - top, m, top, down_, refined, _shape(data, begin, m, top, width))

    return texts.select("start", "text", "models").mapInArrow(run, LEVEL)


SPANS = "array<struct<start:long,length:long>>"


def _covered(carriers: DataFrame, width: int) -> DataFrame:
    """Per text: removed spans of bytes and the SHA-256 of what is left. ``ranges``: first window and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = as_bytes(batch.column(1)), batch.column(2).to_pylist()
            removed, spans, kept = [], [], []
            for t, ranges in zip(texts, found):
                edge = np.zeros(len(t) + 1, np.int64)
                begin = np.array([r["begin"] for r in ranges], np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + np.array([r["n"] for r in ranges], np.int64) + (width - 1), -1)
                gone = np.concatenate(([0], np.cumsum(edge[:-1]) > 0, [0])).astype(np.int8)
                turn = np.flatnonzero(np.diff(gone))
                starts, ends = turn[::2].tolist(), turn[1::2].tolist()
                spans.append([{"start": a, "length": b - a} for a, b in zip(starts, ends)])
                removed.append(sum(ends) - sum(starts))
                left = hashlib.sha256()
                for a, b in zip([0, *ends], [*starts, len(t)]):
                    left.update(t[a:b])
                kept.append(left.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(kept, pa.string())],
                ["row", "n_removed", "removed", "kept_sha256"],
            )

    return carriers.select("row", "text", "ranges").mapInArrow(run, f"row long, n_removed long, removed {SPANS}, kept_sha256 string")


def _ranges(blocks: DataFrame, texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Windows that start earlier too: (seq, row, ranges). ``texts`` are in buckets by seq, ``wanted`` has the seq of a start."""
    sizes, rows, found = sections(width), blocks, []
    seq = wanted.select("start", "seq")
    for size, smaller in zip(sizes, [*sizes[1:], None]):
        # Rows of a kind are of one form, and the text of the earliest place is the earliest text.
        kinds = rows.groupBy("core", "shape").agg(F.min("place").alias("earliest"), F.min("start").alias("start"), F.min("form").alias("form"), F.count("*").alias("copies"))
        kinds = written(kinds, "kinds")
        twice = narrow_side(kinds.where("copies > 1").select("core", "shape", "earliest"), 32)
        found.append(rows.select("start", "place", "form", "core", "shape").join(twice, ["core", "shape"]).where("place > earliest"))
        if smaller is None:
            break
        # The earliest of each kind, where its bucket has other kinds: these may share some of its windows. Written before the join,
        # so that adaptive execution can split a bucket with many kinds.
        mixed = written(kinds.groupBy("core").agg(F.min("shape").alias("a"), F.max("shape").alias("b")).where("a <> b").select("core"), "mixed")
        models = kinds.join(narrow_side(mixed, 16), "core", "left_semi")
        models = models.groupBy("start").agg(F.collect_list(F.struct(F.col("earliest").alias("place"), "form", "core")).alias("models"))
        models = models.join(seq, "start").select("seq", "models")
        rows = written(_sections(texts.join(models, "seq"), width, size, smaller), "sections")
    n = F.shiftright("form", 2 * PART).cast("int").alias("n")
    hits = reduce(DataFrame.unionByName, [f.select("start", (F.col("place") - F.col("start")).cast("int").alias("begin"), n) for f in found])
    hits = hits.groupBy("start").agg(F.collect_list(F.struct("begin", "n")).alias("ranges"))
    return hits.join(wanted.select("start", "row", "seq"), "start").select("seq", "row", "ranges")


def _texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (seq and more) with one text of each."""
    whole = docs.select(F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)).alias("seq"), F.col(text).cast("string").alias("text"))
    whole = whole.join(narrow_side(wanted.select("seq"), 48), "seq", "left_semi").groupBy("seq").agg(F.first("text").alias("text"))
    return whole.join(wanted.hint("shuffle_hash"), "seq")


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 100) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, removed, kept_sha256) for every row of ``docs``.

    ``removed`` are spans (start, length) in bytes of the UTF-8 text. Earlier means a smaller key, null first; of different texts with
    one key that with the smaller SHA-256 comes first, and of repeated rows one stays whole. Null and empty texts have no
    bytes; a text of fewer than ``width`` bytes loses none. Other columns are not looked at.
    """
    rows = written(_rows(docs, key, text, width), "rows")
    one = rows.groupBy("seq").agg(F.min(F.struct("key", "row")).alias("head"), F.max("n_bytes").alias("n_bytes"))
    heads = written(one.select("seq", F.col("head.key").alias("key"), F.col("head.row").alias("row"), "n_bytes"), "heads")
    copies = rows.select("row").join(heads.select("row"), "row", "left_anti")
    # Each text once, so a q-gram that is counted twice has two places.
    grams = rows.select("row", "grams", "at").join(narrow_side(written(copies, "copies"), 16), "row", "left_anti").select("row", F.explode(F.arrays_zip("grams", "at")).alias("g"))
    grams = grams.select("row", F.col("g.grams").alias("gram"), F.col("g.at").alias("at"))
    buckets = grams.groupBy("gram").agg(F.count("*").alias("places")).where("places > 1").select("gram")
    live = narrow_side(written(buckets, "buckets"), 8)
    carried = grams.join(live, "gram", "left_semi").groupBy("row").agg(F.collect_list("at").alias("at"))
    starts = placed(heads, ["key", "seq"], F.col("n_bytes")).select("row", "seq", F.col("__before").alias("start"))
    wanted = written(carried.join(starts, "row"), "wanted")
    with bucketed(_texts(docs, text, wanted).select("seq", "start", "text", "at"), "seq", "texts") as texts:
        blocks = written(_blocks(texts, width), "blocks")
        ranges = _ranges(blocks, texts.select("seq", "start", "text"), wanted, width)
        lost = written(_covered(texts.select("seq", "text").join(ranges, "seq"), width), "covered")
    mine = heads.select("row", F.lit(True).alias("head"))
    out = rows.select("key", "row", "seq", "n_bytes").join(mine, "row", "left").join(lost, "row", "left")
    gone = F.col("head").isNull() & (F.col("n_bytes") >= width)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("length")))
    removed = F.when(gone, whole).otherwise(F.coalesce("removed", F.array().cast(SPANS)))
    return out.select(
        F.col("key").alias(key),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"),
        removed.alias("removed"),
        F.when(gone, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("seq")))).alias("kept_sha256"),
    )
