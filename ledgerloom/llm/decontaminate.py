"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to 32 bits once and kept as a table. Passages of equal length over all documents give TF-IDF rows over a fixed
number of word buckets; a randomised SVD of that matrix is computed by passes over the table: each task adds up its part
of A'(AX) for a random block X, the sums meet bucket by bucket, and only matrices of a fixed size reach the driver. The first
components hold what many texts share and are left out. Every word then has a vector, weighted down the more passages hold it,
and a window of words the sum of theirs, so windows of any length cost the same. Windows as long as an item are compared with it by cosine.
What many documents share has little weight there, so windows that hold a pair of an item's words are candidates too. Candidates
must share a long common subsequence with the item and contain its answer, the end of the item.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import written
from .words import Words, as_bytes, chunks, packed, unpacked

#: Punctuation ends words, A-Z are a-z.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\"()", bytes(range(97, 123)) + b" " * 9)


@dataclass(frozen=True)
class Latent:
    buckets: int = 1 << 14
    passage: int = 64
    skip: int = 8
    rank: int = 64
    common: float = 0.01  # part of the passages at which a word's weight is halved
    extra: int = 8
    seed: int = 0

    @property
    def width(self) -> int:
        return self.skip + self.rank + self.extra


@dataclass(frozen=True)
class Rules:
    """A leak shares ``common`` of the item's words in order and ``answer`` of the words of its end."""

    cosine: float = 0.55
    common: float = 0.6
    answer: float = 0.5
    least_words: int = 5


def terms_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all words, and where each text begins."""
    words = Words([t.translate(FOLD) if t else None for t in texts])
    return (words.hashes(words.starts, words.ends) >> np.uint64(32)).astype(np.uint32).view(np.int32), words.first


def _table(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for part in chunks(texts):
                made, first = terms_of(texts[part])
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], packed(made, first)], ["key", "terms"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, terms binary")


def _portions(batches: Iterator[pa.RecordBatch], words: int = 1 << 14) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in portions of about ``words`` words, which a processor's cache holds: the rows, their words, and where each begins."""
    for batch in batches:
        first, flat = unpacked(batch.column(batch.num_columns - 1), np.int32)
        begin = 0
        while begin < batch.num_rows:
            stop = max(begin + 1, int(np.searchsorted(first, first[begin] + words, "right")) - 1)
            yield batch.slice(begin, stop - begin), flat[first[begin] : first[stop]], first[begin : stop + 1] - first[begin]
            begin = stop


def _bucket(terms: np.ndarray, latent: Latent) -> np.ndarray:
    return (terms.view(np.uint32) % np.uint32(latent.buckets)).astype(np.int64)


def _rows(terms: np.ndarray, first: np.ndarray, latent: Latent) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Passages as (row, bucket, count), and the number of passages."""
    size = np.diff(first)
    of = np.repeat(np.arange(len(size)), size)
    many = -(-size // latent.passage)
    row = np.repeat(np.cumsum(many) - many, size) + (np.arange(len(terms)) - first[of]) // latent.passage
    cell, count = np.unique(row * latent.buckets + _bucket(terms, latent), return_counts=True)
    return cell // latent.buckets, cell % latent.buckets, count, int(many.sum())


def _weights(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    return (value / np.maximum(norm[row], 1e-12)).astype(np.float32)


def _times(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, x: np.ndarray, cells: int = 1 << 11) -> tuple[np.ndarray, np.ndarray]:
    """Rows of A that are not empty, times ``x``; rows come in order. Rows of like length, about ``cells`` cells, are multiplied at a time."""
    first = np.flatnonzero(np.concatenate(([True], np.diff(row) != 0)))
    size = np.diff(np.append(first, len(row)))
    out = np.empty((len(first), x.shape[1]), x.dtype)
    order = np.argsort(size, kind="stable")
    upto = np.concatenate(([0], np.cumsum(size[order])))
    begin = 0
    while begin < len(first):
        stop = max(begin + 1, int(np.searchsorted(upto, upto[begin] + cells, "right")) - 1)
        some = order[begin:stop]
        # Shorter rows are filled up with zeros.
        place = np.arange(size[some[-1]])
        at = np.minimum(first[some][:, None] + place, len(row) - 1)
        weight = value[at] * (place < size[some][:, None])
        out[some] = np.matmul(weight[:, None, :], x.take(bucket[at], axis=0))[:, 0]
        begin = stop
    return out, np.repeat(np.arange(len(first)), size)


def _summed(table: DataFrame, each, parts: int, width: int, words: int = 1 << 14) -> np.ndarray:
    """Sum over all tasks of a matrix of fixed size, added up in ``parts`` blocks of rows; each task sends it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, terms, first in _portions(batches, words):
            if len(terms):
                total = each(terms, first, total)
        if total is not None:
            for k, block in enumerate(np.array_split(total, parts)):
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "block": pa.array([block.astype(np.float32).tobytes()], pa.binary())})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                here = np.frombuffer(block, np.float32).astype(float)
                total[k] = total[k] + here if k in total else here
        for k, v in total.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "block": pa.array([v.tobytes()], pa.binary())})

    sent = table.select("terms").mapInArrow(run, "part int, block binary")
    rows = written(sent.repartition(parts, "part").mapInArrow(fold, "part int, block binary"), "summed", "snappy").orderBy("part").toArrow()
    if not rows.num_rows:
        return np.zeros((0, width))
    return np.concatenate([np.frombuffer(b.as_py(), float) for b in rows.column("block")]).reshape(-1, width)


@dataclass
class Model:
    latent: Latent
    vectors: np.ndarray  # (buckets, rank), weighted by rarity
    values: np.ndarray


def fit(table: DataFrame, latent: Latent = Latent()) -> Model | None:
    """Randomised SVD of the TF-IDF passages of ``table`` (terms); None if there are no words."""
    width, buckets = latent.width, latent.buckets

    def seen(terms, first, total):
        row, bucket, _, n = _rows(terms, first, latent)
        here = np.append(np.bincount(bucket, minlength=buckets), n).astype(float)[:, None]
        return here if total is None else total + here

    counts = _summed(table, seen, 8, 1)
    if not len(counts):
        return None
    n = counts[-1, 0]
    idf = np.log((1 + n) / (1 + counts[:-1, 0]))
    start = np.random.default_rng(latent.seed).standard_normal((buckets, width)).astype(np.float32)

    def product(terms, first, total):
        row, bucket, count, n = _rows(terms, first, latent)
        value = _weights(row, bucket, count, n, idf)
        y, at = _times(row, bucket, value, start)
        # By bucket: rows of the transposed matrix.
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        total = np.zeros((buckets, width), np.float32) if total is None else total
        sorted_ = bucket[order]
        here = sorted_[np.concatenate(([True], np.diff(sorted_) != 0))]
        total[here] += _times(sorted_, at[order], value[order], y)[0]
        return total

    basis = np.linalg.qr(_summed(table, product, 64, width, 1 << 17))[0].astype(np.float32)

    def gram(terms, first, total):
        row, bucket, count, n = _rows(terms, first, latent)
        y, _ = _times(row, bucket, _weights(row, bucket, count, n, idf), basis)
        return y.T @ y if total is None else total + y.T @ y

    values, turn = np.linalg.eigh(_summed(table, gram, 1, width))
    use = np.arange(width)[::-1][latent.skip : latent.skip + latent.rank]
    weight = idf * latent.common / (latent.common + counts[:-1, 0] / max(n, 1))
    vectors = (basis @ turn[:, use].astype(np.float32)) * weight[:, None].astype(np.float32)
    return Model(latent, vectors.astype(np.float32), np.sqrt(np.maximum(values[use], 0)))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of a Python integer."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b.tolist():
        if y in where:
            hit = row & where[y]
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def answer_words(text: bytes, least: int = 4) -> int:
    """Words of the item's last sentence or line, ``least`` if it is shorter: what an answer to the item would be."""
    parts = [p for p in text.replace(b"\n", b".").replace(b"!", b".").replace(b"?", b".").split(b".") if p.translate(FOLD).split()]
    return max(least, len(parts[-1].translate(FOLD).split())) if parts else 0


def _starts(first: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of windows of ``size`` words, ``step`` apart, that reach both ends of each text; short texts are one."""
    n = np.diff(first)
    many = np.where(n > size, -(-(n - size) // step) + 1, (n > 0).astype(np.int64))
    of = np.repeat(np.arange(len(n)), many)
    k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.minimum(k * step, np.maximum(n[of] - size, 0)) + first[of]
    return begin, np.minimum(begin + size, first[of + 1])


def _pairs(terms: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of words of one text that stand next to each other, then those with one word between, and the place of their first words."""
    of, wide = np.repeat(np.arange(len(first) - 1), np.diff(first)), terms.view(np.uint32).astype(np.uint64)
    for apart in (1, 2):
        at = np.flatnonzero(of[:-apart] == of[apart:])
        yield (wide[at] << np.uint64(32)) | wide[at + apart], at


def _sums(vectors: np.ndarray, at: np.ndarray, run: int = 16) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... of ``vectors[at]``: inside short runs, of whole runs, and both together."""
    many = -(-len(at) // run)
    out = np.zeros((1 + many * run, vectors.shape[1]), np.float32)
    out[1 : len(at) + 1] = vectors.take(at, axis=0)
    runs = out[1:].reshape(many, run, vectors.shape[1])
    for k in range(1, run):
        runs[:, k] += runs[:, k - 1]
    runs[1:] += np.cumsum(runs[:-1, -1], axis=0)[:, None]
    return out[: len(at) + 1]


def _distinct(x: np.ndarray) -> np.ndarray:
    """Different values in order, by sorting alone."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def _counts(has: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, column: np.ndarray, run: int = 16, most: int = 1 << 15) -> np.ndarray:
    """How many of ``has[rows[low:high], column]`` are set, for many ranges: by sums inside short runs and of whole runs, in pieces of ``most`` rows."""
    out, longest = np.zeros(len(low), np.int64), int((high - low).max(initial=0))
    order = np.argsort(low, kind="stable") if len(rows) > most else np.arange(len(low))
    starts = low[order] if len(rows) > most else None
    for begin in range(0, len(rows), most):
        # Ranges that reach into this piece.
        part = order if starts is None else order[slice(*np.searchsorted(starts, (begin - longest, begin + most)))]
        here = rows[begin : begin + most]
        many = -(-len(here) // run)
        inside = np.zeros((1 + many * run, has.shape[1]), np.uint8)
        has.take(here, axis=0, out=inside[1 : len(here) + 1], mode="clip")
        runs = inside[1:].reshape(many, run, -1)
        for k in range(1, run):
            runs[:, k] += runs[:, k - 1]
        whole = np.zeros((many + 1, has.shape[1]), np.int32)
        np.cumsum(runs[:, -1], axis=0, out=whole[1:])
        upto = lambda at: inside[at, column[part]] + whole[np.maximum(at - 1, 0) // run, column[part]]
        out[part] += upto(np.clip(high[part] - begin, 0, len(here))) - upto(np.clip(low[part] - begin, 0, len(here)))
    return out


class _Runs:
    """Windows that share two words with an item in the item's order, at most one word apart in each, however common these words are.

    Of the words that a leak keeps in order, two are neighbours in the item or have one word between them, since at least 0.6 of them
    are kept. So a leak has such a window unless every such pair is parted by two or more foreign words.
    """

    def __init__(self, items: list[tuple], sizes: np.ndarray, least: float):
        first = np.concatenate(([0], np.cumsum([len(t) for _, t, _ in items])))
        terms = np.concatenate([t for _, t, _ in items])
        of = np.repeat(np.arange(len(items)), np.diff(first))
        made, at = (np.concatenate(x) for x in zip(*_pairs(terms, first)))
        order = np.argsort(made, kind="stable")
        at = at[order]
        self.pairs, self.item, self.offset = made[order], of[at], at - first[of[at]]
        # Each word of each item once.
        self.cells, self.times = np.unique((terms.view(np.uint32).astype(np.uint64) << np.uint64(20)) | of.astype(np.uint64), return_counts=True)
        self.words, self.holder = self.cells >> np.uint64(20), (self.cells & np.uint64((1 << 20) - 1)).astype(np.int64)
        self.pair_table, self.word_table = self._table(self.pairs), self._table(self.words)
        self.known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.sizes, self.least = sizes, np.ceil(least * np.diff(first)).astype(np.int64)

    def near(self, terms: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and begins of windows that hold a pair, in order."""
        item, begin = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for made, at in _pairs(terms, first):
            known, low, many = self._found(self.pairs, self.pair_table, made)
            at = at[known]
            hit = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            item.append(self.item[hit])
            begin.append(np.repeat(at, many) - self.offset[hit])
            at = np.repeat(at, many)
            text = np.searchsorted(first, at, "right") - 1
            step, head = np.maximum(1, self.sizes[item[-1]] // 4), first[text]
            last = np.maximum(first[text + 1] - head - self.sizes[item[-1]], 0)
            begin[-1] = head + np.clip((begin[-1] - head + step // 2) // step * step, 0, last)
        shift = len(terms).bit_length()
        cell = _distinct((np.concatenate(item) << shift) + np.concatenate(begin))
        return cell >> shift, cell & ((1 << shift) - 1)

    def enough(self, terms: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, group: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Which of some regions share as many words with the item as a leak does, each word as often as in the item at most, and how
        many they share; items come in order."""
        out, shared = np.zeros(len(item), bool), np.zeros(len(item), np.int64)
        held, word, _ = self._found(self.words, self.word_table, terms.view(np.uint32).astype(np.uint64))
        # Places count among the words that any item has.
        before = np.zeros(len(terms) + 1, np.int64)
        before[held + 1] = 1
        np.cumsum(before, out=before)
        low, high = before[low], before[high]
        wide_word = len(self.words).bit_length()
        for k in range(0, int(item.max(initial=-1)) + 1, group):
            here = np.arange(*np.searchsorted(item, (k, k + group)))
            here = here[high[here] - low[here] >= self.least[item[here]]]
            if not len(here):
                continue
            rows, has = self._holders(k, group)
            size = _counts(has, rows[word], low[here], high[here], item[here] - k)
            use = here[size >= self.least[item[here]]]
            # The words of these regions that their item has, and how often each is there.
            size = high[use] - low[use]
            at = word[np.repeat(low[use] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            region = np.repeat(np.arange(len(use)), size)
            mine = has[rows[at], item[use[region]] - k] > 0
            pair = np.sort((region[mine] << wide_word) | at[mine])
            new = np.flatnonzero(np.diff(pair, prepend=-1))
            pair, n = pair[new], np.diff(np.append(new, len(pair)))
            region, more = pair >> wide_word, np.flatnonzero(n > 1)
            asked = (self.words[pair[more] & ((1 << wide_word) - 1)] << np.uint64(20)) | item[use[region[more]]].astype(np.uint64)
            n[more] = np.minimum(n[more], self.times[self.cells.searchsorted(asked)])
            total = np.bincount(region, n, minlength=len(use)).astype(np.int64)
            good = total >= self.least[item[use]]
            out[use[good]], shared[use[good]] = True, total[good]
        return out, shared

    def _holders(self, k: int, group: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``group`` items from ``k`` on have which words: a row for each of their words, row 0 for all others, and the row of the
        word that begins at a place of ``words``."""
        if (k, group) not in self.known:
            at = np.flatnonzero((self.holder >= k) & (self.holder < k + group))
            words, row = np.unique(self.words[at], return_inverse=True)
            rows = np.zeros(len(self.words), np.int32)
            rows[self.words.searchsorted(words)] = np.arange(1, len(words) + 1)
            has = np.zeros((len(words) + 1, min(group, len(self.least) - k)), np.uint8)
            has[row + 1, self.holder[at] - k] = 1
            self.known[k, group] = rows, has
        return self.known[k, group]

    @staticmethod
    def _cells(asked: np.ndarray) -> np.ndarray:
        return (asked * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def _table(self, known: np.ndarray) -> np.ndarray:
        """Which cells of a table of fixed size hold a known number."""
        out = np.zeros(1 << 20, bool)
        out[self._cells(known)] = True
        return out

    def _found(self, known: np.ndarray, table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``asked`` of known numbers, and where these begin in ``known`` and how many they are."""
        at = np.flatnonzero(table[self._cells(asked)])
        low = known.searchsorted(asked[at], "left")
        hit = known[np.minimum(low, len(known) - 1)] == asked[at]
        at, low = at[hit], low[hit]
        return at, low, known.searchsorted(asked[at], "right") - low


def _search(table: DataFrame, model: Model, items: list[tuple], rules: Rules) -> DataFrame:
    """(key, item, start, words, common): leaks of some items, (number, terms, answer words)."""
    scales: dict[int, list[int]] = {}
    for k, (_, terms, _) in enumerate(items):
        scales.setdefault(max(2, round(1.2 ** round(np.log(len(terms)) / np.log(1.2)))), []).append(k)
    sizes = np.zeros(len(items), np.int64)
    for size, members in scales.items():
        sizes[members] = size
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    wanted = unit(np.stack([model.vectors[_bucket(t, model.latent)].sum(axis=0) for _, t, _ in items]))
    runs = _Runs(items, sizes, rules.common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, terms, first in _portions(batches):
            sums = _sums(model.vectors, _bucket(terms, model.latent))
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            some = [runs.near(terms, first)]
            for size, members in scales.items():
                begin, end = _starts(first, size, max(1, size // 4))
                for part in range(0, len(begin), 1 << 12):
                    b, e = begin[part : part + (1 << 12)], end[part : part + (1 << 12)]
                    made = sums.take(e, axis=0)
                    made -= sums.take(b, axis=0)
                    length = np.sqrt(np.einsum("nd,nd->n", made, made)) + 1e-12
                    w, m = divmod(np.flatnonzero(made @ wanted[members].T >= rules.cosine * length[:, None]), len(members))
                    some.append((np.array(members)[m], b[w]))
            shift = len(terms).bit_length()
            cell = _distinct(np.concatenate([(i << shift) + b for i, b in some]))
            which, b = cell >> shift, cell & ((1 << shift) - 1)
            of = np.searchsorted(first, b, "right") - 1
            size = sizes[which]
            low, high = np.maximum(first[of], b - size // 2), np.minimum(first[of + 1], np.minimum(b + size, first[of + 1]) + size // 2)
            # No subsequence is longer than the words in common, each as often as in the item.
            use, shared = runs.enough(terms, which, low, high)
            for t, item, x, y, most in zip(*(v[use].tolist() for v in (of, which, low, high, shared))):
                _, mine, answer = items[item]
                if best.get((t, item), (0, 0, -1))[2] >= most:
                    continue
                common = common_subsequence(mine, terms[x:y])
                if common < rules.common * len(mine) or common_subsequence(mine[-answer:], terms[x:y]) < rules.answer * min(answer, len(mine)):
                    continue
                if common > best.get((t, item), (0, 0, -1))[2]:
                    best[t, item] = int(x - first[t]), int(y - x), common
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array([t for t, _ in best], pa.int64())),
                        pa.array([items[i][0] for _, i in best], pa.int64()),
                        pa.array([v[0] for v in best.values()], pa.int64()),
                        pa.array([v[1] for v in best.values()], pa.int64()),
                        pa.array([v[2] / len(items[i][1]) for (_, i), v in best.items()], pa.float64()),
                    ],
                    ["key", "item", "start", "words", "common"],
                )

    kind = table.schema["key"].dataType.simpleString()
    return table.select("key", "terms").mapInArrow(run, f"key {kind}, item long, start long, words long, common double")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", latent: Latent = Latent(), rules: Rules = Rules(), block: int = 4096) -> DataFrame:
    """(key, item, start, words, common): documents with a passage that repeats or paraphrases a benchmark item.

    ``start`` and ``words`` give the searched region in words, ``common`` the part of the item's words found there in order. Items of fewer
    than ``least_words`` words, or null, match nothing; null and empty documents have no leaks. Items are taken in
    blocks, each in a pass over all documents. Repeated documents or items each give their rows; a null key is kept.
    Item numbers are whole numbers. Texts are searched whole, however long; other columns are not looked at, whatever their names.
    """
    table = written(_table(docs, key, text), "terms", plain=("terms",))
    model = fit(table, latent)
    kind = docs.schema[key].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"`{key}` {kind}, `{item}` long, start long, words long, common double")
    if model is None:
        return out
    found = []
    rows: list[tuple] = []

    def flush() -> None:
        if rows:
            found.append(written(_search(table, model, list(rows), rules), "leaks").toDF(key, item, "start", "words", "common"))
            rows.clear()

    for r in benchmark.where(f"`{item}` is not null and `{text}` is not null").select(item, F.col(text).cast("binary").alias("t")).toLocalIterator():
        body = bytes(r["t"])
        terms = terms_of([body])[0]
        if len(terms) >= rules.least_words:
            rows.append((int(r[item]), terms, answer_words(body)))
        if len(rows) == block:
            flush()
    flush()
    for one in found:
        out = out.unionByName(one)
    return out
