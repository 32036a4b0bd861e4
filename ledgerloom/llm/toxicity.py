"""Toxicity by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

Each word is read twice: as a hashed word, and as the mean of its hashed character runs, so that new forms of a known stem
are recognised. Two gated recurrent layers read a window of words, one from each end; attention pools their states
into one score. Windows overlap and cover every word; a text has the score of its worst window. The network is fitted on a
bounded sample of labelled texts, first on all windows of a text under the text's label, then on the worst window only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written
from .words import Words, as_bytes, chunks, mix

#: Words whose inputs a task remembers; then it starts anew.
REMEMBERED = 150_000


@dataclass(frozen=True)
class Shape:
    window: int = 32
    stride: int = 24
    hidden: int = 12
    word_buckets: int = 1 << 14
    char_buckets: int = 1 << 14
    word_size: int = 8
    char_size: int = 16


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _gathered(rows: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that belong to each of ``n`` places."""
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[place[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def readings(words: Sequence[bytes], word_buckets: int, char_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, and buckets of its runs of three and four bytes, ends marked, with their bounds."""
    marked = np.frombuffer(b"".join([b"^%b$" % w for w in words]) + b"\0\0\0", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(size) - size
    three = marked[:-3] | (marked[1:-2] << np.uint64(8)) | (marked[2:-1] << np.uint64(16))
    four = three | (marked[3:] << np.uint64(24)) | np.uint64(1 << 40)
    runs = []
    for n, code in ((3, three), (4, four)):
        many = np.maximum(size - n + 1, 1)
        runs.append((mix(code) % np.uint64(char_buckets), many))
    many = runs[0][1] + runs[1][1]
    bounds = np.concatenate(([0], np.cumsum(many)))
    chars = np.empty(bounds[-1], np.int64)
    for (code, n), shift in zip(runs, (np.zeros_like(many), runs[0][1])):
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        chars[np.repeat(bounds[:-1] + shift, n) + place] = code[np.repeat(first, n) + place]
    # A word's bucket: sum of its bytes, each weighted by an odd power.
    power = np.multiply.accumulate(np.full(int(size.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64))
    inside = np.arange(len(marked) - 3) - np.repeat(first, size)
    word = mix(np.add.reduceat(marked[:-3] * power[inside], first)) if len(words) else np.zeros(0, np.uint64)
    return (word % np.uint64(word_buckets)).astype(np.int64), chars, bounds


def starts(n: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows over ``n`` words; the last one ends with the text."""
    return [0] if n <= window else [*range(0, n - window, stride), n - window]


@dataclass
class Network:
    shape: Shape = field(default_factory=Shape)
    seed: int = 0

    def __post_init__(self):
        s, r = self.shape, np.random.default_rng(self.seed)
        d, h = s.word_size + s.char_size, s.hidden
        make = lambda *n: (r.standard_normal(n) / np.sqrt(n[0])).astype(np.float32)
        self.p = {"word": make(s.word_buckets, s.word_size) * 3, "char": make(s.char_buckets, s.char_size) * 30}
        for k in "fb":
            self.p |= {f"x{k}": make(d, 3 * h), f"u{k}": make(h, 3 * h), f"c{k}": np.zeros(3 * h, np.float32)}
        self.p |= {"attend": make(2 * h), "out": make(2 * h), "bias": np.zeros(1, np.float32)}

    def inputs(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word bucket, character buckets and their bounds for each word."""
        return readings(words, self.shape.word_buckets, self.shape.char_buckets)

    def vectors(self, word: np.ndarray, chars: np.ndarray, bounds: np.ndarray, block: int = 1 << 14) -> np.ndarray:
        out = [np.zeros((0, self.shape.word_size + self.shape.char_size), np.float32)]
        for k in range(0, len(word), block):
            edge = bounds[k : k + block + 1]
            sums = np.add.reduceat(self.p["char"][chars[edge[0] : edge[-1]]], edge[:-1] - edge[0], axis=0)
            out.append(np.concatenate([self.p["word"][word[k : k + block]], sums / np.diff(edge)[:, None].astype(np.float32)], axis=1))
        return np.concatenate(out)

    def run(self, step, mask: np.ndarray | None, keep: bool = False):
        """Scores of windows. ``step(k, t)``: gate inputs of direction k at place t. With ``keep`` what training needs."""
        h, T = self.shape.hidden, self.shape.window
        n = step("f", 0).shape[0]
        states, saved = np.empty((T, n, 2 * h), np.float32), {}
        for k, half, order in (("f", slice(0, h), range(T)), ("b", slice(h, 2 * h), range(T - 1, -1, -1))):
            now, u = np.zeros((n, h), np.float32), self.p[f"u{k}"]
            for t in order:
                x, g = step(k, t), now @ u
                gates = _sigmoid(x[:, : 2 * h] + g[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
                after = new + z * (now - new)
                if mask is not None:
                    m = mask[:, t : t + 1]
                    after = np.where(m, after, now)
                if keep:
                    saved[k, t] = now, z, r, new, g[:, 2 * h :]
                now = states[t][:, half] = after
        logit, share, pooled = self._pooled(states, None if mask is None else mask.T)
        return (logit, states, share, pooled, saved) if keep else logit

    def read(self, table: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """What ``run`` gives without ``keep``, for windows (T, n) of row numbers of a table of gate inputs. Numbers of one kind stand
        together, a window being a column, and steps write over what they no longer need."""
        h, (T, n) = self.shape.hidden, ids.shape
        states, x = np.empty((T, n, 2 * h), np.float32), np.empty((n, 3 * h), np.float32)
        g, gates, own, after = np.empty((n, 3 * h), np.float32), np.empty((3 * h, n), np.float32), np.empty((h, n), np.float32), np.empty((h, n), np.float32)
        both, z, r, new = gates[: 2 * h], gates[:h], gates[h : 2 * h], gates[2 * h :]
        for k, half, order in (("f", slice(0, h), range(T)), ("b", slice(h, 2 * h), range(T - 1, -1, -1))):
            now, u = np.zeros((h, n), np.float32), self.p[f"u{k}"]
            for t in order:
                np.take(table[k], ids[t], axis=0, out=x, mode="clip")
                # This way round the product is rounded like that of ``run``.
                np.matmul(now.T, u, out=g)
                new[:], own[:] = x[:, 2 * h :].T, g[:, 2 * h :].T
                x += g
                both[:] = x[:, : 2 * h].T
                both *= np.float32(0.5)
                np.tanh(both, out=both)
                both += np.float32(1)
                both *= np.float32(0.5)
                r *= own
                new += r
                np.tanh(new, out=new)
                np.subtract(now, new, out=after)
                after *= z
                after += new
                if mask is not None:
                    np.copyto(after, now, where=~mask[t])
                states[t, :, half] = after.T
                now, after = after, now
        return self._pooled(states, mask)[0]

    def _pooled(self, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores from the states (T, n, 2h) of windows, their shares and what was pooled by them; ``mask`` (T, n)."""
        score = states @ self.p["attend"]
        if mask is not None:
            score = np.where(mask, score, -1e9)
        share = np.exp(score - score.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states)
        return pooled @ self.p["out"] + self.p["bias"], share, pooled

    def gradients(self, dlogit: np.ndarray, mask: np.ndarray, kept: tuple) -> tuple[dict, dict]:
        """Gradients of the weights, and of the gate inputs by direction, (n, T, 3h)."""
        _, states, share, pooled, saved = kept
        h, T, n = self.shape.hidden, self.shape.window, len(dlogit)
        g = {"out": pooled.T @ dlogit, "bias": dlogit.sum(keepdims=True)}
        dpool = dlogit[:, None] * self.p["out"]
        dshare = np.einsum("tnh,nh->tn", states, dpool)
        dscore = share * (dshare - (share * dshare).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", dscore, states)
        dstates = share[:, :, None] * dpool + dscore[:, :, None] * self.p["attend"]
        dx = {}
        for k, half, order in (("f", slice(0, h), range(T - 1, -1, -1)), ("b", slice(h, 2 * h), range(T))):
            u, du, dh = self.p[f"u{k}"], np.zeros((h, 3 * h), np.float32), np.zeros((n, h), np.float32)
            dx[k] = np.zeros((n, T, 3 * h), np.float32)
            for t in order:
                now, z, r, new, gn = saved[k, t]
                dh = dh + dstates[t][:, half]
                m = mask[:, t : t + 1]
                da = dh * m
                dnew = da * (1 - z) * (1 - new * new)
                dz, dr = da * (now - new) * z * (1 - z), dnew * gn * r * (1 - r)
                dx[k][:, t] = np.concatenate([dz, dr, dnew], axis=1)
                dg = np.concatenate([dz, dr, dnew * r], axis=1)
                du += now.T @ dg
                dh = dh * (1 - m) + da * z + dg @ u.T
            g[f"u{k}"], g[f"c{k}"] = du, dx[k].sum(axis=(0, 1))
        return g, dx


class Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.n = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict) -> None:
        self.n += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.p[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def fit(texts: Sequence[bytes], labels: Sequence[int], shape: Shape = Shape(), weak: int = 140, sharp: int = 8, steps: int = 24, batch: int = 256, rate: float = 0.01, seed: int = 0) -> Network | None:
    """A network for texts with labels 0 and 1; None without labelled words of both kinds.

    ``weak`` steps, or as many as take every window once if that is more, take windows at random; then ``sharp`` rounds of
    ``steps`` steps take texts by their worst windows.
    """
    known: dict[bytes, int] = {}
    windows, of, label = [], [], []
    # Text by text: only numbers stay.
    for text, y in zip(texts, labels):
        words = text.lower().split()
        if not words:
            continue
        ids = np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int32, len(words))
        place = np.array(starts(len(ids), shape.window, shape.stride))[:, None] + np.arange(shape.window)
        windows.append(np.where(place < len(ids), ids[np.minimum(place, len(ids) - 1)], 0).astype(np.int32))
        of.append(np.full(len(place), len(label)))
        label.append(y)
    if len(set(label)) < 2:
        return None
    net, rng = Network(shape, seed), np.random.default_rng(seed)
    windows, of, label = np.concatenate(windows), np.concatenate(of), np.array(label, np.float32)
    word, chars, bounds = net.inputs([b"", *known])
    adam = Adam(net.p, rate)
    d = shape.word_size

    def gate_inputs(ids: np.ndarray, drop: float):
        """Inputs of the words of some windows; some words are read by their characters only."""
        here, at = np.unique(ids, return_inverse=True)
        rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in here])
        size = bounds[here + 1] - bounds[here]
        x = net.vectors(word[here], chars[rows], np.concatenate(([0], np.cumsum(size))))
        gone = rng.random(len(here)) < drop
        x[gone, :d] = 0
        return here, at.reshape(ids.shape), rows, size, gone, x

    def learn(chosen: np.ndarray, weight: np.ndarray) -> None:
        ids = windows[chosen]
        mask = ids > 0
        here, at, rows, size, gone, x = gate_inputs(ids, 0.4)
        table = {k: x @ net.p[f"x{k}"] + net.p[f"c{k}"] for k in "fb"}
        kept = net.run(lambda k, t: table[k][at[:, t]], mask, keep=True)
        dlogit = ((_sigmoid(kept[0]) - label[of[chosen]]) * weight / len(chosen)).astype(np.float32)
        g, dx = net.gradients(dlogit, mask, kept)
        dxs = np.zeros_like(x)
        for k in "fb":
            flat = _gathered(dx[k].reshape(-1, 3 * shape.hidden), at.ravel(), len(here))
            g[f"x{k}"] = x.T @ flat
            dxs += flat @ net.p[f"x{k}"].T
        dxs[gone, :d] = 0
        g["word"] = _gathered(dxs[:, :d], word[here], shape.word_buckets)
        share = (dxs[:, d:] / size[:, None]).astype(np.float32)
        g["char"] = _gathered(np.repeat(share, size, axis=0), chars[rows], shape.char_buckets)
        adam.step(g)

    positive = max(float(label.mean()), 1e-3)
    balance = np.where(label == 1, 0.5 / positive, 0.5 / (1 - positive))

    def cycled(rows: np.ndarray, size: int, times: int) -> Iterator[np.ndarray]:
        order = np.concatenate([rng.permutation(rows) for _ in range(-(-size * times // len(rows)))])
        for k in range(times):
            yield order[k * size : (k + 1) * size]

    for part in cycled(np.arange(len(windows)), batch, max(weak, -(-len(windows) // batch))):
        learn(part, balance[of[part]])
    for _ in range(sharp):
        logit = _logits(net, net.vectors(word, chars, bounds), windows)
        worst = np.lexsort((-logit, of))
        worst = worst[np.unique(of[worst], return_index=True)[1]]
        for part in cycled(worst, batch // 2, steps):
            learn(part, np.ones(len(part)))
    return net


def _logits(net: Network, vectors: np.ndarray, windows: np.ndarray, block: int = 4096) -> np.ndarray:
    """Logits of windows of row numbers of ``vectors``; row 0 is no word."""
    table = {k: vectors @ net.p[f"x{k}"] + net.p[f"c{k}"] for k in "fb"}
    return _by_table(net, table, windows, block)


def _by_table(net: Network, table: dict[str, np.ndarray], windows: np.ndarray, block: int = 4096) -> np.ndarray:
    out = []
    for k in range(0, len(windows), block):
        ids = np.ascontiguousarray(windows[k : k + block].T)
        mask = ids > 0
        out.append(net.read(table, ids, None if mask.all() else mask))
    return np.concatenate(out) if out else np.zeros(0, np.float32)


class Scorer:
    """Scores of whole texts; remembers gate inputs of words, which are told apart by 64-bit hashes."""

    def __init__(self, net: Network):
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.table = self._gates([b""])

    def _gates(self, words: list[bytes]) -> dict[str, np.ndarray]:
        x = self.net.vectors(*self.net.inputs(words))
        return {k: x @ self.net.p[f"x{k}"] + self.net.p[f"c{k}"] for k in "fb"}

    def _rows(self, words: Words) -> np.ndarray:
        """Rows of the table for all words, those of new words included; row 0 is no word."""
        every, first, at = np.unique(words.hashes(words.starts, words.ends), return_index=True, return_inverse=True)
        while True:
            place = self.known.searchsorted(every)
            new = np.ones(len(every), bool)
            if len(self.known):
                new = self.known[np.minimum(place, len(self.known) - 1)] != every
            if not len(self.known) or len(self.known) + 1 + new.sum() <= REMEMBERED:
                break
            self._reset()
        if new.any():
            buffer, chosen = words.buffer.tobytes(), first[new]
            named = [buffer[a:b] for a, b in zip(words.starts[chosen].tolist(), words.ends[chosen].tolist())]
            # In the order of the words: how a row of a product is rounded depends on its place.
            order = sorted(range(len(named)), key=named.__getitem__)
            gates = self._gates([named[i] for i in order])
            row = np.empty(len(order), np.int32)
            row[order] = len(self.table["f"]) + np.arange(len(order), dtype=np.int32)
            self.known, self.row = np.insert(self.known, place[new], every[new]), np.insert(self.row, place[new], row)
            self.table = {k: np.concatenate([self.table[k], gates[k]]) for k in "fb"}
        return self.row[self.known.searchsorted(every)][at]

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        s = self.net.shape
        words = Words([t.lower() if t else t for t in texts])
        out = np.zeros(len(texts))
        if len(words):
            flat, n = self._rows(words), words.counts
            # A text of more words than a window has one every ``stride`` words, and one that ends with it.
            wide = np.maximum(n - s.window, 0)
            many = np.where(n > 0, -(-wide // s.stride) + 1, 0)
            of = np.repeat(np.arange(len(n)), many)
            heads = words.first[:-1][of] + np.minimum((np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)) * s.stride, wide[of])
            places = np.arange(s.window)
            ids = flat[np.minimum(heads[:, None] + places, len(flat) - 1)]
            ids[places >= n[of, None]] = 0
            logit = _by_table(self.net, self.table, ids)
            have = np.flatnonzero(many)
            first = (np.cumsum(many) - many)[have]
            out[have] = _sigmoid(np.maximum.reduceat(logit.astype(float), first))
        return out


def held_out(key: str) -> Column:
    """Rows that are never learned from: CRC-32 of the key as text divisible by 5; a null key counts as empty."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 1000, sample_bytes: int = 64 << 20, shape: Shape = Shape(), seed: int = 0) -> Network | None:
    """Fit on at most ``sample`` toxic and twice as many clean labelled texts, those with the least hashes of their keys, without
    held-out rows; None if these have no words of both kinds.

    The sample ends before ``sample_bytes`` bytes of text, and texts of more than a 64th of that are not in it. Null labels and keys are
    left out. A key with several labels or texts gives a row for each. The fit runs in one task of an executor, which sends the weights
    back; it gives the same network again if the executor is lost.
    """
    learn = labels.where(f"`{key}` is not null and `{label}` in (0, 1)").where(~held_out(key)).select(key, F.col(label).cast("int").alias("__y"))
    draw = lambda y: learn.where(F.col("__y") == y).orderBy(F.xxhash64(F.col(key)), key).limit((2 - y) * sample)
    chosen = written(draw(0).unionByName(draw(1)), "sample")
    # At most three times ``sample`` keys.
    texts = docs.select(key, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__t")).join(F.broadcast(chosen), key)
    texts = texts.where(F.octet_length("__t") <= sample_bytes // 64).select(F.xxhash64("__t").alias("hash"), F.col("__y").alias("y"), F.octet_length("__t").alias("size"), F.col("__t").alias("t"))
    texts = written(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    order = ["hash", "y", "row"]
    first = texts.select(*order, "size").orderBy(*order).limit(3 * sample)
    upto = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    first = first.withColumn("upto", upto).where(F.col("upto") <= sample_bytes).select("row")
    rows = texts.join(F.broadcast(first), "row").repartition(1).sortWithinPartitions(*order).select("t", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(t, y) for batch in batches for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        net = fit([t for t, _ in held], [y for _, y in held], shape, seed=seed)
        for name, values in net.p.items() if net else ():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([list(values.shape)], pa.list_(pa.int32())), pa.array([values.tobytes()])], ["name", "size", "data"])

    weights = rows.mapInArrow(run, "name string, size array<int>, data binary").toArrow().to_pylist()
    if not weights:
        return None
    net = Network(shape, seed)
    net.p = {w["name"]: np.frombuffer(w["data"], np.float32).reshape(w["size"]) for w in weights}
    return net


def scored(docs: DataFrame, net: Network | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for the whole text; 0 for null and blank texts, and for all without a network. A column that is
    already named ``out`` gives way, wherever it stands."""
    if out != text and out in docs.columns:
        docs = docs.drop(out)
    if net is None:
        return docs.withColumn(out, F.lit(0.0))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts = as_bytes(batch.column(place))
            made = [scorer.scores(texts[part]) for part in chunks(texts, 1 << 20)]
            score = np.concatenate(made) if made else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{out}` double"]))
