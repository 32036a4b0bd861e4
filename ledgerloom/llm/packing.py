"""Best-fit packing of documents into sequences under several capacities at once.

Texts become token pieces in one pass, which also gives lengths and checksums; the pieces are dealt evenly to tasks, and each
task fills its own sequences. A piece (tokens, 1 document, attention cost) goes into the open sequence, among those with
room for it in every capacity, that fits best: the largest weighted dot product of the piece and the residual capacities, or
the smallest weighted norm of what would be left. Pieces come in falling order, so short ones fill the gaps. A task leaves
at most a few sequences unfilled, so the waste shrinks with the pieces per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import written

#: Units whose token ids a task remembers; then it starts anew.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. ``attention`` bounds the sum of squared lengths of its pieces."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A byte-level vocabulary whose pieces never cross a space that has a non-space on one side allows ids to be looked up by
    unit: what lies between such spaces, with the space before it. Units not seen yet are encoded together, in one text.
    Texts with a space between white space are encoded as a whole. ``ranks`` may name the same vocabulary as a table of ranks;
    new units are then merged by tiktoken, which gives the same ids several times faster. Special tokens are always left to
    ``tokenizers``.
    """

    def __init__(self, path: str, ranks: str | None = None):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = re.compile(r"\s \s")
        self.known: dict[str, bytes] = {}
        self.plain = self._by_ranks(ranks) if ranks else lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        size = self.tokenizer.get_vocab_size()
        # One character of a byte-level token stands for one byte.
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([r"\A\S", r"\A\s\s", r"\s\Z", r"\A\Z", *special]))

    @staticmethod
    def _by_ranks(path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, units: list[str]) -> None:
        # Units that start with one space, end with none and hold no special token can stand in one text.
        odd = self.odd.search
        plain = []
        for u in units:
            if odd(u):
                self.known[u] = self.whole(u)
            else:
                plain.append(u)
        for k in range(0, len(plain), 1 << 16):
            part = plain[k : k + (1 << 16)]
            ids = np.array(self.plain("".join(part)), "<u4")
            data, ends = ids.tobytes(), np.cumsum(self.bytes[ids])
            stops = 4 * (np.searchsorted(ends, np.cumsum([len(u.encode()) for u in part]), "left") + 1)
            cuts = [0, *stops.tolist()]
            self.known.update(zip(part, [data[x:y] for x, y in zip(cuts, cuts[1:])]))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        split: list[list[str] | None] = []
        missing: set[str] = set()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for t in texts:
            if not t:
                split.append([])
            elif self.between.search(t):
                split.append(None)
            else:
                first, *rest = t.split(" ")
                units = [first] if first else []
                units += [" " + r for r in rest]
                split.append(units)
                missing.update(set(units).difference(known))
        if missing:
            self._learn(sorted(missing))
        get = known.__getitem__
        return [self.whole(t) if u is None else b"".join(map(get, u)) for t, u in zip(texts, split)]


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0, ids: bool = False, ranks: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32) and with ``ids`` the token ids, for every row of ``docs``.

    A document is the ids of its text and then ``end``; a null text is empty. Documents longer than ``capacity`` are cut into
    full pieces; only the first may be shorter.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        close = int(end).to_bytes(4, "little")
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for begin in range(0, batch.num_rows, 256):
                part = texts[begin : begin + 256].to_pylist()
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, made in enumerate(encoder.encode(part)):
                    made += close
                    n = len(made) // 4
                    cuts = list(range(n, 0, -capacity))[::-1]
                    at = 0
                    for k, stop in enumerate(cuts):
                        data = made[4 * at : 4 * stop]
                        row.append(begin + i)
                        piece.append(k)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(data))
                        if ids:
                            kept.append(np.frombuffer(data, "<u4").astype(np.int32))
                        at = stop
                columns = [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [key, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, limits: np.ndarray, weights: np.ndarray, rule: str = "dot") -> np.ndarray:
    """Sequence number of each piece. ``sizes`` (pieces, capacities) in falling order; every piece fits an empty sequence.

    ``dot`` takes the open sequence with the *least spare* alignment left over: the residuals are normalised to the
    capacities, and the score is the weighted dot product of piece and residual over the squared weighted norm of the
    residual, which is largest where the piece fills most of what is left. ``norm`` takes the one with the smallest
    weighted norm of the residual after the piece. Ties go to the sequence opened first.
    """
    n, share = len(sizes), weights / limits.astype(float) ** 2
    left = np.empty((1024, sizes.shape[1]), np.int64)
    where = np.empty(1024, np.int64)
    open_now = used = 0
    least = np.minimum.accumulate(sizes[::-1], axis=0)[::-1]
    out = np.empty(n, np.int64)
    for k in range(n):
        size = sizes[k]
        have = left[:open_now]
        fits = np.flatnonzero((have[:, 0] >= size[0]) & (have >= size).all(axis=1)) if open_now else ()
        if len(fits):
            room = have[fits].astype(float)
            if rule == "dot":
                score = -(room * (size * share)).sum(axis=1) / np.maximum((room * room * share).sum(axis=1), 1e-300)
            else:
                score = ((room - size) ** 2 * share).sum(axis=1)
            at = int(fits[np.argmin(score)])
        else:
            if open_now == len(left):
                left, where = np.concatenate([left, np.empty_like(left)]), np.concatenate([where, np.empty_like(where)])
            left[open_now], where[open_now] = limits, used
            at, open_now, used = open_now, open_now + 1, used + 1
        left[at] -= size
        out[k] = where[at]
        # A sequence without room for the least of what follows is closed.
        if k + 1 < n and (left[at] < least[k + 1]).any():
            open_now -= 1
            left[at : open_now] = left[at + 1 : open_now + 1]
            where[at : open_now] = where[at + 1 : open_now + 1]
    return out


def pack(made: DataFrame, capacity: Capacity = Capacity(), weights: Sequence[float] = (1.0, 0.1, 0.1), rule: str = "dot", per_task: int = 1 << 14) -> DataFrame:
    """``made`` (a written table of pieces with ``length``) with sequence_id and offset; offsets are gapless from 0.

    Pieces are dealt to tasks without regard to a key, about ``per_task`` to each. Every piece must fit an empty sequence;
    one that does not is an error. An empty table gives an empty table.
    """
    limits, weight = capacity.limits(), np.array(weights, float)
    names = made.columns
    tasks = max(1, -(-made.count() // per_task))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        # Ties have a fixed order, so a task that runs again gives the same sequences.
        order = [("length", "descending")] + [(n, "ascending") for n in names if n != "length" and not pa.types.is_nested(table.schema.field(n).type)]
        table = table.sort_by(order).combine_chunks()
        length = table.column("length").to_numpy().astype(np.int64)
        sizes = np.stack([length, np.ones_like(length), length * length], axis=1)
        if (sizes > limits).any():
            raise ValueError("a piece is larger than a sequence")
        number = best_fit(sizes, limits, weight, rule)
        by = np.lexsort((np.arange(len(number)), number))
        ends = np.cumsum(length[by])
        first = np.concatenate(([True], np.diff(number[by]) != 0))
        offset = np.empty_like(ends)
        offset[by] = ends - length[by] - np.maximum.accumulate(np.where(first, ends - length[by], 0))
        base = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(number + base)).append_column("offset", pa.array(offset))
        yield from table.to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return made.repartition(tasks).mapInArrow(fill, f"{kinds}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: Capacity = Capacity(), end: int = 0, rule: str = "dot", ids: bool = False, ranks: str | None = None) -> DataFrame:
    """Pieces of ``docs`` with their sequence and place; see ``pieces`` and ``pack``. With ``ids`` the token ids too.

    Repeated rows are packed as often as they come. Null keys are kept; other columns are not looked at.
    """
    return pack(written(pieces(docs, tokenizer, key, text, min(capacity.tokens, int(capacity.attention**0.5)), end, ids, ranks), "pieces"), capacity, rule=rule)
