"""Words of UTF-8 texts as flat numpy arrays, and hashes of any run of them.

A word is a longest run of bytes other than space and 0x09-0x0D, which is what ``bytes.split`` gives.
All texts of a chunk lie in one buffer with single spaces between words, so a run of words of one text
is one byte range; its hash comes from prefix sums and costs the same for any length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Texts worked on together; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21

#: Two families of hashes, so that 128 bits are available: odd multiplier and seed of the byte table.
FAMILIES = ((0x9E3779B97F4A7C15, 11), (0xC2B2AE3D27D4EB4F, 23))


class Cache(dict):
    """Kept in a process; travels to another one empty."""

    def __reduce__(self):
        return dict, ()


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = Cache()
_tables: dict[int, np.ndarray] = Cache()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _family(k: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p, seed = FAMILIES[k]
    if k not in _tables:
        _tables[k] = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
    have = _powers.get(k)
    if have is None or len(have[0]) < size + 1:
        # Short buffers get short tables.
        n = max(size + 1, CHUNK_BYTES // 4 if size < CHUNK_BYTES // 4 else 2 * CHUNK_BYTES)
        up = np.full(n, p, np.uint64)
        down = np.full(n, pow(p, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= 2 * CHUNK_BYTES:
            _powers[k] = have
    return _tables[k], *have


def ranges_hashed(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges of a buffer."""
    return _from_sums(*_prefix_sums(buffer, family), starts, ends)


def _prefix_sums(buffer: np.ndarray, family: int) -> tuple[np.ndarray, np.ndarray]:
    table, up, down = _family(family, len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(table[buffer] * up[: len(buffer)], out=sums[1:])
    return sums, down


def _from_sums(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * down[starts])


class Words:
    """The words of some texts. ``first[i]:first[i + 1]`` are the words of text i."""

    def __init__(self, texts: Sequence[bytes | None]):
        normal = [b" ".join(t.split()) if t else b"" for t in texts]
        self.texts = normal
        sizes = np.fromiter(map(len, normal), np.int64, len(normal))
        # A space closes every text, also an empty one.
        self.buffer = np.frombuffer(b" ".join([*normal, b""]), np.uint8)
        ends = np.flatnonzero(self.buffer == 32)
        closing = np.cumsum(sizes + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        kept = ends > starts
        upto = np.concatenate(([0], np.cumsum(kept)))
        self.starts, self.ends = starts[kept], ends[kept]
        self.first = np.concatenate(([0], upto[np.searchsorted(ends, closing) + 1])) if len(normal) else np.zeros(1, np.int64)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(normal)), self.counts)
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
        """64-bit hashes of byte ranges of the buffer."""
        if family not in self._sums:
            self._sums[family] = _prefix_sums(self.buffer, family)
        return _from_sums(*self._sums[family], starts, ends)

    def grams(self, n: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``n`` words inside one text, and the index of its first word."""
        if len(self) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(len(self) - n + 1)
        at = at[self.text_of[at] == self.text_of[at + n - 1]]
        return self.hashes(self.starts[at], self.ends[at + n - 1], family), at


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as bytes, nulls as None."""
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def chunks(texts: Sequence[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of ``texts`` of about ``limit`` bytes."""
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > begin and size + n > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose i-th list is ``values[first[i]:first[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary column whose i-th cell is the bytes of ``values[first[i]:first[i + 1]]``: numbers that Spark only hands on."""
    offsets = (first * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Where the numbers of each cell of a binary column without nulls begin and end, from 0, and all of them."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, kind)
    wide = pa.types.is_large_binary(column.type)
    first = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not first[-1] - first[0]:
        return np.zeros(len(first), np.int64), np.zeros(0, kind)
    values = np.frombuffer(column.buffers()[2], np.uint8)[first[0] : first[-1]].copy().view(kind)
    return (first - first[0]) // values.itemsize, values


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
