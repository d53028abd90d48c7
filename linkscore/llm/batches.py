"""Texts of an Arrow batch as flat arrays: bytes, word borders and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts handled at once; one longer text is handled alone

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, as many as were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", inverse)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each starts (n + 1 offsets); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(table: pa.RecordBatch | pa.Table, column: str = "text") -> Iterator[pa.Table]:
    """The rows in order, cut so that the texts of one piece hold about ``SLICE_BYTES``."""
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    size = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy()
    group = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(size)] if len(size) else []
    for a, b in zip(cuts, cuts[1:]):
        yield table.slice(a, b - a)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of many texts.

    ``start``/``end`` are byte borders, ``first[i]:first[i + 1]`` the words of
    text i, ``hash`` a 64-bit hash of each word's bytes.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, powers: _Powers, lower: bool = False):
        self.raw = _LOWER[raw] if lower else raw
        self.offsets = offsets
        n = len(raw)
        solid = np.zeros(n + 2, bool)
        solid[1:-1] = ~_SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        self.start = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
        self.end = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
        self.first = np.searchsorted(self.start, offsets)
        up, down = powers.get(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.raw] * up[:n], dtype=np.uint64, out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words and their bounds by text (as ``first``)."""
        count = np.maximum(np.diff(self.first) - (n - 1), 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        total = max(len(self.hash) - (n - 1), 0)
        key = np.zeros(total, np.uint64)
        for i in range(n):
            key *= np.uint64(0xD6E8FEB86659FD93)
            key += self.hash[i : i + total]
        return mix(key)[run_index(self.first[:-1], count)], bounds


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats hashing for these sizes."""
    keys = np.sort(keys)
    return keys[np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    keys = np.sort(keys)
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[head], np.diff(np.append(head, len(keys)))


class Lookup:
    """Values of many sorted distinct keys, found by hashing with the sorted list behind it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.place = np.zeros(1 << bits, np.int32)  # of the last key with this hash
        self.place[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all known."""
        if not len(keys):
            return np.zeros(0, self.values.dtype)
        at = self.place[self._slot(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = np.searchsorted(self.keys, keys[missed])
        return self.values[at]


def run_index(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(start - (ends - count), count)


def new_powers() -> _Powers:
    return _Powers()
