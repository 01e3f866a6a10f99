"""Hashes of words and of runs of words, for many texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

BASE = 0x9E3779B97F4A7C15
ODD = np.uint64(0xFF51AFD7ED558CCD)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes (a bijection)."""
    values = (values ^ (values >> np.uint64(33))) * ODD
    return values ^ (values >> np.uint64(29))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word its hash, the number of its text and the place of its first byte in the texts joined by a line feed."""
    body = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    inside = ~IS_SPACE[body]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(body[inside])]
    words = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    distinct = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], dtype=np.uint64)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    return distinct[words.indices.to_numpy(zero_copy_only=False)], owner, starts


class Rolling:
    """Hashes of runs of words, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers, self.inverse = np.ones(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
        powers[1:] = np.cumprod(np.full(n, BASE, dtype=np.uint64))
        self.inverse[1:] = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])
