"""Words and word-sequence hashes of whole texts, vectorised per Arrow batch.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), which
is what ``bytes.split()`` gives. Texts of a batch are hashed together from the
Arrow buffer in chunks of about ``CHUNK_BYTES`` (a longer text is one chunk),
so memory is bounded by the chunk or by the longest text.

Hashes are polynomials modulo 2**64 over random byte values, finished by a
bijective mixer. Sequence identity is judged on two such hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BYTE_MULT, _SEQ_MULT_1, _SEQ_MULT_2 = (
    0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def __init__(self, mult: int):
        self.mult, self.inv = mult, pow(mult, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, m in (("up", self.mult), ("down", self.inv)):
                p = np.full(size, m, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    c = np.empty(len(values) + 1, np.uint64)
    c[0] = 0
    np.cumsum(values, dtype=np.uint64, out=c[1:])
    return c


class WordHasher:
    """Word and sequence hashes; ``lower`` folds A-Z to a-z first."""

    def __init__(self, lower: bool = False):
        values = np.random.default_rng(20240117).integers(
            1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            values[65:91] = values[97:123]
        self.values = values
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.bytes_pw, self.pw1, self.pw2 = map(
            _Powers, (_BYTE_MULT, _SEQ_MULT_1, _SEQ_MULT_2))

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """``(hash, row, start, end)`` of every word; ``offsets`` (n + 1) are
        the rows' byte positions in ``data``, starting at 0."""
        n = len(data)
        if n == 0:
            z = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), z, z, z
        solid = ~self.space[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True  # a word never runs over a text's end
        before = np.empty(n, bool)
        before[0], before[1:] = False, solid[:-1]
        starts = np.flatnonzero(solid & (~before | cut[:-1]))
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, solid[1:]
        ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
        up, down = self.bytes_pw.get(n)
        c = _sums(self.values[data] * up)
        h = mix64((c[ends] - c[starts]) * down[starts])
        rows = np.searchsorted(offsets, starts, "right") - 1
        return h, rows, starts, ends

    def sequences(self, h: np.ndarray, k: int, second: bool = False) -> np.ndarray:
        """Hash of words i .. i + k - 1 for each i (texts run on: the caller
        drops sequences that cross a text's end)."""
        if len(h) < k:
            return np.zeros(0, np.uint64)
        up, down = (self.pw2 if second else self.pw1).get(len(h))
        c = _sums(h * up)
        return mix64((c[k:] - c[:-k]) * down[:len(h) - k + 1])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """``(first row, bytes, offsets from 0)`` of runs of rows of about
    ``max_bytes`` bytes; every row is in exactly one run."""
    if len(column) == 0:
        return
    raw, off = text_buffer(column)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j
