"""Vectorised byte scanning that several operators share: lower-casing, words and hashes of a whole batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: ASCII characters that are neither letters, digits, white space nor part of a longer character.
_PUNCT = np.array([33 <= i < 127 and not chr(i).isalnum() for i in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Words:
    """Words of a batch of texts: ``hash`` and ``doc`` of each word in order; ``first[i]`` is text i's first word."""

    def __init__(self, texts: list[str], drop_punctuation: bool) -> None:
        # a blank after each text keeps words of neighbours apart
        data = _LOWER[np.frombuffer(b"".join(t.encode() + b" " for t in texts), np.uint8)]
        ends = np.cumsum([len(t.encode()) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        if drop_punctuation:
            keep = ~_PUNCT[data]
            ends = np.cumsum(keep)[ends - 1] if len(ends) else ends
            data = data[keep]
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = edge[::2], edge[1::2]
        power = _powers(len(data) + 1, _BASE)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)])
        self.hash = mix((total[stop] - total[start]) * _powers(len(data) + 1, _INVERSE)[start]) if len(start) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(start, np.concatenate([[0], ends])) if len(ends) else np.zeros(1, np.int64)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; only meaningful where the k words lie in one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64)
        out = self.hash[: n - k + 1].copy()
        for i in range(1, k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + self.hash[i : n - k + 1 + i]
        return mix(out)


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)`` of consecutive rows of about ``limit`` bytes, nulls as empty texts; a longer text stands alone."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(total):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + limit, "right")))
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]
        a = b
