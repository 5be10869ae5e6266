"""Words of whole texts as 64-bit hashes with their places, over Arrow text
buffers with numpy (no Python loop over words).

A word is a maximal run of bytes of a given class; A-Z counts as a-z.  What is
held besides the text is one flag a byte and about 24 bytes a word; hashing
goes in blocks of bytes, so a very long text needs no more than its words do.
Words of over ``LONG`` bytes are hashed by a digest instead of the polynomial.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np

from .shingles import mix

LONG = 512
_BLOCK = 1 << 20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the bytes in the ranges (ends included)."""
    flags = np.zeros(256, bool)
    for a, b in ranges:
        flags[a : b + 1] = True
    return flags


@lru_cache(maxsize=4)
def _tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, powers of the base and of its inverse."""
    rng = np.random.default_rng(0xB17E + seed)
    values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    base = int(rng.integers(1, 2**60)) * 8 + 5
    powers = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(_BLOCK + LONG + 1, b, np.uint64)
        p[0] = 1
        powers.append(np.cumprod(p, dtype=np.uint64))
    return values, powers[0], powers[1]


def places(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of the texts ``data[offsets[i]:offsets[i+1]]``
    and the number of the first word of each text (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[0] = cut[n] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside
    ends[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each word."""
    values, up, down = _tables(seed)
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > LONG)
    i = 0
    for stop in [*long.tolist(), len(starts)]:
        while i < stop:
            j = min(stop, max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, "right"))))
            a, b = starts[i], ends[j - 1]
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(values[data[a:b]] * up[: b - a], out=total[1:])
            out[i:j] = (total[ends[i:j] - a] - total[starts[i:j] - a]) * down[starts[i:j] - a]
            i = j
        i = stop + 1
    out = mix(out)
    for i in long.tolist():
        digest = blake2b(data[starts[i] : ends[i]].tobytes().lower(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out
