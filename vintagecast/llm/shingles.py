"""Word shingles of whole texts as 64-bit hashes, computed over Arrow text
buffers with numpy (no Python loop over words).

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased.
A text's set holds its distinct ``k``-word shingles; a text with fewer words
has its whole word sequence as its one shingle; a text without words (or null)
has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 2**64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BLOCK = 1 << 20  # bytes hashed at once; a longer text is taken alone
#: Rows of a batch worked on together: what a task holds doesn't hang on the batch's size.
ROWS = 2_000


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser over uint64: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, key: str) -> np.ndarray:
    have = _powers.get(key)
    if have is None or len(have) < n:
        a = np.full(max(n, _BLOCK), base, np.uint64)
        a[0] = 1
        have = np.cumprod(a, dtype=np.uint64)
        if n <= _BLOCK:
            _powers[key] = have
    return have[:n]


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows; at the end Arrow gives back
    what a worker that lives on would keep."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    col = col.fill_null("")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts ``data[offsets[i]:offsets[i+1]]`` and the
    index of the first word of each text (one more at the end)."""
    base, end = int(offsets[0]), int(offsets[-1])
    data, offsets = data[base:end], offsets - base
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(word & np.concatenate(([True], ~word[:-1] | first[1:n])))
    ends = np.flatnonzero(word & np.concatenate((~word[1:] | first[1:n], [True]))) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_R, n, "r"), out=total[1:])
    h = (total[ends] - total[starts]) * _power(_RINV, n, "inv")[starts]
    return mix(h), np.searchsorted(starts, offsets)


def shingle_sets(col: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text of a string column."""
    data, offsets = text_buffer(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _BLOCK, "right")) - 1)
        words, at = word_hashes(data, offsets[i : j + 1])
        full = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for s in range(k):
            full += words[s : s + len(full)] * _STEP[s]
        full = mix(full)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= k:
                yield np.unique(full[a : b - k + 1])
            elif b > a:
                short = (words[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
        i = j
