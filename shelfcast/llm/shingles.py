"""Word and shingle hashes of whole texts, vectorised over a batch of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_SEED = 0x5E7C0DE
_FOLD, _STEP = U(0xD6E8FEB86659FD93), U(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Random 64-bit values per byte (A-Z as a-z, white space 0), and the word-byte mask."""
    values = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
    values[65:91] = values[97:123]
    is_word = np.ones(256, bool)
    is_word[[9, 10, 11, 12, 13, 32]] = False
    values[~is_word] = 0
    return values, is_word


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), applied elementwise."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_chunks(column: pa.Array, chunk_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of runs of rows of about ``chunk_bytes``.

    Nulls count as empty texts.  A longer text is a run of its own, never cut.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk_bytes, side="right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and row of every maximal run of non-white-space bytes."""
    values, is_word = _tables()
    word = is_word[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offsets[:-1]
    first = first[first < len(data)]
    start[first] = word[first]
    at = np.flatnonzero(start)
    if len(at) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    place = np.arange(len(data)) - at[np.maximum(np.cumsum(start) - 1, 0)]
    place[~word] = 0
    np.maximum(place, 0, out=place)
    powers = np.full(int(place.max()) + 1, _STEP, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    hashes = mix(np.add.reduceat(values[data] * powers[place], at))
    return hashes, np.searchsorted(offsets, at, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of every row: (hashes sorted within rows, row bounds).

    A row of 1 to k-1 words has its whole word sequence as its one shingle; a row
    without words has none.
    """
    n = len(offsets) - 1
    words, row = word_hashes(data, offsets)
    count = np.bincount(row, minlength=n)
    if len(words) >= k:
        gram = words[:len(words) - k + 1].copy()
        for j in range(1, k):
            gram = gram * _FOLD + words[j:len(words) - k + 1 + j]
        whole = row[:len(row) - k + 1] == row[k - 1:]
        gram, gram_row = mix(gram[whole]), row[:len(row) - k + 1][whole]
    else:
        gram, gram_row = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.searchsorted(row, short)
        acc = count[short].astype(np.uint64) * U(0xA0761D6478BD642F)
        for j in range(k - 1):
            more = count[short] > j
            acc[more] = mix(acc[more] * _FOLD + words[begin[more] + j])
        gram, gram_row = np.concatenate([gram, acc]), np.concatenate([gram_row, short])
        order = np.argsort(gram_row, kind="stable")
        gram, gram_row = gram[order], gram_row[order]
    bounds = np.searchsorted(gram_row, np.arange(n + 1))
    parts = [np.unique(gram[bounds[i]:bounds[i + 1]]) for i in range(n)]
    sizes = np.fromiter((len(p) for p in parts), np.int64, n)
    return (np.concatenate(parts) if parts else gram), np.concatenate([[0], np.cumsum(sizes)])
