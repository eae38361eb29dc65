"""Words of UTF-8 text and their hashes, inside tasks.

Both splitters work on bytes: every separator and every letter they touch is ASCII, so the
words are those that the same classes give on code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh64_intdigest

PART_BYTES = 1 << 21

# Digits, ASCII letters (lower-cased) and every byte of a non-ASCII character stay.
_KEPT = bytes(
    c + 32 if 0x41 <= c <= 0x5A else
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def in_parts(batches, at: int, size: int = PART_BYTES):
    """Slices of batches with about ``size`` bytes in a string column, so that what a task makes of
    a batch stays small; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes.astype(np.int64)), 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def space_words(data: bytes | None) -> list[bytes]:
    """Runs of anything but space, tab, line feed, VT, FF, CR; A-Z lower-cased."""
    return data.lower().split() if data else []


def letter_words(data: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and non-ASCII characters; A-Z lower-cased."""
    return data.translate(_KEPT).split() if data else []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``size`` consecutive words.

    Fewer words make one shingle of all of them; no words make none.
    """
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    out = np.full(count, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count])
    return np.unique(out)


def shingles_of(texts: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``shingles`` of many word lists at once: all hashes, the list of each, counts by list."""
    n_words = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(n_words)
    codes = np.fromiter(
        (xxh64_intdigest(w) for words in texts for w in words), np.uint64, int(n_words.sum()))
    width = np.minimum(n_words, size)
    count = np.where(n_words > 0, n_words - width + 1, 0)
    owner = np.repeat(np.arange(len(texts)), count)
    start = (ends - n_words)[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    out = width[owner].astype(np.uint64)
    for k in range(size):
        more = width[owner] > k
        if not more.any():
            break
        next_word = codes[np.minimum(start + k, len(codes) - 1)]
        out = np.where(more, mix(out * np.uint64(0x9E3779B97F4A7C15) + next_word), out)
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[new], owner[new]
    return out, owner, np.bincount(owner, minlength=len(texts))
