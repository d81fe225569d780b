"""Words of Arrow string columns as numpy arrays: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this many bytes, so memory does not grow with the batch. One text is never cut.
SLICE_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def table(word_bytes) -> np.ndarray:
    """A 256-entry mask from a predicate on byte values."""
    return np.array([bool(word_bytes(b)) for b in range(256)])


#: Words as the contracts name them: maximal runs without space and 0x09-0x0D.
NOT_SPACE = table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Letters of any script (as bytes above 0x7F), digits and a-z after lower-casing.
WORD = table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of len + 1) of a string column; nulls count as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows."""
    data, offsets = buffers(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the number of words) for maximal runs of word bytes within a text."""
    is_word = np.zeros(len(data) + 1, dtype=bool)
    is_word[:-1] = word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | edge))
    ends = np.flatnonzero(before & (~is_word | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = np.atleast_1d(x)  # arrays wrap around without a warning
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial over the bytes of each word, mixed with its length.

    With prefix sums S of (byte + 1) * base**i modulo 2**64, a span's polynomial is (S[end] - S[start]) / base**start;
    base is odd and so has an inverse.
    """
    n = len(data)
    power = _powers(n + 1, _BASE)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = _powers(n + 1, inverse)
    return mix((prefix[ends] - prefix[starts]) * back[starts] + mix((ends - starts).astype(np.uint64)))


def hash_word(word: bytes) -> int:
    return int(hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of k words inside one text; a text of 1 to k - 1 words is one window of all it has."""
    counts = np.diff(first)
    n = len(h)
    whole = np.zeros(max(n - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        whole += mix(h[j : n - k + 1 + j] + np.uint64(j + 1)) * np.uint64(2 * j + 1) if n >= k else np.uint64(0)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    inside = doc_of[: len(whole)] == doc_of[k - 1 :] if n >= k else np.zeros(0, bool)
    keys, docs = mix(whole[inside]), doc_of[: len(whole)][inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] += mix(h[first[short[has]] + j] + np.uint64(j + 1)) * np.uint64(2 * j + 1)
        keys, docs = np.concatenate([keys, mix(extra + counts[short].astype(np.uint64))]), np.concatenate([docs, short])
    return keys, docs
