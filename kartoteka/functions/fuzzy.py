"""String similarity scores from 0 to 100 over whole Arrow columns: ratios of longest common subsequences.

All scores rest on one bit-parallel computation: texts of up to 64 characters are one machine word each, and a batch of
pairs is worked on at once by numpy, character by character; longer texts take Python's long integers. Sliding windows of a
partial ratio are pairs of their own in the same computation. Nulls count as empty texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Characters that fit a machine word; pairs (windows included) that are worked on at once.
WORD, BATCH = 64, 1 << 15
# What the weighted ratio takes off other orders and parts of a text, and the length ratios at which parts count.
UNORDERED, PART, SMALL_PART, LONGER, MUCH_LONGER = 0.95, 0.9, 0.6, 1.5, 8.0


def _codes(texts: list[str], width: int, blank: int) -> np.ndarray:
    out = np.full((len(texts), width), blank, np.int32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _long_common(a: str, b: str) -> int:
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for c in b:
        u = state & at.get(c, 0)
        state = ((state + u) | (state - u)) & full
    return len(a) - state.bit_count()


def common(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs."""
    out = np.zeros(len(a), np.int64)
    short = [i for i in range(len(a)) if 0 < len(a[i]) <= WORD and b[i]]
    for i in range(len(a)):
        if len(a[i]) > WORD and b[i]:
            out[i] = _long_common(a[i], b[i])
    short.sort(key=lambda i: len(b[i]))  # pairs of like length share a batch
    for low in range(0, len(short), BATCH):
        some = short[low : low + BATCH]
        left, right = [a[i] for i in some], [b[i] for i in some]
        x, y = _codes(left, max(map(len, left)), -1), _codes(right, max(map(len, right)), -2)
        bit = np.uint64(1) << np.arange(x.shape[1], dtype=np.uint64)
        state = np.full(len(some), ~np.uint64(0))
        for j in range(y.shape[1]):
            u = state & ((x == y[:, j : j + 1]) @ bit)
            state = (state + u) | (state - u)
        size = np.array([len(t) for t in left], np.uint64)
        mask = ~np.uint64(0) >> (np.uint64(WORD) - size)
        out[some] = size.astype(np.int64) - np.bitwise_count(state & mask)
    return out


def _percent(twice: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 100.0 * twice / np.maximum(total, 1), 100.0)


def _sizes(texts: list[str]) -> np.ndarray:
    return np.array([len(t) for t in texts], np.int64)


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Twice the common characters, in order, of all characters of both; 100 for two empty texts."""
    return _percent(2 * common(a, b), _sizes(a) + _sizes(b))


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter text and a window of its length, or a shorter one at an end, of the longer; both ways round for equal lengths."""
    best = np.array([100.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)])
    owner, left, right = [], [], []

    def settle():
        if owner:
            np.maximum.at(best, owner, ratios(left, right))
            owner.clear(), left.clear(), right.clear()

    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x == y or not x or not y:
            continue
        for s, t in ((x, y), (y, x)) if len(x) == len(y) else (sorted((x, y), key=len),):
            m, n = len(s), len(t)
            seen = {t[max(k, 0) : k + m] for k in range(1 - m, n)}
            owner += [i] * len(seen)
            left += [s] * len(seen)
            right += seen
        if len(owner) >= BATCH:
            settle()
    settle()
    return best


def _parts(x: str, y: str) -> tuple[str, str, str]:
    """Words of both, of x alone and of y alone; each sorted and joined."""
    p, q = set(x.split()), set(y.split())
    return " ".join(sorted(p & q)), " ".join(sorted(p - q)), " ".join(sorted(q - p))


def _set_ratios(parts: list[tuple[str, str, str]], a: list[str], b: list[str]) -> np.ndarray:
    both, p, q = ([x[k] for x in parts] for k in range(3))
    s, n, m = _sizes(both), _sizes(p), _sizes(q)
    gap = (s > 0).astype(np.int64)
    left, right = s + np.where(n > 0, gap + n, 0), s + np.where(m > 0, gap + m, 0)
    apart = n + m - 2 * common(p, q)
    whole = 100.0 * (1 - apart / np.maximum(left + right, 1))
    side = lambda k: np.where(s > 0, 100.0 * (1 - (gap + k) / np.maximum(s + s + gap + k, 1)), 0.0)
    out = np.maximum(whole, np.maximum(side(n), side(m)))
    out[(s > 0) & ((n == 0) | (m == 0))] = 100.0
    out[[not (x.split() and y.split()) for x, y in zip(a, b, strict=True)]] = 0.0
    return out


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Words that both have against those with what each has besides; 100 if one side's words are all shared, 0 without words."""
    return _set_ratios([_parts(x, y) for x, y in zip(a, b, strict=True)], a, b)


def weighted_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best of the ratio, of ratios of sorted and of shared words, and, where one text is much longer, of its parts, each less a fixed share; 0 if a text is empty."""
    parts = [_parts(x, y) for x, y in zip(a, b, strict=True)]
    low, high = np.minimum(_sizes(a), _sizes(b)), np.maximum(_sizes(a), _sizes(b))
    longer = high / np.maximum(low, 1)
    ordered = lambda xs: [" ".join(sorted(x.split())) for x in xs]
    sa, sb = ordered(a), ordered(b)
    out, whole = ratios(a, b), longer < LONGER
    unordered = np.maximum(ratios(sa, sb), _set_ratios(parts, a, b)) * UNORDERED
    out = np.where(whole, np.maximum(out, unordered), out)
    far = np.flatnonzero(~whole & (low > 0))
    if len(far):
        scale = np.where(longer[far] <= MUCH_LONGER, PART, SMALL_PART)
        pick = lambda xs: [xs[i] for i in far]
        words = np.maximum(partial_ratios(pick(sa), pick(sb)), partial_ratios(*([parts[i][k] for i in far] for k in (1, 2))))
        words[[bool(parts[i][0]) for i in far]] = 100.0
        words[[not (sa[i] and sb[i]) for i in far]] = 0.0
        out[far] = np.maximum(out[far], np.maximum(partial_ratios(pick(a), pick(b)) * scale, words * UNORDERED * scale))
    out[low == 0] = 0.0
    return out


def _column(score):
    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(score(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")

    return scored


ratio, partial_ratio, token_set_ratio, weighted_ratio = map(_column, (ratios, partial_ratios, token_set_ratios, weighted_ratios))
