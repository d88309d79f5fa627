"""Character n-grams of texts as arrays of numbers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE = 32


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def words_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text: letters, and one space around and between words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    alpha = letters()[points]
    if not alpha.any():
        return np.empty(0, np.int64)
    points = np.where(alpha, points, SPACE).astype(np.int64)
    points = np.concatenate([[SPACE], points, [SPACE]])
    space = points == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[0] = True
    points = points[keep]
    return points[1:] if len(points) > 1 and points[1] == SPACE else points


def exact_codes(points: np.ndarray) -> np.ndarray:
    """Every 1-, 2- and 3-gram of the words, spaces at their ends only, as one number each."""
    space = points == SPACE
    one = points[~space]
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    return np.concatenate([one, two, three[~space[1:-1]]])


def ranked(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts; both empty without a letter."""
    points = words_only(text) if text else np.empty(0, np.int64)
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(exact_codes(points), return_counts=True)


def profile(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties to the smaller code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        above = counts >= least
        codes, counts = codes[above], counts[above]
    return codes[np.argsort(-counts, kind="stable")[:size]]


_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed_codes(text: str | None, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Buckets of every n-gram of the lower-cased text, ends marked; repeats are not removed."""
    padded = f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(padded, "<u4").astype(np.uint64)
    rolled, parts = points.copy(), []
    for n in range(1, max(sizes) + 1):
        if n > 1:
            if len(points) < n:
                break
            rolled = rolled[:-1] * np.uint64(0x100000001B3) + points[n - 1:]
        if n in sizes:
            parts.append(((rolled * _MIX) >> np.uint64(64 - bits)).astype(np.int32))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)
