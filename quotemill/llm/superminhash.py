"""Shingle sets and SuperMinHash signatures of texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
POSITIONS = 200
CHUNK = 40_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words; of all words if there are fewer.

    A-Z count as a-z; words are runs of anything but a space and the controls 9 to 13.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    odd = _ODD if words <= len(_ODD) else np.random.default_rng(5).integers(0, 1 << 63, words, np.uint64) * np.uint64(2) + np.uint64(1)
    length = min(words, len(hashed))
    total = np.full(len(hashed) - length + 1, length, np.uint64)
    for i in range(length):
        total += hashed[i:len(hashed) - length + 1 + i] * odd[i]
    return np.unique(mixed(total))


def set_id(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def signatures(sets: list[np.ndarray], positions: int = POSITIONS) -> np.ndarray:
    """One row of ``positions`` numbers for each set that is not empty.

    Element by element a random order of all positions is drawn; at level j the element
    offers its position number j the value j plus a random fraction, and every position keeps
    its least offer. Ranks within one element are thus correlated, which lowers the variance.
    A set is done at the first level after which no position can be improved. All sets of a
    chunk go through a level together. Values are level * 2^32 + fraction.
    """
    out = np.full((len(sets), positions), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets])
    begin = 0
    while begin < len(sets):
        end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), CHUNK, side="right")))
        _chunk(sets[begin:end], out[begin:end], positions)
        begin = end
    return out


def _chunk(sets: list[np.ndarray], out: np.ndarray, positions: int) -> None:
    if len(sets) == 1 and len(sets[0]) > CHUNK:
        # One very long text: part by part, each with all levels, then the least of the parts.
        parts = [sets[0][i:i + CHUNK] for i in range(0, len(sets[0]), CHUNK)]
        each = np.full((1, positions), np.iinfo(np.uint64).max, np.uint64)
        for part in parts:
            one = np.full((1, positions), np.iinfo(np.uint64).max, np.uint64)
            _chunk([part], one, positions)
            np.minimum(each, one, out=each)
        out[:] = each
        return
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    order = None
    for level in range(positions):
        if not len(elements):
            return
        drawn = mixed(elements + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        fraction = drawn >> np.uint64(32)
        pick = level + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(positions - level)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            at = pick
        else:
            rows = np.arange(len(elements))
            at = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, level]
        np.minimum.at(flat, owner * positions + at, np.uint64(level << 32) | fraction)
        # A position whose value is of this level or less cannot be improved by a later one.
        done = (out.max(1) >> np.uint64(32)) <= level
        stay = ~done[owner]
        if order is None:
            elements, owner, pick = elements[stay], owner[stay], pick[stay]
            order = np.tile(np.arange(positions, dtype=np.int16), (len(elements), 1))
            order[np.arange(len(elements)), pick] = 0
        elif not stay.all():
            elements, owner, order = elements[stay], owner[stay], order[stay]


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A signed 64-bit key for each run of ``rows`` positions, different between bands."""
    bands = signature.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(40), (len(signature), bands)).copy()
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, i:bands * rows:rows])
    return key.view(np.int64)


def short_form(signature: np.ndarray) -> np.ndarray:
    """16 bits of each position, for counting positions that agree."""
    return (mixed(signature) & np.uint64(0xFFFF)).astype(np.uint16)
