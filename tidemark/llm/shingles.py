"""Character shingles of many lines at once, as sorted sets of 52-bit hashes in numpy.

A line's shingles are the ``CHARS`` code points that begin at each of its characters; a shorter
line is its own only shingle, so it is filled up with a character that no text can hold. A group of
lines is hashed in one pass; a line longer than ``PIECE`` is a group of its own and goes piece by
piece, so that temporary arrays stay small whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHARS = 10
PIECE = 1 << 18
GROUP = 4096
BITS = np.uint64(52)
LOW = np.uint64((1 << 52) - 1)
#: A lone surrogate: it cannot stand in UTF-8 text.
FILL = "\udfff"


def constants(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd 64-bit numbers (the SplitMix64 sequence)."""
    with np.errstate(over="ignore"):
        state = np.uint64(seed) + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(state) | np.uint64(1)


def mixed(z: np.ndarray) -> np.ndarray:
    """The finalising steps of SplitMix64: every bit of the input moves every bit of the result."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


PLACES = constants(CHARS, 1)


def _windows(text: str) -> np.ndarray:
    """A hash of the ``CHARS`` code points from every place of ``text`` on."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = len(codes) - CHARS + 1
    out = codes[:size] * PLACES[0]
    for k in range(1, CHARS):
        out += codes[k : k + size] * PLACES[k]
    return mixed(out) >> np.uint64(64 - 52)


def groups(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Runs ``lines[a:b]`` of about ``PIECE`` characters and at most ``GROUP`` lines."""
    start, size = 0, 0
    for k, line in enumerate(lines):
        if k > start and (size + len(line) > PIECE or k - start == GROUP):
            yield start, k
            start, size = k, 0
        size += len(line)
    if lines:
        yield start, len(lines)


def sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, starts)`` of one group: the sorted distinct shingles of line ``k`` are
    ``hashes[starts[k]:starts[k + 1]]``. No line is empty."""
    if len(lines) == 1 and len(lines[0]) > PIECE:
        line = lines[0]
        found = np.empty(0, np.uint64)
        for at in range(0, len(line) - CHARS + 1, PIECE):
            found = np.union1d(found, _windows(line[at : at + PIECE + CHARS - 1]))
        return found, np.array([0, len(found)])
    filled = [line.ljust(CHARS, FILL) for line in lines]
    lengths = np.array([len(line) for line in filled])
    hashes = _windows("".join(filled))
    inside = np.ones(len(hashes), bool)  # windows that reach into the next line are none
    ends = np.cumsum(lengths)[:-1]
    inside[(ends[:, None] - np.arange(1, CHARS)).ravel()] = False
    owner = np.repeat(np.arange(len(lines), dtype=np.uint64), lengths - CHARS + 1)
    keys = np.sort(hashes[inside] | (owner << BITS))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    starts = np.searchsorted(keys, np.arange(len(lines) + 1, dtype=np.uint64) << BITS)
    return keys & LOW, starts


def minima(hashes: np.ndarray, starts: np.ndarray, masks: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Per line and permutation (a mask, then an odd factor) the least permuted hash."""
    out = np.empty((len(starts) - 1, len(masks)), np.uint64)
    if len(starts) == 2:
        out[:] = np.iinfo(np.uint64).max
        for at in range(0, len(hashes), PIECE):
            part = hashes[at : at + PIECE]
            for k, (mask, odd) in enumerate(zip(masks, odds, strict=True)):
                out[0, k] = min(out[0, k], ((part ^ mask) * odd).min())
        return out
    for k, (mask, odd) in enumerate(zip(masks, odds, strict=True)):
        out[:, k] = np.minimum.reduceat((hashes ^ mask) * odd, starts[:-1])
    return out


def similarities(left: list[str], right: list[str]) -> np.ndarray:
    """Jaccard similarity of ``left[k]`` and ``right[k]``."""
    out = np.empty(len(left))
    for a, b in groups([x if len(x) >= len(y) else y for x, y in zip(left, right, strict=True)]):
        one, two = _distinct_of(left[a:b]), _distinct_of(right[a:b])
        sizes = np.array([len(x) + len(y) for x, y in zip(one, two, strict=True)])
        if b - a == 1:
            both = np.array([len(np.intersect1d(one[0], two[0], assume_unique=True))])
        else:
            owner = lambda s: np.repeat(np.arange(b - a, dtype=np.uint64), [len(x) for x in s]) << BITS  # noqa: B023, E731
            met = np.intersect1d(np.concatenate(one) | owner(one), np.concatenate(two) | owner(two), assume_unique=True)
            both = np.bincount((met >> BITS).astype(np.int64), minlength=b - a)
        out[a:b] = both / (sizes - both)
    return out


def _distinct_of(lines: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingles of every line."""
    out = []
    for a, b in groups(lines):
        hashes, starts = sets(lines[a:b])
        out += np.split(hashes, starts[1:-1])
    return out


def crossed(left: list[str], right: list[str], columns: int = 4096) -> np.ndarray:
    """Jaccard similarity of every line of one small block and every line of another one."""
    one, two = _distinct_of(left), _distinct_of(right)
    known = np.unique(np.concatenate(one + two))
    both = np.zeros((len(one), len(two)), np.float64)
    for at in range(0, len(known), columns):
        part = known[at : at + columns]
        both += _incidence(one, part) @ _incidence(two, part).T
    sizes = np.add.outer([len(x) for x in one], [len(x) for x in two])
    return both / (sizes - both)


def _incidence(lines: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lines), len(known)), np.float32)
    for k, found in enumerate(lines):
        a, b = np.searchsorted(found, known[0]), np.searchsorted(found, known[-1], "right")
        out[k, np.searchsorted(known, found[a:b])] = 1
    return out
