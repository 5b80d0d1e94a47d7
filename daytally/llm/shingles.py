"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
_SEGMENT = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Lower-casing and a random number for each byte in one step.
_BYTE = mix(_LOWER.astype(np.uint64) + np.uint64(1))
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, _SEGMENT), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte array whose words are whole: a polynomial over the word's bytes."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _ODD, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts]
    return starts, mix(hashes + (ends - starts).astype(np.uint64))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments keep the working memory bounded for texts of any length."""
    out, at = [], 0
    while at < len(data):
        end = min(at + _SEGMENT, len(data))
        if end < len(data):
            blanks = np.flatnonzero(_BLANK[data[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:  # one word is longer than a segment
                while end < len(data) and not _BLANK[data[end]]:
                    end += 1
        starts, hashes = _segment_words(data[at:end])
        out.append((starts + at, hashes))
        at = end
    return (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])) if out else (np.zeros(0, int),) * 2


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words, or of all its words if it has fewer.

    Words are runs of other characters than ASCII white space, A-Z lower-cased. A null or blank text has no shingles.
    """
    values = [v or b"" for v in texts.cast(pa.binary()).to_pylist()]
    joined = b" ".join(values)
    begins = np.cumsum([0] + [len(v) + 1 for v in values])
    starts, hashes = _word_hashes(np.frombuffer(joined, np.uint8))
    of = np.searchsorted(starts, begins)
    runs = np.zeros(len(hashes), np.uint64)
    for k in range(min(size, len(hashes))):
        weight = mix(np.uint64([k + 1]))[0] | np.uint64(1)
        runs[: len(hashes) - k] += hashes[k:] * weight
    runs = mix(runs)
    for low, high in zip(of[:-1], of[1:], strict=True):
        n = high - low
        if n >= size:
            yield np.unique(runs[low : high - size + 1])
        elif n:
            weights = mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1000 * n))
            yield mix((hashes[low:high] * (weights | np.uint64(1))).sum(keepdims=True, dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two sorted sets that are not empty."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(a) + len(b) - shared)
