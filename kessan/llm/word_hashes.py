"""Words of many texts at once, as hashes, with numpy.

A word is a run of bytes outside the six white-space bytes 0x20 and 0x09 to 0x0D. Hashes are
polynomials over 64-bit integers, taken from prefix sums, so that the hash of any stretch of
bytes or words is one subtraction and one product.
"""

from __future__ import annotations

import numpy as np

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo two to the 64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size, out = 1 << max(n - 1, 1).bit_length(), []
        for factor in (base, pow(base, -1, 1 << 64)):
            column = np.full(size, factor, np.uint64)
            column[0] = 1
            out.append(np.cumprod(column, dtype=np.uint64))
        _powers[base] = (out[0], out[1])
    return _powers[base]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each stretch ``[start, end)``, its length included."""
    found = (sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts]
    return mixed(found + (ends - starts).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after the other, and where each text's words begin
    (with the end of the last)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    hashes = stretch_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1), _BYTE_BASE), starts, ends, _BYTE_BASE)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, at)


def gram_sums(hashes: np.ndarray) -> np.ndarray:
    return prefix_sums(hashes, _WORD_BASE)


def gram_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return stretch_hashes(sums, starts, ends, _WORD_BASE)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        covered += step
    return out
