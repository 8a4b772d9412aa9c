"""Word-window hashing and winnowing, vectorised per document."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
_BLOCK = 1 << 20


def split_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return (text or "").encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def gram_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """The hash of every run of ``size`` words (polynomial over word hashes, by doubling)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mod = 1 << 64
    power, width = words, 1       # hashes of runs of ``width`` words
    done, length = None, 0        # hashes of the runs of the bits of ``size`` seen so far
    rest = size
    while rest:
        if rest & 1:
            if done is None:
                done, length = power, width
            else:
                m = len(words) - (length + width) + 1
                done = done[:m] * _U(pow(base, width, mod)) + power[length:length + m]
                length += width
        rest >>= 1
        if rest:
            m = len(words) - 2 * width + 1
            power = power[:m] * _U(pow(base, width, mod)) + power[width:width + m]
            width *= 2
    return mixed(done[:n])


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` keys, the position of its least key (the first of equal 44-bit prefixes)."""
    n = len(keys) - width + 1
    out = np.empty(max(n, 0), np.int64)
    for at in range(0, n, _BLOCK - width):
        part = keys[at:at + _BLOCK]
        tagged = (part & ~_U((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
        low, have = tagged, 1
        while have < width:
            step = min(have, width - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        got = (low & _U((1 << 20) - 1)).astype(np.int64) + at
        out[at:at + len(got)] = got
    return out
