"""Word shingles of texts as sets of 64-bit hashes, and MinHash signatures of them."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
COORDS = 128

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers from any (the splitmix64 finaliser)."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


_FACTORS = mixed(np.arange(1, COORDS + 1, dtype=np.uint64)) | np.uint64(1)


def words_of(data: bytes) -> list[bytes]:
    """Words in lower case, parted by the six blanks."""
    return data.decode().lower().encode().split()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """One code for each run of ``width`` words; a shorter text is one run by itself."""
    if not len(codes):
        return codes
    width = min(width, len(codes))
    n = len(codes) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mixed(out ^ codes[k : k + n])
    return out


def shingle_set(data: bytes, width: int = WORDS) -> np.ndarray:
    """The different shingles of a text, in order of their hashes; empty without words."""
    return np.unique(window_codes(word_codes(words_of(data)), width))


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signature(shingles: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """For each coordinate the least hash of the set, 32 bits; two sets agree in one as often as they are similar."""
    out = np.full(coords, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 4096):
        part = (shingles[None, at : at + 4096] * _FACTORS[:coords, None]) >> np.uint64(32)
        out = np.minimum(out, part.min(axis=1).astype(np.uint32))
    return out


def signatures(shingles: np.ndarray, first: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """The signature of each of the sets, none of them empty, that follow one another from the places ``first`` on."""
    least = [np.minimum.reduceat(shingles * factor, first) >> np.uint64(32) for factor in _FACTORS[:coords]]
    return np.stack(least, axis=1).astype(np.uint32)
