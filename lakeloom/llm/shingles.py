"""Word shingles as 64-bit hashes, and HyperMinHash signatures of their sets (NumPy; no Spark here)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Registers of a signature, and of one band. A band's four 16-bit registers fill one 64-bit word.
REGISTERS, BAND = 128, 4
BANDS = REGISTERS // BAND
#: Mantissa bits beside the six bits of the leading-zero count.
MANTISSA = 10
#: Words that a worker remembers at once.
CACHE = 200_000

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(0, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_BAND_MARK = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of `width` words as sorted hashes. Words lie between ASCII white space, A-Z lower-cased;
    fewer words than `width` are one shingle, and no words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(n, width)
    acc = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        acc = mixed(acc ^ h[i : n - k + 1 + i]) * _PLACE[i % 16]
    return np.unique(acc)


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signature(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS registers: each has the leading-zero count and the mantissa of the least of its own hash values."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, ((shingles[i : i + 512, None] ^ _XOR) * _MUL).min(axis=0), out=least)
    mantissa, bits = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - bits, 0, 63).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, REGISTERS) registers -> (n, BANDS) keys."""
    return mixed(np.ascontiguousarray(signatures).view(np.uint64) ^ _BAND_MARK).view(np.int64)


def corrected(agreeing: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard estimate from the number of agreeing registers, less the agreement expected by chance: two
    different minima fall into one register value with probability about 2**-MANTISSA * n_a*n_b/(n_a+n_b)**2, times
    the mean of 2**-u over u in [0, 1), as a value's width is its leading power of two."""
    chance = 2.0**-MANTISSA / (2 * np.log(2)) * n_a * n_b / np.maximum((n_a + n_b) ** 2, 1)
    return (agreeing / REGISTERS - chance) / (1 - chance)
