"""Words of a text as 64-bit hashes, and hashes of runs of words; numpy, whole texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries of a worker's memo of word hashes.
MEMO = 150_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_MEMO = _Words()


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; lower: A-Z become a-z (bytes methods know ASCII only)."""
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers."""
    h = (h ^ (h >> _S30)) * _M1
    h = (h ^ (h >> _S27)) * _M2
    return h ^ (h >> _S31)


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; a shorter text has none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j : j + n] * np.uint64(pow(_BASE, j + 1, 1 << 64))
    return mix(out)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of the k-word shingles; of fewer words the whole sequence is the one shingle."""
    if not len(h):
        return np.zeros(0, np.uint64)
    return np.unique(runs(h, min(k, len(h))))
