"""Hashes of word sequences in numpy, shared by the operators on word windows and shingles."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed at once at least; a cut never splits a word.
CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class WordHashes:
    """64-bit hash of each word of a text, the same in every process, without a look at single words.

    A word's hash is a polynomial in an odd base over random values of its bytes, taken from one
    running sum over the text, then mixed with its length.
    """

    def __init__(self):
        rng = np.random.default_rng(8_191)
        self.values = rng.integers(0, 2**64, 256, np.uint64)
        self.base = int(rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
        self._grow(CHUNK)

    def _grow(self, n: int) -> None:
        inverse = pow(self.base, -1, 2**64)
        self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (self.base, inverse))

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words between ASCII white space."""
        data = np.frombuffer(text, np.uint8)
        if len(data) <= CHUNK:
            return self._part(data)
        parts, at = [], 0
        while at < len(data):
            upto = at + CHUNK
            while upto < len(data) and not _SPACE[data[upto]]:
                upto += 1
            parts.append(self._part(data[at:upto]))
            at = upto
        return np.concatenate(parts)

    def _part(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self._grow(2 * len(data))
        solid = np.zeros(len(data) + 2, bool)
        np.logical_not(_SPACE[data], out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts], (ends - starts).astype(np.uint64))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair (a, b), element by element."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k words, by doubling."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    whole, at, part, width, rest = None, 0, hashes, 1, k
    while True:
        if rest & 1:
            piece = part[at : at + n]
            whole = piece if whole is None else mix(whole, piece)
            at += width
        rest >>= 1
        if not rest:
            return whole
        part = mix(part[:-width], part[width:])
        width *= 2


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k neighbours, by doubling."""
    n, width = len(x) - k + 1, 1
    if n <= 0:
        return np.empty(0, x.dtype)
    while width * 2 <= k:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[k - width : k - width + n])
