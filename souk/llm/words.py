"""Words as 64-bit hashes in NumPy arrays, for the operators that compare word sequences inside tasks.

Words are runs without space or ASCII 9 to 13. A word's hash is a polynomial of its bytes with random coefficients,
taken for all words of a group of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed together; a longer text makes a group of its own.
GROUP = 1 << 19

_SALT = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers that depend on the seed alone."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _SALT) | np.uint64(1)


class WordHasher:
    """Hashes of all words of byte strings. ``fold`` ignores the case of A-Z; bytes in ``ignored`` do not count."""

    def __init__(self, fold: bool = False, ignored: bytes = b""):
        self._letters = constants(256, 17)
        if fold:
            self._letters[0x41:0x5B] = self._letters[0x61:0x7B]
        self._ignored = np.zeros(256, bool)
        self._ignored[list(ignored)] = True
        self._powers = constants(1, 19)

    def _power(self, n: int) -> np.ndarray:
        if len(self._powers) < n:
            self._powers = np.cumprod(np.full(2 * n, constants(1, 19)[0], np.uint64), dtype=np.uint64)
        return self._powers

    def hash(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in turn, and where each text's words start (one entry more)."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        if self._ignored.any():
            kept = ~self._ignored[data]
            ends = np.cumsum(kept)[ends - 1]
            data = data[kept]
        inside = ~_SPACES[data]
        edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        first = np.concatenate([[0], np.searchsorted(starts, ends)])
        if not len(starts):
            return np.empty(0, np.uint64), first
        lengths = stops - starts
        begins = np.cumsum(lengths) - lengths
        letters = data[inside]
        places = np.arange(len(letters)) - np.repeat(begins, lengths)
        values = self._letters[letters] * self._power(int(lengths.max()))[places]
        return mixed(np.add.reduceat(values, begins) ^ lengths.astype(np.uint64)), first

    def groups(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(row, hashes, starts)`` for consecutive groups of rows of a text column; null texts have no words."""
        texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP):
                size += len(texts[stop])
                stop += 1
            yield at, *self.hash(texts[at:stop])
            at = stop


def grams(hashes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``k`` hashes, by start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = constants(k, seed)
    total = hashes[:n] * factors[0]
    for j in range(1, k):
        total += hashes[j : j + n] * factors[j]
    return mixed(total)


def joined(arrays, dtype=np.uint64) -> np.ndarray:
    arrays = list(arrays)
    return np.concatenate(arrays) if arrays else np.empty(0, dtype)
