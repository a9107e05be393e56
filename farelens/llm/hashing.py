"""Word and word-run hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _runs(seed: int, n: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype="uint64") * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes the words of a byte string: a polynomial of the bytes, found from
    running sums, with its length mixed in. ``kept`` tells which byte values
    belong to words, ``lower`` whether A-Z count as a-z."""

    def __init__(self, kept: np.ndarray, lower: bool):
        self.kept = kept
        self.value = np.arange(256, dtype="uint64") + np.uint64(1)
        if lower:
            self.value[65:91] = self.value[97:123]
        self.up = self.down = np.ones(1, "uint64")

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 20)
            steps = np.full(size, _BASE)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = _INVERSE
            self.down = np.cumprod(steps)

    def words(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and byte after of each word."""
        raw = np.frombuffer(blob, "uint8")
        if not len(raw):
            return np.zeros(0, "uint64"), np.zeros(0, "int64"), np.zeros(0, "int64")
        edge = np.diff(np.concatenate(([0], self.kept[raw], [0])).astype("int8"))
        first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._powers(len(raw) + 1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(self.value[raw] * self.up[: len(raw)])))
        return mix((sums[after] - sums[first]) * self.down[first] + (after - first).astype("uint64")), first, after

    def texts(self, docs: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts joined, their words' hashes and places, and for each text
        the place of its first word (one more entry: the number of words). The
        byte between texts is a space, which no hasher keeps."""
        blob = b" ".join(docs)
        hashes, first, after = self.words(blob)
        starts = np.cumsum([0] + [len(d) + 1 for d in docs])[: len(docs)]
        return blob, hashes, first, after, np.append(np.searchsorted(first, starts), len(hashes))


def run_hashes(words: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of the ``n`` words from each place on; none for the last n - 1."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, "uint64")
    out = np.zeros(size, "uint64")
    for j, c in enumerate(_runs(seed, n)):
        out += words[j : j + size] * c
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    out, reach = x, 1
    while reach * 2 <= width:
        out, reach = np.minimum(out[:-reach], out[reach:]), reach * 2
    return np.minimum(out[: len(x) - width + 1], out[width - reach :]) if reach < width else out


def kept_bytes(table: bytes) -> np.ndarray:
    """Which byte values a translation table keeps (does not turn to a space)."""
    return np.array([table[b] != 32 for b in range(256)])


#: Words are what stands between ASCII white space.
BETWEEN_SPACES = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
