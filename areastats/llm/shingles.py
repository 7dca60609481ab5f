"""Sets of hashed word shingles.

Words are runs without ASCII white space, A-Z in lower case. The set of a text has the 64-bit hashes
of its distinct runs of five words; a shorter text is one shingle, a text without words has none.

A word's hash is a polynomial in its bytes, so the hashes of all words of many texts come from one
running sum: what lies between two places, divided by the power at which it begins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from areastats.llm.common import worker_store

WIDTH = 5
#: Bytes that are hashed together; longer texts are cut at white space.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15


class Shingler:
    """Sorted shingle hashes of texts."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.value = mixed(np.arange(1, 257, dtype=np.uint64))

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The base to the powers below ``n``, and their inverses."""
        store = worker_store()
        if "powers" not in store or len(store["powers"][0]) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            steps = (np.full(max(n, 2 * SLICE), b, np.uint64) for b in (_BASE, inverse))
            store["powers"] = tuple(np.cumprod(np.where(np.arange(len(s)) > 0, s, np.uint64(1)), dtype=np.uint64) for s in steps)
        return tuple(p[:n] for p in store["powers"])

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin, and their hashes."""
        raw = np.frombuffer(data, np.uint8)
        blank = np.ones(len(raw) + 2, bool)
        blank[1:-1] = self.space[raw]
        starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        up, down = self.powers(len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[self.lower[raw]] * up, out=total[1:])
        return starts, mixed((total[ends] - total[starts]) * down[starts]) if len(starts) else total[:0]

    def sets(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The set of every text, in order; texts are hashed together up to ``SLICE`` bytes."""
        group, size = [], 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            if len(data) >= SLICE:
                yield from self._sets(group)
                yield self._of(np.concatenate([self.words(part)[1] for part in slices(data)]))
                group, size = [], 0
                continue
            group.append(data)
            size += len(data)
            if size >= SLICE:
                yield from self._sets(group)
                group, size = [], 0
        yield from self._sets(group)

    def _sets(self, group: list[bytes]) -> Iterator[np.ndarray]:
        starts, words = self.words(b" ".join(group))
        begins = np.cumsum([0, *(len(d) + 1 for d in group)])
        cuts = np.searchsorted(starts, begins).tolist()
        h = self._runs(words, self.width) if len(words) >= self.width else words[:0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield distinct(h[a : b - self.width + 1]) if b - a >= self.width else self._of(words[a:b])

    def _of(self, words: np.ndarray) -> np.ndarray:
        return distinct(self._runs(words, min(self.width, len(words)))) if len(words) else words

    def _runs(self, words: np.ndarray, width: int) -> np.ndarray:
        count = len(words) - width + 1
        h = words[:count].copy()
        for i in range(1, width):
            h *= np.uint64(_BASE)
            h += words[i : i + count]
        return mixed(h + np.uint64(width))


def slices(data: bytes) -> Iterator[bytes]:
    """Parts of about ``SLICE`` bytes, cut at spaces or line breaks (a longer word stays whole)."""
    start = 0
    while start < len(data):
        end = start + SLICE
        if end < len(data):
            cut = max(data.rfind(b" ", start, end), data.rfind(b"\n", start, end))
            if cut <= start:
                later = [c for c in (data.find(b" ", end), data.find(b"\n", end)) if c >= 0]
                cut = min(later, default=len(data))
            end = cut
        yield data[start:end]
        start = end


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(shingles: np.ndarray) -> int:
    """64 bits (signed) that tell sets apart, whatever the order of their elements."""
    total = mixed(shingles + np.uint64(1)).sum(dtype=np.uint64) ^ (shingles.sum(dtype=np.uint64) << np.uint64(1))
    return int(mixed(np.array([total + np.uint64(len(shingles))]))[0].astype(np.int64))


def signature(shingles: np.ndarray) -> bytes:
    """How many elements fall into each of about ``len / 2`` slots; nothing if a count does not fit a byte."""
    slots = 1 << max(0, (max(len(shingles), 2) - 1).bit_length() - 1)
    counts = np.bincount((shingles & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def least_distance(a: bytes, b: bytes, n_a: int, n_b: int) -> float:
    """A lower bound of the Jaccard distance from signatures and sizes.

    Slots map sets to counts, and their differences add up to no more than the sets differ by.
    """
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] + x[len(x) // 2 :]
    differ = int(np.abs(x - y).sum())
    return 2 * differ / (n_a + n_b + differ)
