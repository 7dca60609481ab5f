"""N-grams of a batch of texts in an open-addressed table of NumPy arrays.

Words are runs of ASCII letters and digits (A-Z in lower case) and of all characters beyond ASCII.
The words of a batch stand in one buffer, a space after each, so an n-gram is a stretch of that
buffer. All occurrences are hashed (xxhash64) and looked up together: every round each open
occurrence looks at one slot, claims it if it is free, is done if the slot holds the same hash and the same
bytes, and else goes on to the next slot. A slot has the bucket of its n-gram and how often it occurs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

#: Bytes of text that are interned together; a longer text is cut at a separator.
SLICE = 1 << 22
#: Slots that a table begins with; it grows when half of them are taken.
SLOTS = 1 << 18
#: N-grams from this length on are hashed by the library, and compared by Python.
_LONG = 32
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(_WORD).split()


def _rotated(h: np.ndarray, by: int) -> np.ndarray:
    return (h << np.uint64(by)) | (h >> np.uint64(64 - by))


class Stretches:
    """Stretches of a buffer: their hashes, and whether two hold the same bytes."""

    def __init__(self, buffer: bytes, starts: np.ndarray, lengths: np.ndarray):
        self.buffer, self.starts, self.lengths = buffer, starts, lengths
        padded = np.frombuffer(buffer + bytes(8), np.uint8)
        #: Eight bytes from every place on.
        self.eight = np.ndarray(len(buffer) + 1, "<u8", padded, strides=(1,))

    def bytes_of(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.starts[i] + self.lengths[i]]

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        sizes = np.minimum(self.lengths, _LONG)
        for size in np.flatnonzero(np.bincount(sizes, minlength=_LONG + 1)):
            at = np.flatnonzero(sizes == size)
            if size == _LONG:
                out[at] = [xxhash.xxh64_intdigest(self.bytes_of(i)) for i in at.tolist()]
            else:
                out[at] = self._hashes(self.starts[at], int(size))
        return out

    def _hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """xxhash64 (seed 0) of ``size`` < 32 bytes from each place."""
        h = np.full(len(at), _P5 + np.uint64(size), np.uint64)
        done = 0
        while size - done >= 8:
            h ^= _rotated(self.eight[at + done] * _P2, 31) * _P1
            h = _rotated(h, 27) * _P1 + _P4
            done += 8
        rest = self.eight[at + done]
        if size - done >= 4:
            h ^= (rest & np.uint64(0xFFFFFFFF)) * _P1
            h = _rotated(h, 23) * _P2 + _P3
            done += 4
            rest = rest >> np.uint64(32)
        for _ in range(size - done):
            h ^= (rest & np.uint64(0xFF)) * _P5
            h = _rotated(h, 11) * _P1
            rest = rest >> np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether stretches ``a`` and ``b`` hold the same bytes, pair by pair."""
        equal = self.lengths[a] == self.lengths[b]
        at = np.flatnonzero(equal & (a != b) & (self.lengths[a] > 0))
        long = self.lengths[a[at]] >= _LONG
        for i in at[long].tolist():
            equal[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        at, done = at[~long], 0
        while len(at):
            left = self.lengths[a[at]] - done
            unused = np.uint64(8) * (np.uint64(8) - np.clip(left, 1, 8).astype(np.uint64))
            differ = (self.eight[self.starts[a[at]] + done] ^ self.eight[self.starts[b[at]] + done]) << unused
            equal[at[differ != 0]] = False
            at, done = at[(differ == 0) & (left > 8)], done + 8
        return equal


@dataclass
class Interned:
    """The n-grams of some texts: occurrences with their text and slot, slots with bucket and count."""

    n_words: np.ndarray
    owner: np.ndarray
    slot: np.ndarray
    bucket: np.ndarray
    count: np.ndarray

    def per_text(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each text, and the sum of ``values`` (integers by slot) over them."""
        total = np.concatenate([[0], np.cumsum(values[self.slot])])
        cuts = np.searchsorted(self.owner, np.arange(len(self.n_words) + 1))
        return np.diff(cuts), total[cuts[1:]] - total[cuts[:-1]]


def _placed(stretches: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every stretch, and which stretch stands for each slot (-1: free)."""
    h, slots = stretches.hashes(), SLOTS
    while True:
        keys, holder, taken = np.zeros(slots, np.uint64), np.full(slots, -1, np.int64), 0
        mask = np.uint64(slots - 1)
        slot = (h & mask).astype(np.int64)
        left = np.arange(len(h))
        while len(left) and 2 * taken <= slots:
            at = slot[left]
            free = np.flatnonzero(holder[at] < 0)
            holder[at[free]] = left[free]  # of several that claim a slot, the last gets it
            keys[at[free]] = h[holder[at[free]]]
            taken += int((holder[at[free]] == left[free]).sum())
            hit = np.flatnonzero(keys[at] == h[left])
            hit = hit[stretches.same(left[hit], holder[at[hit]])]
            open_ = np.ones(len(left), bool)
            open_[hit] = False
            left = left[open_]
            slot[left] = (slot[left] + 1) & (slots - 1)
        if not len(left):
            return slot, holder
        slots *= 4


def intern(pieces: list[tuple[list[bytes], int]], max_n: int, buckets: int) -> Interned:
    """All runs of 1 to ``max_n`` words within each piece.

    A piece is a list of words and how many of the first were already counted as the end of the
    piece before: n-grams within those are left out.
    """
    sizes = np.array([len(words) for words, _ in pieces], np.int64)
    known = np.array([n for _, n in pieces], np.int64)
    buffer = b"".join(b" ".join(words) + b" " for words, _ in pieces if words)
    ends = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    piece = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    owners, begins, lengths = [], [], []
    for n in range(1, max_n + 1):
        last = np.arange(n - 1, len(piece))
        first = last - (n - 1)
        ok = (piece[first] == piece[last]) & (place[last] >= known[piece[last]])
        first, last = first[ok], last[ok]
        owners.append(piece[first])
        begins.append(starts[first])
        lengths.append(ends[last] - starts[first])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable") if max_n > 1 else slice(None)
    stretches = Stretches(buffer, np.concatenate(begins)[order], np.concatenate(lengths)[order])
    slot, holder = _placed(stretches)
    bucket = np.zeros(len(holder), np.int64)
    used = np.flatnonzero(holder >= 0)
    begin = stretches.starts[holder[used]]
    end = begin + stretches.lengths[holder[used]]
    bucket[used] = [zlib.crc32(buffer[a:b]) % buckets for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return Interned(sizes - known, owner[order], slot, bucket, np.bincount(slot, minlength=len(holder)))


def batches_of(texts: list[str | None], max_n: int) -> Iterator[tuple[list[int], list[tuple[list[bytes], int]]]]:
    """Pieces for ``intern`` with the text each belongs to; a long text comes as several pieces."""
    of, pieces, held = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        before: list[bytes] = []
        for part in _parts(data):
            words = [*before, *words_of(part)]
            of.append(i)
            pieces.append((words, len(before)))
            held += len(part)
            before = words[len(words) - (max_n - 1) :] if max_n > 1 else []
            if held >= SLICE:
                yield of, pieces
                of, pieces, held = [], [], 0
    if pieces:
        yield of, pieces


def _parts(data: bytes) -> Iterator[bytes]:
    """``data`` whole, or in parts that end at a separator (a longer word stays whole)."""
    start = 0
    while len(data) - start > SLICE:
        end = start + SLICE
        while end < len(data) and _WORD[data[end]] != 32:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]
