"""Elias-Fano code of a rising sequence, with select.

``n`` numbers up to ``u`` take about ``2 + log2(u / n)`` bits each. The low bits of every number
are stored as they are; the high bits as a bit array in which number ``i`` sets bit
``high(i) + i``. Number ``i`` is found by selecting the one with rank ``i``: the place of every
``STEP``-th one is stored, and the ones between two places are counted in one short slice.
"""

from __future__ import annotations

import struct

import numpy as np

#: Ones between two stored places.
STEP = 64
_HEAD = "<QBQQQ"


class EliasFano:
    """Read access to the encoded numbers; ``encode`` and ``to_bytes`` make them."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.places = n, low_bits, low, high, places

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values`` must not fall and not be negative; there may be none."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n and np.any(values[1:] < values[:-1]):
            raise ValueError("values must not fall")
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((top >> low_bits) + n + 1, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, low_bits, low, np.packbits(flags, bitorder="little"), ones[::STEP].astype(np.uint64))

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Number ``i``, reading a stored place, a slice of the bit array and ``low_bits`` bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block, rank = divmod(i, STEP)
        start = int(self.places[block])
        stop = int(self.places[block + 1]) if block + 1 < len(self.places) else 8 * len(self.high)
        first = start // 8
        flags = np.unpackbits(self.high[first : stop // 8 + 1], bitorder="little")[start - 8 * first :]
        high = start + int(np.flatnonzero(flags)[rank]) - i
        low = 0
        if self.low_bits:
            at = i * self.low_bits
            bits = np.unpackbits(self.low[at // 8 : (at + self.low_bits - 1) // 8 + 1], bitorder="little")
            for k, bit in enumerate(bits[at % 8 : at % 8 + self.low_bits]):
                low |= int(bit) << k
        return (high << self.low_bits) | low

    def select_many(self, first: int, last: int) -> np.ndarray:
        """Numbers ``first`` to ``last - 1``, reading from one stored place to another."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last))
        block, end = first // STEP, -(-last // STEP)
        start = int(self.places[block]) if block < len(self.places) else 8 * len(self.high)
        stop = int(self.places[end]) if end < len(self.places) else 8 * len(self.high)
        byte = start // 8
        flags = np.unpackbits(self.high[byte : stop // 8 + 1], bitorder="little")[start - 8 * byte :]
        ones = np.flatnonzero(flags)[first - block * STEP : last - block * STEP] + start
        index = np.arange(first, last)
        high = (ones - index).astype(np.uint64) << np.uint64(self.low_bits)
        at = first * self.low_bits
        bits = np.unpackbits(self.low[at // 8 : -(-last * self.low_bits // 8)], bitorder="little")[at % 8 :]
        bits = bits[: len(index) * self.low_bits].reshape(len(index), self.low_bits).astype(np.uint64)
        return (high | (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)).astype(np.int64)

    def decode(self) -> np.ndarray:
        """All numbers."""
        return self.select_many(0, self.n)

    def to_bytes(self) -> bytes:
        head = struct.pack(_HEAD, self.n, self.low_bits, len(self.low), len(self.high), len(self.places))
        return head + self.low.tobytes() + self.high.tobytes() + self.places.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, a, b, c = struct.unpack_from(_HEAD, data)
        body = np.frombuffer(data, dtype=np.uint8, offset=struct.calcsize(_HEAD))
        return cls(n, low_bits, body[:a], body[a : a + b], body[a + b : a + b + 8 * c].view("<u8"))
