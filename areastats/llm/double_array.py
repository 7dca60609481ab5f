"""Double-array trie: all transitions of a byte trie in two integer arrays.

State ``s`` goes by byte ``c`` to ``base[s] + c + 1`` if ``check`` of that place is ``s``. A third
array has the value of the key that ends in a state, or -1. Arrays are walked for many texts at
once, so a step is a few numpy calls whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np

#: Places looked at together when the arrays are built.
_BLOCK = 512


class DoubleArray:
    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: Mapping[bytes, int]) -> DoubleArray:
        """``keys`` are not empty; values are not negative."""
        root: dict = {}
        for key, value in keys.items():
            node = root
            for byte in key:
                node = node.setdefault(byte, {})
            node[None] = value
        size = 1 << 16
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        free, queue = 1, [(0, root)]
        for state, node in queue:
            if None in node:
                value[state] = node[None]
            codes = np.array(sorted(byte + 1 for byte in node if byte is not None))
            if not len(codes):
                continue
            # First fit, a block of places at a time.
            at = max(free, int(codes[0]))
            while True:
                if at + 2 * _BLOCK > size:
                    base, check, value = (np.append(a, np.full(size, f, np.int32)) for a, f in ((base, 0), (check, -1), (value, -1)))
                    taken = np.append(taken, np.zeros(size, bool))
                    size *= 2
                fits = ~taken[at : at + _BLOCK]
                for gap in codes[1:] - codes[0]:
                    fits &= ~taken[at + gap : at + gap + _BLOCK]
                if fits.any():
                    at += int(fits.argmax())
                    break
                at += _BLOCK
            offset = at - int(codes[0])
            base[state] = offset
            taken[offset + codes] = True
            check[offset + codes] = state
            queue += [(offset + c, node[c - 1]) for c in codes.tolist()]
            while taken[free : free + _BLOCK].mean() > 0.95:
                free += _BLOCK
        return cls(base, check, value)

    def matches(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Every key at every place of every row of bytes.

        ``rows`` holds a text per row as byte + 1, with zeros after its end. Yields the length, and
        for all matches of that length row, place and value.
        """
        width = rows.shape[1]
        flat = rows.ravel()
        place = np.flatnonzero(flat)
        state = np.zeros(len(place), np.int64)
        column = place % width if width else place
        length = 0
        while len(place):
            inside = column + length < width
            if not inside.all():
                place, state, column = place[inside], state[inside], column[inside]
            code = flat[place + length].astype(np.int64)
            target = self.base[state] + code
            ok = (self.check[target] == state) & (code > 0)
            place, state, column = place[ok], target[ok], column[ok]
            length += 1
            value = self.value[state]
            ends = value >= 0
            if ends.any():
                yield length, place[ends] // width, column[ends], value[ends]
