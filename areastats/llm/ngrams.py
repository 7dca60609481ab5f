"""Character n-grams of whole texts as counts in a fixed number of hashed slots.

Texts are read in slices, so memory does not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import worker_store

#: Characters looked at together.
SLICE = 1 << 18
_SPACE = 32


def letters_table() -> np.ndarray:
    """Every letter as its lower case, everything else as a space."""

    def code(i: int) -> int:
        c = chr(i)
        return ord(c.lower()[0]) if c.isalpha() else _SPACE

    table = np.fromiter((code(i) for i in range(0x30000)), np.uint32, 0x30000)
    return np.concatenate([table, np.full(0x110000 - 0x30000, _SPACE, np.uint32)])


def shapes_table() -> np.ndarray:
    """Every character as its kind: small or capital letter, digit, space; ASCII marks stay themselves."""

    def code(i: int) -> int:
        c = chr(i)
        if c.isalpha():
            return ord("A") if c.isupper() else ord("a")
        if c.isdigit():
            return ord("0")
        return i if i < 128 else _SPACE if c.isspace() else 1

    table = np.fromiter((code(i) for i in range(0x30000)), np.uint32, 0x30000)
    return np.concatenate([table, np.full(0x110000 - 0x30000, 1, np.uint32)])


_TABLES = {"letters": letters_table, "shapes": shapes_table}


class NGrams:
    """Counts of n-grams of mapped characters; runs of one character count as ``run`` at most."""

    def __init__(self, table: str, orders: tuple[int, ...], slots: int, run: int):
        store = worker_store()
        if table not in store:
            store[table] = _TABLES[table]()
        self.table, self.orders, self.slots, self.run = store[table], orders, slots, run
        self.shift = 32 - (slots.bit_length() - 1)

    def counts(self, text: str) -> np.ndarray:
        out = np.zeros(self.slots, np.int64)
        tail, longest = np.array([_SPACE], np.uint32), max(self.orders)
        for start in range(0, len(text), SLICE):
            raw = np.frombuffer(text[start : start + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = np.concatenate([tail, self.table[raw]])
            if start + SLICE >= len(text):
                codes = np.append(codes, np.uint32(_SPACE))
            if len(codes) > self.run:
                same = codes[self.run :] == codes[: -self.run]
                for k in range(1, self.run):
                    same &= codes[self.run :] == codes[k : k - self.run]
                codes = np.concatenate([codes[: self.run], codes[self.run :][~same]])
            for n in self.orders:
                # What lies within the tail has been counted with the slice before.
                first = min(len(tail), longest - 1) - n + 1 if start else 0
                grams = codes[max(first, 0) :]
                if len(grams) < n:
                    continue
                h = grams[: len(grams) - n + 1] * np.uint32(0x9E3779B1) + np.uint32(n)
                for k in range(1, n):
                    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + grams[k : len(grams) - n + 1 + k] * np.uint32(0xC2B2AE35)
                h = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
                out += np.bincount(h >> np.uint32(self.shift), minlength=self.slots)
            tail = codes[max(0, len(codes) - longest + 1) :]
        return out


def document_frequencies(texts: DataFrame, counter: Callable[[], Callable[[str], np.ndarray]]) -> tuple[int, np.ndarray]:
    """Number of rows of the one column ``text``, and per slot the rows that have it.

    Every task adds up its rows; what meets afterwards is one row per task and slot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, rows = counter(), None, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                has = (count(text or "") > 0).astype(np.int64)
                total = has if total is None else total + has
                rows += 1
        if total is not None:
            slot = np.append(np.flatnonzero(total), -1)
            n = np.append(total[total > 0], rows)
            yield pa.RecordBatch.from_arrays([pa.array(slot, type=pa.int32()), pa.array(n, type=pa.int64())], names=["slot", "n"])

    found = texts.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    frequencies = {r["slot"]: r["n"] for r in found}  # at most one entry per slot
    rows = frequencies.pop(-1, 0)
    out = np.zeros(max(frequencies, default=0) + 1, np.int64)
    out[list(frequencies)] = list(frequencies.values())
    return rows, out


def inverse_frequencies(rows: int, frequencies: np.ndarray, slots: int) -> np.ndarray:
    padded = np.zeros(slots)
    padded[: len(frequencies)] = frequencies
    return (np.log((1 + rows) / (1 + padded)) + 1).astype(np.float32)
