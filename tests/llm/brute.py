"""Plain Python versions of what the operators compute, and a fixture that makes documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pytest
from pyspark.sql import functions as F

from areastats.llm.decontam import MASKS


@pytest.fixture
def docs(spark):
    """``docs([(id, text), ...])`` makes documents; more columns may be named with one value each."""

    def make(rows, schema="doc_id long, text string", **more):
        df = spark.createDataFrame([tuple(r) for r in rows], schema)
        return df.withColumns({c: F.lit(v) for c, v in more.items()}) if more else df

    return make

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    def ok(kind: str, value: str) -> bool:
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if ok(k, m.group())]


def shingles(text: str | None, width: int = 5) -> frozenset:
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(ids: Iterable, linked: Callable) -> dict:
    """Smallest reachable id of every id, by looking at all pairs."""
    ids = sorted(ids)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, j in enumerate(ids):
        for i in ids[:k]:
            a, b = find(i), find(j)
            if a != b and linked(i, j):
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def line_dedup(docs: list[tuple]) -> dict:
    """Kept text by (id, text), for ids that are not NULL."""
    first: dict[tuple, tuple] = {}
    lines = {}
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0], d[1] or "")):
        lines[doc_id, text] = re.split(r"(?<=\n)|(?<=[.!?] )", text) if text else []
    windows = []
    for (doc_id, text), parts in lines.items():
        for i in range(len(parts) - 2):
            key = tuple(p.strip(" \t\r\n") for p in parts[i : i + 3])
            if any(key):
                windows.append((key, (doc_id, text, i)))
                first[key] = min(first.get(key, (doc_id, text, i)), (doc_id, text, i))
    gone = {(*place[:2], place[2] + k) for key, place in windows if first[key] != place for k in range(3)}
    return {d: "".join(p for i, p in enumerate(parts) if (*d, i) not in gone) if d[1] else d[1] for d, parts in lines.items()}


def plain_search(rows, items, min_tokens=12):
    """Every offset at which some mask fits, and the best stretch along it."""
    classes = {}
    for item_id, text in items:
        tokens = tuple(re.findall(r"[^\W_]+", text.lower()))
        if tokens:
            classes[tokens] = min(item_id, classes.get(tokens, item_id))
    out = {}
    for doc_id, text in rows:
        h = re.findall(r"[^\W_]+", text.lower())
        for b, item_id in classes.items():
            masks = [*MASKS, *(["1" * len(b)] if len(b) < 12 else [])]
            offsets = set()
            for mask in masks:
                places = [k for k, c in enumerate(mask) if c == "1"]
                seeds = {}
                for i in range(len(b) - len(mask) + 1):
                    seeds.setdefault(tuple(b[i + k] for k in places), []).append(i)
                for j in range(len(h) - len(mask) + 1):
                    offsets.update(j - i for i in seeds.get(tuple(h[j + k] for k in places), []))
            for offset in offsets:
                first, last = max(0, -offset), min(len(b), len(h) - offset)
                points = equal = start = 0
                best = (0, 0, 0, -1)
                for at in range(first, last):
                    if points <= 0:
                        points, equal, start = 0, 0, at
                    hit = b[at] == h[offset + at]
                    points, equal = points + (1 if hit else -3), equal + hit
                    if points > best[0]:
                        best = (points, equal, start, at)
                if best[1] >= min(min_tokens, len(b)):
                    found = (best[1], -(offset + best[2]), best[3] - best[2] + 1)
                    out[doc_id, item_id] = max(found, out.get((doc_id, item_id), found))
    return {k: (n, t, -s, -s + t) for k, (n, s, t) in out.items()}
