import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from brute import docs  # noqa: F401
from areastats.llm import ngram_table
from areastats.llm.importance import draw_documents, importance_draw

random.seed(12)
WORDS = ["the", "of", "Été", "naïve", "x1", "sum", "a" * 9, "b" * 40, "c" * 300] + [f"w{i}" for i in range(300)]


def features(text, max_n):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text, max_n)[1]))
    for text in target:
        t.update(map(bucket, features(text, max_n)[1]))
    a, b = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * a / ((s[k] + 1) * b))) for k in s}
    out = []
    for doc_id, text in rows:
        words, found = features(text, max_n)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r, rank.get(r[0])) for r in out)


def text(n):
    return random.choice([" ", ", ", "\n", "-"]).join(random.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("max_n, buckets, percent", [(1, 10_000, 10), (2, 50, 30), (3, 1000, 100)])
def test_equals_plain_python(spark, docs, max_n, buckets, percent):
    rows = [(i, text(random.choice([0, 5, 19, 20, 60]))) for i in range(300)] + [(900, None), (901, ""), (902, "...")]
    rows += [(1000 + i, rows[7][1] + " more" * 20) for i in range(100)]
    target = [text(30) for _ in range(20)] + [None]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    out = importance_draw(docs(rows, row=1, rank=2, n_words="x"), aim, max_n=max_n, buckets=buckets, percent=percent)
    assert sorted(tuple(r) for r in out.collect()) == plain(rows, target, max_n, buckets, percent)


def test_long_texts_come_in_parts(spark, docs, monkeypatch):
    long = text(5000)
    whole = ngram_table.intern([(ngram_table.words_of(long.encode()), 0)], 3, 100)
    monkeypatch.setattr(ngram_table, "SLICE", 1000)
    monkeypatch.setattr(ngram_table, "SLOTS", 16)
    counts, words = np.zeros(100, np.int64), 0
    for _, pieces in ngram_table.batches_of([long], 3):
        part = ngram_table.intern(pieces, 3, 100)
        np.add.at(counts, part.bucket, part.count)
        words += part.n_words.sum()
    expected = np.zeros(100, np.int64)
    np.add.at(expected, whole.bucket, whole.count)
    assert (counts == expected).all() and words == whole.n_words.sum() == 5000


def test_hashes_and_bytes():
    buffer = bytes(random.randrange(256) for _ in range(4000)) * 2
    starts = np.array([random.randrange(7800) for _ in range(2000)])
    lengths = np.array([random.randrange(70) for _ in range(2000)])
    s = ngram_table.Stretches(buffer, starts, lengths)
    assert s.hashes().tolist() == [xxhash.xxh64_intdigest(s.bytes_of(i)) for i in range(2000)]
    a, b = np.arange(2000), np.array([random.randrange(2000) for _ in range(2000)])
    twin = ngram_table.Stretches(buffer, np.concatenate([starts % 3900, starts % 3900 + 4000]), np.concatenate([lengths, lengths]))
    assert twin.same(a, a + 2000).all()
    assert s.same(a, b).tolist() == [s.bytes_of(i) == s.bytes_of(j) for i, j in zip(a.tolist(), b.tolist())]


def test_empty_stretches_are_equal():
    s = ngram_table.Stretches(b"abcdefgh", np.array([1, 4, 4]), np.array([0, 0, 1]))
    assert s.same(np.array([0, 0]), np.array([1, 2])).tolist() == [True, False]


def test_equal_hashes_of_different_bytes(monkeypatch):
    monkeypatch.setattr(ngram_table.Stretches, "hashes", lambda self: np.full(len(self.starts), 5, np.uint64))
    words = [random.choice([b"a", b"bb", b"ab", b"c" * 50]) for _ in range(500)]
    found = ngram_table.intern([(words, 0)], 1, 1000)
    assert sorted(found.count[found.count > 0]) == sorted(Counter(words).values())


def test_repeated_rows_missing_ids_and_empty_tables(spark, docs):
    aim = spark.createDataFrame([("the sum of",)], "text string")
    rows = [(1, "the sum " * 20)] * 40 + [(None, "the of " * 20)] * 3 + [(2, "x")]
    out = importance_draw(docs(rows), aim, percent=50).collect()
    assert len(out) == 44 and sorted(r.rank for r in out if r.rank) == list(range(1, 22))
    assert importance_draw(docs([]), aim).collect() == []
    assert len(importance_draw(docs(rows), aim.limit(0)).collect()) == 44
    drawn = draw_documents(docs(rows, rank=3, score="s"), aim, percent=100)
    assert drawn.columns == ["doc_id", "text", "rank", "score"] and drawn.count() == 43
