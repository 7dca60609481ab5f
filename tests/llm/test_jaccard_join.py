import random
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from areastats.llm import jaccard_join
from areastats.llm.jaccard_join import keep_one_of_each, near_documents
from brute import docs, components, shingles  # noqa: F401


def linked(sets):
    def test(i, j):
        both = len(sets[i] & sets[j])
        return bool(both) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    return test


def edited(words, changes):
    words = list(words)
    for _ in range(changes):
        k = random.randrange(len(words) + 1)
        words[k : k + random.choice([0, 1])] = random.choice([[], [f"n{random.randrange(10**6)}"]])
    return words


def corpus(seed, size):
    """Families of copies with more and more changes, shared passages, short and odd texts."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [f"p{i}" for i in range(30)]
    rows = []
    while len(rows) < size:
        words = [random.choice(vocabulary) for _ in range(random.choice([1, 3, 4, 5, 6, 12, 40, 90]))]
        if random.random() < 0.4:
            words[2:2] = passage
        family = [words]
        for _ in range(random.choice([0, 0, 1, 2, 8])):
            family.append(edited(random.choice(family), random.choice([0, 1, 1, 2, 4])))
        rows += [" ".join(f) for f in family if f]
    rows += ["", "  \t ", "A b\x0bC d E", "a b c d e", None, "x" * 50_000, "x" * 50_000, "é ñ ü ö ä", "É ñ ü ö ä"]
    ids = random.sample(range(10**6), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs, seed, monkeypatch):
    if seed == 2:  # many keys dealt out by class, and few pivots, so that regions are joined again and again
        monkeypatch.setattr(jaccard_join, "HOT_ROWS", 2)
        monkeypatch.setattr(jaccard_join, "PAIRS", 8)
        monkeypatch.setattr(jaccard_join, "GROWTH", 2)
    rows = corpus(seed, 350)
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, linked(sets))
    out = near_documents(docs(rows, fp=1, n="x", open=True)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in out} == want
    assert len(set(want.values())) < len(rows) - 30


def test_chains_and_large_groups(docs):
    # Each text is close to the next only, so the ends are connected through many pivots.
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - k, " ".join(words[8 * k : 8 * k + 120])) for k in range(35)]
    rows += [(2000 + k, " ".join([*words[:100], f"end{k}"])) for k in range(300)]
    sets = {i: shingles(t) for i, t in rows}
    out = {r.doc_id: r.component_id for r in near_documents(docs(rows)).collect()}
    assert out == components(sets, linked(sets))


def bridged(size, bridge):
    """An article under two frequent headers: two large groups of near copies, joined by one pair at most."""
    article = [f"a{i}" for i in range(240)]
    heads = [[f"{side}{i}" for i in range(70)] for side in "xy"]
    rows = []
    for side, head in enumerate(heads):
        rows += [(10_000 * side + k, " ".join([*head, *article, f"end{side}", f"t{side}{k}"])) for k in range(size)]
        if bridge:
            rows.append((10_000 * side + 5000, " ".join([*head[-20:], *article])))
    # The headers are more frequent than the article, so that the article's shingles make the regions.
    return rows + [(50_000 + k, " ".join(heads[0] + heads[1])) for k in range(4 * size)]


@pytest.mark.parametrize("bridge", [True, False])
def test_two_large_groups_with_a_single_link_between_them(docs, bridge):
    rows = bridged(300, bridge)
    sets = {i: shingles(t) for i, t in rows if i < 50_000}
    want = components(sets, linked(sets))
    assert len(set(want.values())) == (1 if bridge else 2)
    out = {r.doc_id: r.component_id for r in near_documents(docs(rows)).collect()}
    assert out == want | {i: 50_000 for i, _ in rows if i >= 50_000}


@pytest.fixture
def compared(monkeypatch):
    """Numbers of pairs that rounds compare."""
    found, staged = [], jaccard_join.staged

    @contextmanager
    def counted(df, label):
        with staged(df, label) as table:
            if label == "pairs":
                found.append(table.count())
            yield table

    monkeypatch.setattr(jaccard_join, "staged", counted)
    return found


def test_near_copies_that_link_with_nothing_are_not_compared_with_all(docs, compared):
    # Half of the copies have so many own shingles that they are no copies, but share the rest with the whole group.
    random.seed(5)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(400):
        copy = list(words)
        for place in random.sample(range(len(words)), random.choice([1, 2, 3, 5, 6, 7])):
            copy[place] = f"n{random.randrange(10**9)}"
        rows.append((k, " ".join(copy)))
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, linked(sets))
    assert 100 < len(set(want.values())) < 350
    assert {r.doc_id: r.component_id for r in near_documents(docs(rows)).collect()} == want
    assert sum(compared) < 20 * len(rows)


def test_what_reaches_no_other_class_leaves():
    rows = [  # key, salt, class, size, reach
        (1, -1, 10, 100, 133), (1, -1, 10, 100, 133), (1, -1, 11, 100, 89), (1, -1, 12, 90, 100),
        (2, -1, 10, 100, 133),
        (3, -1, 10, 100, 99), (3, -1, 11, 100, 120),
        (4, -1, 10, 100, 100), (4, -1, 11, 100, 100),
        (5, 0, 10, 100, 75),
        (6, -1, 10, 100, 120), (6, -1, 11, 120, 100),
    ]
    want = [(1, 10), (1, 12), (4, 10), (4, 11), (5, 10), (6, 10), (6, 11)]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    for size in (1, 2, 5, 50):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*p, strict=True), types, strict=True)], names=list("ksfnr")) for p in parts]
        out = [r for b in jaccard_join._shared(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns[:2]), strict=True)]
        assert out == want


def test_reach_of_prefixes_loses_no_link():
    random.seed(3)
    for _ in range(300):
        n = random.randrange(1, 60)
        a = random.sample(range(80), n)
        b = random.sample(sorted(set(range(80)) - set(a)), random.randrange(0, min(20, 80 - n) + 1)) + random.sample(a, random.randrange(n // 2, n + 1))
        sets = [np.array(sorted(x), np.uint64) for x in (a, b) if x]
        if len(sets) < 2 or not linked([set(a), set(b)])(0, 1):
            continue
        counts = np.zeros(1 << jaccard_join.SKETCH_BITS, np.int64)
        reach = [dict(zip(*jaccard_join._prefix(s, counts, 75)[::2], strict=True)) for s in sets]
        first = min(set(a) & set(b))
        assert reach[0][first] >= len(b) and reach[1][first] >= len(a)


def test_repeated_rows_nulls_and_empty_tables(docs):
    text = "one two three four five six"
    out = near_documents(docs([(5, text), (5, text), (None, text), (9, text), (3, None), (4, "")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in out) == [
        (0, 2, 0), (3, 0, 3), (4, 0, 4), (5, 2, 5), (5, 2, 5), (9, 2, 5)
    ]
    assert near_documents(docs([])).collect() == []
    assert near_documents(docs([(1, None)])).collect()[0].component_id == 1


def test_one_of_each_stays(docs):
    text = "one two three four five six"
    df = docs([(5, text), (9, text), (None, text), (3, None), (4, "")], component_id=0, rep="r", __kept=1)
    out = keep_one_of_each(df)
    assert out.columns == df.columns
    assert sorted(out.select(F.coalesce("doc_id", F.lit(0))).toPandas().iloc[:, 0]) == [0, 3, 4, 5]
