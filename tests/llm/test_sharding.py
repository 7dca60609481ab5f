import hashlib
import math
import zlib
from collections import Counter

import pytest

from brute import docs  # noqa: F401
from areastats.llm.sharding import shard_documents


def result(df, **options):
    return shard_documents(df, **options).collect()


def test_slots_have_no_gaps_and_only_the_new_shard_gains(docs):
    rows = [(i, f"text {i % 50}") for i in range(3000)]
    out = result(docs(rows, shard="x", size="y", part="z"))
    assert len(out) == 3000 and {r.law for r in out} == {"key"}
    for shard in range(24):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) > 60
    moved = [r for r in out if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {24} and 60 < len(moved) < 200
    texts = dict(rows)
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in out)


def test_weights_decide_the_share(docs):
    out = Counter(r.shard for r in result(docs([(i, "x") for i in range(4000)]), weights=[1, 3, 0]))
    assert set(out) == {0, 1} and 2.6 < out[1] / out[0] < 3.4
    assert {r.shard for r in result(docs([(1, "x")]), weights=[2.0])} == {0}
    with pytest.raises(ValueError):
        result(docs([(1, "x")]), weights=[0.0, 0.0])


def test_the_key_alone_decides(docs):
    a = {r.doc_id: (r.shard, r.grown_shard) for r in result(docs([(i, "one") for i in range(200)]))}
    b = {r.doc_id: (r.shard, r.grown_shard) for r in result(docs([(i, "other") for i in reversed(range(200))]))}
    assert a == b


def test_nulls_repeats_and_empty_tables(docs):
    out = result(docs([(None, None), (None, ""), (7, "é"), (7, "é"), (7, "z" * 100_000)]))
    by = {(r.doc_id, r.size): r for r in out}
    assert by[None, 8].text_crc32 == 0 and by[7, 10].size == 10 and by[7, 100_008].size == 100_008
    assert len({r.shard for r in out if r.doc_id == 7}) == 1
    assert sorted(r.slot for r in out if r.doc_id == 7) == [0, 1, 2]
    assert result(docs([])) == []


def plain_shard(doc_id, weights):
    """The shard with the highest weighted score, one digest per four shards."""
    key = "null" if doc_id is None else str(doc_id)
    scores = []
    for s, w in enumerate(weights):
        digest = hashlib.md5(f"{key}:{s // 4}".encode()).hexdigest()
        u = (int(digest[8 * (s % 4) : 8 * (s % 4) + 8], 16) + 0.5) / 2**32
        scores.append((-w / math.log(u) if w else -1.0, -s))
    return -max(scores)[1]


@pytest.mark.parametrize("weights", [[1.0] * 24, [2.0, 0.0, 1.0, 5.0, 0.5]])
def test_shards_are_those_of_plain_rendezvous_hashing(docs, weights):
    ids = [None, 0, -5, 2**62, *range(1000, 1400)]
    out = {r.doc_id: (r.shard, r.grown_shard) for r in result(docs([(i, "x") for i in ids]), weights=weights, grown_weight=1.5)}
    assert out == {i: (plain_shard(i, weights), plain_shard(i, [*weights, 1.5])) for i in ids}
