import hashlib
import random
import re
import zlib

import pytest

from areastats.llm.prefix_trie import prefix_trie

random.seed(13)
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The trie in memory; no two turns of a conversation may have equal numbers but different texts."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids.get(node, []))
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if full[c] == node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(many, vocabulary):
    rows = []
    for c in random.sample(range(-many, 3 * many), many):
        for turn in range(random.choice([1, 2, 2, 3, 5, 8])):
            rows.append((c, turn, random.choice(["user", "assistant"]), random.choice(vocabulary)))
    return rows


def trie(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'x' AS digest", "2 AS words", "3 AS path")
    return sorted((tuple(r) for r in prefix_trie(df, **options).collect()), key=repr)


@pytest.mark.parametrize("shards, nodes", [(1, 1 << 18), (7, 1 << 18), (40, 1 << 18), (40, 40), (13, 26)])
def test_equals_plain_python(spark, shards, nodes):
    rows = conversations(400, ["a b", "c", "", "d  e\tf", "é ü\n"])
    rows += [(5000 + i, t, "user", f"same {t}") for i in range(300) for t in range(4)]
    rows += [(9000, None, None, None), (9000, 1, "user", None), (None, 1, "user", "lost"), (9020, 3, "x", "y"), (9020, 3, "x", "y")]
    random.shuffle(rows)
    assert trie(spark, rows, shards=shards, skeleton_nodes=nodes, sample=4) == plain(rows)


def test_many_ends_at_one_node_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr("areastats.llm.prefix_trie.CHUNK_IDS", 7)
    rows = [(100_000 + i, 0, "user", "hello") for i in range(2000)]
    rows += [(7, t, "user", f"turn {t}" * 3) for t in range(3000)] + [(9, t, "user", f"turn {t}" * 3) for t in range(2990)]
    rows += [(11, 0, "user", "word " * 300_000)]
    assert trie(spark, rows, shards=9) == plain(rows)


def test_turns_with_equal_numbers_have_one_order(spark):
    rows = [(1, 0, "user", t) for t in "abcdef"]
    assert trie(spark, rows, shards=2) == trie(spark, rows[::-1], shards=3)


def test_empty_table(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []
