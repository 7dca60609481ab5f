"""The trie of conversations that share their first turns, over range-partitioned paths.

A conversation's path is the sequence of digests of its turns. Splitter paths, taken from a sample of
fixed size, cut all paths (in order, then by conversation id) into shards. Whatever lies on no splitter
path lies within one shard: if the members of a node stand on both sides of a splitter, that
splitter begins with the node. So the trie of the splitter paths, the skeleton, is broadcast; every shard
walks its sorted paths once and finishes all other nodes with the path of one conversation
and the finished children of open nodes in memory. For nodes of the skeleton a shard gives
what it knows of them, and these parts are added up. Equal conversations are cut by their id, so a
group of copies is dealt out over many shards like everything else.

What the driver holds is the skeleton: at most ``SKELETON_NODES`` nodes whatever the number of shards,
since splitter paths are cut to as many turns as that allows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areastats.session import stage

#: Original turns that a conversation may take over from the first of its block of so many ids.
BLOCK, SHARED = 20, 4
#: Bytes of a turn's digest.
_DIGEST = 32
#: Nodes of the skeleton that the driver and every task hold.
SKELETON_NODES = 1 << 18
#: Sampled paths per shard.
SAMPLE = 16
#: Ids that are written down together where the members of a skeleton node end.
CHUNK_IDS = 4096
_NUMBERS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_FOUND = "kind int, node int, shard int, seq long, ids string, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string"
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * len(_NUMBERS), pa.string()]
_NAMES = ["kind", "node", "shard", "seq", "ids", *_NUMBERS, "ends_sha256"]
#: Kinds of rows that a shard gives: finished nodes, its part of a skeleton node, ids that end at one.
_NODE, _PART, _ENDS = range(3)


def turns_of(conversations: DataFrame, *, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id``, ``turn``, ``digest`` (32 bytes of role and text) and ``words`` of the text, per turn."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    # The length of the role in front tells ("a", "bc") and ("ab", "c") apart.
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(both.cast("binary"), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    return rows.where("conv_id is not null")


def taken_over(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its block."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(SHARED)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (digests, one after the other) and ``words`` of every rebuilt conversation.

    The first turns of the block's first conversation replace as many of its own.
    """
    in_order = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("later"), "turn", "digest", "words")))
    own = stage(turns.groupBy("conv_id").agg(in_order.alias("turns")), "conversations")
    first = own.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("shared"))
    h = taken_over(F.col("conv_id"))
    rows = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).join(first, "base", "left")
    taken = F.coalesce(F.slice("shared", F.lit(1), h), F.slice("turns", 1, 0))
    kept = F.slice("turns", h + 1, F.size("turns"))
    rows = rows.select("conv_id", F.concat(taken, kept).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return rows.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))


class Skeleton:
    """The trie of the splitter paths; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(set(splitters))
        self.children: list[dict[bytes, int]] = [{}]
        self.parent, self.depth = [-1], [0]
        for path, _ in self.splitters:
            node = 0
            for k in range(0, len(path), _DIGEST):
                step = self.children[node].get(path[k : k + _DIGEST])
                if step is None:
                    step = self.children[node][path[k : k + _DIGEST]] = len(self.parent)
                    self.children.append({})
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = step

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def splitters_of(paths: DataFrame, shards: int, sample: int, nodes: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` splitters, evenly spaced in a sample that a hash of the id chooses."""
    size = paths.count()
    turns = max(1, nodes // max(1, shards))
    cut = turns * _DIGEST
    share = min(1.0, shards * sample / max(size, 1))
    bound = int(share * (1 << 62))
    chosen = paths if share == 1 else paths.where(F.shiftrightunsigned(F.xxhash64("conv_id"), 2) < bound)
    # Without its last turns a path is a splitter in front of all conversations that begin like it.
    from_id = F.when(F.length("path") <= cut, F.col("conv_id")).otherwise(F.lit(-(1 << 63)))
    rows = chosen.select(F.expr(f"substring(path, 1, {cut})").alias("path"), from_id.alias("from_id")).collect()
    keys = sorted((bytes(r["path"]), r["from_id"]) for r in rows)
    return [keys[len(keys) * i // shards] for i in range(1, shards)] if keys else []


def _sharded(skeleton) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trie = skeleton.value
            shard = [trie.shard(p, i) for p, i in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, type=pa.int32()), *batch.columns], names=["shard", "conv_id", "path", "words"])

    return run


class _Open:
    """A node whose members are being read."""

    __slots__ = ("children", "convs", "done", "ends", "first", "leaves", "node", "saved", "seq", "words")

    def __init__(self, node: int, words: int):
        self.node, self.words = node, words  # node of the skeleton, or -1
        self.first, self.convs, self.children, self.leaves, self.saved, self.seq = None, 0, 0, 0, 0, 0
        self.ends = [] if node >= 0 else hashlib.sha256()
        self.done: list[tuple] = []  # finished children that wait for the smallest member


class Walk:
    """One pass over the sorted paths of a shard; ``rows`` collects what it gives."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.trie, self.shard = skeleton, shard
        self.rows: list[tuple] = []
        self.open = [_Open(0, 0)]
        self.path, self.ended = b"", 0

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        depth = len(path) // _DIGEST
        common, limit = 0, min(depth, len(self.open) - 1)
        while common < limit and self.path[common * _DIGEST : (common + 1) * _DIGEST] == path[common * _DIGEST : (common + 1) * _DIGEST]:
            common += 1
        self.close(common)
        for d in range(common, depth):
            above = self.open[-1].node
            node = self.trie.children[above].get(path[d * _DIGEST : (d + 1) * _DIGEST], -1) if above >= 0 else -1
            self.open.append(_Open(node, words[d]))
        self.path = path
        for node in self.open:
            node.convs += 1
            if node.first is None or conv_id < node.first:
                node.first = conv_id
        last = self.open[-1]
        if last.node >= 0:
            last.ends.append(str(conv_id))
            if len(last.ends) == CHUNK_IDS:
                self.write_ends(last)
        else:
            last.ends.update(f",{conv_id}".encode() if last.seq else str(conv_id).encode())
            last.seq = 1

    def write_ends(self, node: _Open) -> None:
        if node.ends:
            self.rows.append((_ENDS, node.node, self.shard, node.seq, ",".join(node.ends), *[None] * len(_NUMBERS), None))
            node.ends, node.seq = [], node.seq + 1

    def close(self, depth: int) -> None:
        """Finish the open nodes deeper than ``depth``."""
        while len(self.open) > depth + 1:
            node, d = self.open.pop(), len(self.open)
            if node.node >= 0:
                self.part(node, d)
                continue
            leaves, saved = node.leaves or 1, node.saved + (node.convs - 1) * node.words
            for values, ends in node.done:
                self.rows.append((_NODE, None, None, None, None, *values[:2], node.first, *values[3:], ends))
            above = self.open[-1]
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
            values = (node.first, d, None, node.convs, node.children, leaves, saved), node.ends.hexdigest()
            if above.node >= 0:  # its smallest member is known when all parts are
                self.rows.append((_NODE, above.node, None, None, None, *values[0], values[1]))
            else:
                above.done.append(values)

    def part(self, node: _Open, depth: int) -> None:
        self.write_ends(node)
        numbers = (node.first, depth, None, node.convs, node.children, node.leaves, node.saved)
        # What is saved at the node itself depends on all its members; its words travel with the part.
        self.rows.append((_PART, node.node, self.shard, node.words, None, *numbers, None))

    def end(self) -> None:
        self.close(0)
        if self.open[0].convs:
            self.part(self.open[0], 0)


def _walked(skeleton) -> Callable:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in _TYPES]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            for shard, conv_id, path, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if walk is None or walk.shard != shard:
                    if walk is not None:
                        walk.end()
                        yield batch_of(walk.rows)
                    walk = Walk(skeleton.value, shard)
                walk.add(conv_id, path, words)
                if len(walk.rows) >= 10_000:
                    yield batch_of(walk.rows)
                    walk.rows = []
        if walk is not None:
            walk.end()
            yield batch_of(walk.rows)

    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each skeleton node, read chunk by chunk in order."""
    node, digest = None, None
    for batch in batches:
        nodes, out = [], []
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if n != node:
                if node is not None:
                    nodes.append(node)
                    out.append(digest.hexdigest())
                node, digest = n, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, type=pa.int32()), pa.array(out, type=pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], type=pa.int32()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def _skeleton_rows(spark: SparkSession, found: DataFrame, trie: Skeleton) -> DataFrame:
    """The nodes of the skeleton, from the sums of their parts; children come before their parents."""
    sums = found.where(F.col("kind") == _PART).groupBy("node").agg(
        F.min("conv_id").alias("first"), F.max("seq").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    chunks = found.where(F.col("kind") == _ENDS).select("node", "shard", "seq", "ids")
    chunks = chunks.repartition("node").sortWithinPartitions("node", "shard", "seq")
    ends = dict(tuple(r) for r in chunks.mapInArrow(_chained, "node int, ends_sha256 string").collect())
    parts = {r["node"]: r.asDict() for r in sums.collect()}  # at most SKELETON_NODES rows, like ``ends``
    nothing, rows = hashlib.sha256().hexdigest(), []
    for node in sorted(parts, key=lambda n: -trie.depth[n]):
        p, parent = parts[node], trie.parent[node]
        p["n_leaves"] = p["n_leaves"] or 1
        p["saved_tokens"] += (p["n_convs"] - 1) * p["words"]
        if parent >= 0:
            for c, n in (("n_children", 1), ("n_leaves", p["n_leaves"]), ("saved_tokens", p["saved_tokens"])):
                parts[parent][c] += n
        above = parts[parent]["first"] if parent >= 0 else None
        numbers = (p["first"], trie.depth[node], above, *(p[c] for c in _NUMBERS[3:]))
        rows.append((node, *numbers, ends.get(node, nothing)))
    return spark.createDataFrame(rows, "node int, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shards: int | None = None,
    sample: int = SAMPLE,
    skeleton_nodes: int = SKELETON_NODES,
) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Turns are in order of ``turn``, NULL first; turns with equal numbers in
    order of a digest of role and text, repeated rows are repeated turns. A NULL role or text is
    empty. Rows without a conversation id belong to no conversation. Ids must be integers. Other
    columns are not looked at. An empty table has no node, not even a root. One conversation (its
    digests and counts, 40 bytes a turn) has to fit into a task.
    """
    spark = conversations.sparkSession
    turns = turns_of(conversations, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    paths = stage(rebuilt(turns), "paths")
    return trie_of(spark, paths, shards=shards, sample=sample, skeleton_nodes=skeleton_nodes)


def trie_of(
    spark: SparkSession, paths: DataFrame, *, shards: int | None = None, sample: int = SAMPLE, skeleton_nodes: int = SKELETON_NODES
) -> DataFrame:
    """The trie of ``conv_id``, ``path`` and ``words``, one row per conversation."""
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    trie = Skeleton(splitters_of(paths, shards, sample, skeleton_nodes))
    skeleton = spark.sparkContext.broadcast(trie)
    dealt = paths.select("conv_id", "path", "words").mapInArrow(_sharded(skeleton), "shard int, conv_id long, path binary, words array<long>")
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = stage(dealt.mapInArrow(_walked(skeleton), _FOUND), "nodes")
    top = stage(_skeleton_rows(spark, found, trie), "skeleton")
    nodes = found.where(F.col("kind") == _NODE).select("node", *_NUMBERS, "ends_sha256")
    above = top.select(F.col("node").alias("of"), F.col("conv_id").alias("above"))
    nodes = nodes.join(F.broadcast(above), F.col("node") == F.col("of"), "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    columns = [*_NUMBERS, "ends_sha256"]
    return nodes.select(columns).unionByName(top.select(columns))
