"""Exact Jaccard join of shingle sets in a metric space.

The Jaccard distance (one minus intersection over union) is a metric. Documents that link are at
most ``EPSILON`` apart, and what is asked for are the groups of documents connected by links, so a
pair need not be compared once both are known to be connected. The join works in regions:

1. Equal sets are one class.
2. Most classes are at distance 1 from any given pivot, so distances alone cannot spread them.
   The first cells come from prefixes: of its shingles in a fixed order, rarest first, a class
   takes the first ``n - ceil(0.75 n) + 1``. Two linked classes share one of them, so every shingle
   in a prefix opens a region, and a link lies within some region. Sizes are distances from the
   empty set: regions are cut in size windows, with boundary classes in two of them.
   Of the shingles that two linked classes share, the first in the order stands early enough in both to leave room for
   the intersection they need. So the place of a shingle tells how large a partner may be that has it as the
   first one in common: the class's ``reach`` in the region. Two members can link only if the size of
   each is within the other's reach, and members without such a partner leave. Near copies with too many shingles of their own for
   any link go here. Regions with the same members are one; a member keeps its largest reach.
3. In each region pivots are chosen, at first the member with the largest reach for its size, and every member is compared with them exactly.
   Members linked with a pivot join its cell. Cells that share a member, in any region, are one cell: they are
   connected, and nothing within a cell needs to be compared any more.
4. A region whose members are all in one cell is finished. Else a link that is still unknown has at
   least one end outside the largest cell of the region, so further pivots come from there, and members leave that reach none of
   those. A pivot is compared with the whole region and then leaves it. Members of the largest cell are boundary documents, which stay only
   as long as the triangle inequality allows a link with a member outside it: for each pivot their distance lies
   within ``EPSILON`` of the range of those members' distances. The rest is joined again, with new pivots.

A region gets as many pivots as keep its comparisons of a round within ``PAIRS``, at least one; where that is enough for all
members outside the largest cell, they are compared with all they reach, and the region is finished exactly. ``PAIRS`` grows from round to round, so the number of
rounds grows with the logarithm of what one region needs. The order of shingles comes from counts of all
shingles in a sketch of fixed size; it decides how much work there is, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import arrow_batches, inner_prefix, narrow, possible
from areastats.llm.components import connected_components
from areastats.llm.shingles import Shingler, fingerprint, least_distance, signature
from areastats.session import stage, staged

#: A link needs this share of the union, in hundredths.
PERCENT = 75
#: Counters of the sketch: 2 to this power.
SKETCH_BITS = 20
#: The sketch travels in so many pieces.
SKETCH_PIECES = 64
#: A shingle that may have more rows than this is dealt out by its classes as well.
HOT_ROWS = 20_000
#: Comparisons of a region in a round, unless one pivot needs more, and how much more every further round has.
#: The first round has one pivot per region, which ends regions of near copies.
PAIRS, GROWTH = 2048, 8
#: Rows that a Python worker gets at a time: texts, or pairs of whole sets.
BATCH_ROWS = 500
_SLACK = 1e-9
#: A pivot: its class, size, cell, reach, and whether all open members of its region are pivots.
PIVOT = ("p", "np", "home", "far", "few")


def near_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = 5
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents link if 100 times the intersection of their sets is at least ``percent`` times the union. ``component_id`` is the smallest id
    that links reach, the document's own included. NULL texts and texts without words have an empty
    set and link with nothing, not even each other. Texts with fewer words than ``width`` are one
    shingle. Rows with equal ids are looked at one by one; a row with a NULL id links with nothing
    and has no component. Ids must be integers. Other columns are not looked at.
    """
    rows = narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        sets, classes, cells = _classes_and_cells(rows, percent, width)
    named = classes.drop("sig").join(cells, "fp", "left").withColumn("cell", F.coalesce("cell", "fp"))
    first = named.groupBy("cell").agg(F.min("rep").alias("component"))
    named = named.join(first, "cell").select("fp", "n", "component")
    usable = F.when(F.col("doc_id").isNotNull(), F.col("fp"))
    return (
        sets.withColumn("fp", usable)
        .join(named, ["fp", "n"], "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )


def _classes_and_cells(rows: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    profile = stage(rows.mapInArrow(_profile(width), "doc_id long, n int, fp long, sig binary, piece int, counts binary"), "profile")
    sets = profile.where("piece is null").select("doc_id", "n", "fp")
    known = profile.where("piece is null and n > 0 and doc_id is not null")
    classes = stage(known.groupBy("fp", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")
    return sets, classes, connected_classes(rows, profile, classes, percent, width)


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each group of linked documents; rows without an id all stay.

    Rows that share an id stay or go together.
    """
    found = near_documents(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("kept")).where("not kept")
    name = f"{inner_prefix(docs)}id"
    return docs.join(gone.select("doc_id").toDF(name), F.col(f"`{id_col}`") == F.col(name), "left_anti")


def connected_classes(rows: DataFrame, profile: DataFrame, classes: DataFrame, percent: int, width: int) -> DataFrame:
    """``fp`` and ``cell``, the same for all classes that links connect; classes without a link may be missing."""
    spark = rows.sparkSession
    sketch = spark.sparkContext.broadcast(_sketch(profile))
    postings = rows.where("doc_id is not null").mapInArrow(_prefixes(sketch, percent, width), "key long, salt int, fp long, n int, reach int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with ExitStack() as tables:
        dealt = postings.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "fp")
        members = tables.enter_context(staged(dealt.mapInArrow(_shared, "key long, fp long, n int, reach int"), "members"))
        region = stage(_regions(members, percent, tables), "regions")
    signatures, sets = classes.select("fp", "sig"), None
    cells, pairs, epsilon = None, None, 1 - percent / 100

    def sets_of(ids: DataFrame) -> DataFrame:
        nonlocal sets
        sets = _more_sets(sets, ids, rows, classes, width)
        return sets

    while not region.isEmpty():
        with ExitStack() as tables:  # what a round writes goes when the next one's regions are written
            measured = _measure(region, sets_of, signatures, pairs, percent, tables)
            edges = measured.where((F.col("d") <= epsilon) & (F.col("top") <= epsilon)).select(F.col("p").alias("a"), F.col("fp").alias("b"))
            cells = _joined_cells(cells, edges.distinct())
            left = _within_reach(measured, epsilon, tables) if pairs else measured.where("p <> fp").select("g", "fp", "n", "reach")
            region = stage(_unfinished(left, cells, tables), "regions")
        pairs = PAIRS if pairs is None else pairs * GROWTH
    return spark.createDataFrame([], "fp long, cell long") if cells is None else cells


def _more_sets(sets: DataFrame | None, ids: DataFrame, rows: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``fp`` and ``s`` of the classes read so far and of those in ``ids``; only texts of classes that are new are read."""
    ids = ids.toDF("fp").distinct()
    new = ids if sets is None else ids.join(sets.select("fp"), "fp", "left_anti")
    wanted = stage(new.join(classes, "fp").select(F.col("rep").alias("doc_id"), F.col("fp").alias("want")).distinct(), "wanted")
    if wanted.isEmpty() and sets is not None:
        return sets
    texts = possible(rows, "doc_id", wanted.select("doc_id")).join(wanted, "doc_id")
    more = stage(texts.mapInArrow(_sets(width), "fp long, s binary"), "sets")
    return more if sets is None else sets.unionByName(more)


def _joined_cells(cells: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Cells after more links: those that a link connects are one."""
    if cells is None:
        return stage(connected_components(edges).select(F.col("id").alias("fp"), F.col("component").alias("cell")), "cells")
    for end in ("a", "b"):
        known = cells.select(F.col("fp").alias(end), "cell")
        edges = edges.join(known, end, "left").withColumn(end, F.coalesce("cell", end)).drop("cell")
    grown = stage(connected_components(edges).select(F.col("id").alias("old"), F.col("component").alias("new")), "grown")
    moved = cells.join(grown, F.col("cell") == F.col("old"), "left").select("fp", F.coalesce("new", "cell").alias("cell"))
    single = grown.join(cells.select(F.col("fp").alias("old")), "old", "left_anti").select(F.col("old").alias("fp"), F.col("new").alias("cell"))
    return stage(moved.unionByName(single), "cells")


def _unfinished(left: DataFrame, cells: DataFrame, tables: ExitStack) -> DataFrame:
    """Members of regions with several cells that reach a member of another one.

    ``g``, ``fp``, ``n``, ``reach``, ``cell``, ``open`` (outside the largest), ``size`` and ``n_open``.
    """
    members = left.join(cells, "fp", "left").withColumn("cell", F.coalesce("cell", "fp"))
    members = tables.enter_context(staged(members, "members-met"))
    counts = members.groupBy("g", "cell").agg(F.count("*").alias("members"), F.min("n").alias("least"), F.max("reach").alias("most"))
    counts = tables.enter_context(staged(counts, "cells-met"))
    several = counts.groupBy("g").agg(F.max(F.struct("members", "cell")).alias("largest"), F.count("*").alias("cells")).where("cells > 1")
    outside = F.col("cell") != F.col("main")
    ends = counts.join(several.select("g", F.col("largest.cell").alias("main")), "g").groupBy("g", "main")
    ends = ends.agg(
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min(F.when(outside, F.col("least"))).alias("least_open"),
        F.max(F.when(outside, F.col("most"))).alias("most_open"),
    )
    rows = members.join(ends, "g").withColumn("open", outside)
    least, most = (F.when(F.col("open"), F.col(c)).otherwise(F.col(f"{c}_open")) for c in ("least", "most"))
    rows = rows.where((F.col("reach") >= least) & (F.col("n") <= most)).select("g", "fp", "n", "reach", "cell", "open")
    rows = tables.enter_context(staged(rows, "members-left"))
    sizes = rows.groupBy("g").agg(F.count("*").alias("size"), F.count_if("open").alias("n_open")).where("size > 1 and n_open > 0")
    return rows.join(sizes, "g")


def _profile(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketch = Shingler(width), np.zeros(1 << SKETCH_BITS, np.int64)

        def count(sets: list[np.ndarray]) -> None:
            nonlocal sketch
            slots = np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - SKETCH_BITS)
            sketch += np.bincount(slots.astype(np.int64), minlength=len(sketch))

        names = ["doc_id", "n", "fp", "sig", "piece", "counts"]
        for batch in batches:
            n, fp, sig, some, held = [], [], [], [], 0
            for s in shingler.sets(batch.column("text").to_pylist()):
                n.append(len(s))
                fp.append(fingerprint(s))
                sig.append(signature(s))
                some.append(s)
                held += len(s)
                if held > 1 << 20:
                    count(some)
                    some, held = [], 0
            count(some)
            size = batch.num_rows
            arrays = [batch.column("doc_id"), pa.array(n, type=pa.int32()), pa.array(fp, type=pa.int64())]
            arrays += [pa.array(sig, type=pa.binary()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        for piece, counts in enumerate(np.split(sketch, SKETCH_PIECES)):
            if counts.any():
                arrays = [pa.nulls(1, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.binary())]
                arrays += [pa.array([piece], type=pa.int32()), pa.array([counts.astype("<u4").tobytes()], type=pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _sketch(profile: DataFrame) -> np.ndarray:
    """Counts of all shingles by the first bits of their hash: a table of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[piece] = total.get(piece, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        if total:
            blobs = pa.array([t.astype("<i8").tobytes() for t in total.values()], type=pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(total), type=pa.int32()), blobs], names=["piece", "counts"])

    pieces = profile.where("piece is not null").select("piece", "counts").repartition(SKETCH_PIECES, "piece")
    out = np.zeros((SKETCH_PIECES, (1 << SKETCH_BITS) // SKETCH_PIECES), np.int64)
    for row in pieces.mapInArrow(add, "piece int, counts binary").collect():  # SKETCH_PIECES rows
        out[row["piece"]] = np.frombuffer(row["counts"], "<i8")
    return out.ravel()


def _prefixes(sketch, percent: int, width: int) -> Callable:
    """Per class met in a task: the shingles of its prefix as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, seen = Shingler(width), sketch.value, set()
        for batch in batches:
            keys, frequencies, reaches, fps, sizes = [], [], [], [], []
            for s in shingler.sets(batch.column("text").to_pylist()):
                fp = fingerprint(s)
                if not len(s) or fp in seen:
                    continue
                seen.add(fp)
                for out, found in zip((keys, frequencies, reaches), _prefix(s, counts, percent), strict=True):
                    out.append(found)
                fps.append(fp)
                sizes.append(len(s))
            if not keys:
                continue
            repeat = list(map(len, keys))
            key, fp = np.concatenate(keys), np.repeat(np.array(fps, np.int64), repeat)
            # Keys that may be hot are dealt out by class; -1 marks those that stay in one place.
            deal = np.concatenate(frequencies) // HOT_ROWS + 1
            salt = np.where(deal > 1, (fp >> 7) % deal, -1).astype(np.int32)
            arrays = [key.astype(np.int64), salt, fp, np.repeat(np.array(sizes, np.int32), repeat)]
            arrays.append(np.concatenate(reaches).astype(np.int32))
            for at in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(a[at : at + (1 << 16)]) for a in arrays], names=["key", "salt", "fp", "n", "reach"])

    return run


def _prefix(s: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first shingles of a set, rarest first, how frequent they are, and the reach of each.

    The reach is the size of the largest class that may link if this shingle is the first that both have: with ``i``
    before it, ``n - i`` are left for the intersection, which has ``percent / (100 + percent)`` of both sizes at least.
    """
    n = len(s)
    take = n - -(-percent * n // 100) + 1
    frequency = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    first = np.lexsort((s, frequency))[:take]
    return s[first], frequency[first], (100 * n - (100 + percent) * np.arange(take)) // percent


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, salt and class: equal rows once, and none that reach no other class of their key.

    Keys that are dealt out by class may be alone in one place and not in another; they stay.
    """
    left = np.zeros((5, 0), np.int64)

    def cut(rows: np.ndarray, last: bool) -> tuple[pa.RecordBatch, np.ndarray]:
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
        rows = rows[:, new]
        starts = np.ones(rows.shape[1], bool)
        starts[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        first = np.flatnonzero(starts)
        # The last run may go on in the next batch.
        end = rows.shape[1] if last or not len(first) else first[-1]
        out = rows[:, :end]
        if end:
            first, (_, salt, _, n, reach) = first[first < end], out
            meets = (reach >= _least_of_others(n, first)) & (n <= -_least_of_others(-reach, first))
            out = out[:, meets | (salt >= 0)]
        names, types = ["key", "fp", "n", "reach"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(out[i], type=t) for i, t in zip((0, 2, 3, 4), types, strict=True)], names=names), rows[:, end:]

    for batch in batches:
        rows = np.stack([np.asarray(c).astype(np.int64) for c in batch.columns])
        done, left = cut(np.concatenate([left, rows], axis=1), last=False)
        yield done
    if left.shape[1]:
        yield cut(left, last=True)[0]


def _least_of_others(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each value the least of the others in its run, or a number beyond all if it is alone."""
    lengths = np.diff(np.append(starts, len(values)))
    least = np.repeat(np.minimum.reduceat(values, starts), lengths)
    is_least = values == least
    second = np.repeat(np.minimum.reduceat(np.where(is_least, np.int64(1 << 40), values), starts), lengths)
    alone = np.repeat(np.add.reduceat(is_least.astype(np.int64), starts) == 1, lengths)
    return np.where(is_least & alone, second, least)


def _regions(members: DataFrame, percent: int, tables: ExitStack) -> DataFrame:
    """``g``, ``fp``, ``n``, ``reach``: regions with at least two classes, none twice.

    Linked classes have sizes within a factor of each other, so each lies in the window of its size or
    the next one; a class that reaches the next window is copied into it.
    """
    step = F.lit(np.log(100 / percent) * (1 + 1e-9))
    window, reached = (F.floor(F.log(F.greatest(F.col(c), F.lit(1))) / step).cast("int") for c in ("n", "reach"))
    windows = F.when(reached > window, F.array(window, window + 1)).otherwise(F.array(window))
    rows = members.select(F.explode(windows).alias("w"), window.alias("own"), "key", "fp", "n", "reach")
    rows = rows.select(F.xxhash64("key", "w").alias("g"), "fp", "n", "reach", (F.col("w") == F.col("own")).alias("own"))
    rows = tables.enter_context(staged(rows, "windows"))
    ends = rows.groupBy("g").agg(
        F.min("n").alias("least"),
        F.max("reach").alias("most"),
        F.min(F.when(F.col("own"), F.col("n"))).alias("least_own"),
        F.max(F.when(F.col("own"), F.col("reach"))).alias("most_own"),
        F.count("*").alias("size"),
    )
    # Copies meet each other in their own window.
    least, most = (F.when(F.col("own"), F.col(c)).otherwise(F.col(f"{c}_own")) for c in ("least", "most"))
    rows = rows.join(ends.where("size > 1"), "g").where((F.col("reach") >= least) & (F.col("n") <= most))
    rows = tables.enter_context(staged(rows.select("g", "fp", "n", "reach", "own"), "meeting"))
    marks = rows.groupBy("g").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("fp", "own")).alias("m1"),
        F.bit_xor(F.xxhash64(F.lit(1), "fp", "own")).alias("m2"),
        F.max("own").alias("some"),
    )
    marks = tables.enter_context(staged(marks.where("size > 1 and some"), "marks"))
    same = ["size", "m1", "m2"]
    single = marks.join(marks.groupBy(*same).agg(F.min("g").alias("one")), same).select("g", "one")
    rows = rows.join(single, "g").groupBy("one", "fp", "n").agg(F.max("reach").alias("reach"))
    return rows.withColumnRenamed("one", "g")


def _measure(
    region: DataFrame, sets_of: Callable, signatures: DataFrame, pairs: int | None, percent: int, tables: ExitStack
) -> DataFrame:
    """A row per member and pivot of its region: the region's columns, ``p`` and the distance.

    The distance lies between ``d`` and ``top``. Both are exact unless sizes or signatures show that
    it is more than a link's; then the windows make do with that bound. A pivot has no distance from itself, and
    where all open members are pivots there are rows only of members that it reaches in other cells.
    """

    def stage(df: DataFrame, label: str) -> DataFrame:
        return tables.enter_context(staged(df, label))

    if pairs is None:  # the first round: one pivot each, and nothing is known yet
        short = (-F.col("reach") / F.col("n")).alias("short")
        chosen = region.groupBy("g").agg(F.min(F.struct(short, "fp", "n")).alias("v"))
        chosen = chosen.select("g", F.col("v.fp").alias("p"), F.col("v.n").alias("np"))
        asked = F.lit(True)
    else:
        pivots = F.greatest(F.lit(1), F.floor(F.lit(pairs) / F.col("size")))
        few = F.col("n_open") <= pivots
        slot = F.when(few, F.col("fp")).otherwise(F.pmod(F.xxhash64("fp", "g"), pivots))
        chosen = region.where("open").groupBy("g", slot).agg(F.min(F.struct("fp", "n", "cell", "reach", few.alias("few"))).alias("v"))
        chosen = chosen.select("g", *[F.col(f"v.{c}").alias(name) for c, name in zip(("fp", "n", "cell", "reach", "few"), PIVOT, strict=True)])
        meet = (F.col("n") <= F.col("far")) & (F.col("np") <= F.col("reach"))
        asked = ~F.col("few") | (F.col("p") == F.col("fp")) | ((F.col("home") != F.col("cell")) & meet)
    chosen = stage(chosen, "pivots")
    rows = region.join(chosen, "g").where(asked)
    asked = rows.where(F.col("p") != F.col("fp")).select("p", "np", F.col("fp").alias("x"), "n").distinct()
    asked = asked.join(possible(signatures, "fp", chosen.select("p")).toDF("p", "a"), "p")
    asked = asked.join(possible(signatures, "fp", region.select("fp")).toDF("x", "b"), "x").select("p", "x", "np", "n", "a", "b")
    bounds = stage(asked.mapInArrow(_bounds, "p long, x long, d double"), "pairs")
    epsilon = 1 - percent / 100
    close = bounds.where(F.col("d") <= epsilon + _SLACK).select("p", "x")
    ends = stage(close.select(F.explode(F.array("p", "x")).alias("fp")).distinct(), "ends")
    held = stage(possible(sets_of(ends), "fp", ends), "held-sets")
    there, here = held.toDF("p", "sp"), held.toDF("x", "sx")
    close = close.join(there, "p").join(here, "x").select("p", "x", "sp", "sx")
    exact = close.mapInArrow(_distances(percent), "p long, x long, d double").withColumn("top", F.col("d"))
    far = bounds.where(F.col("d") > epsilon + _SLACK).withColumn("top", F.lit(1.0))
    exact = stage(exact.unionByName(far).withColumnRenamed("x", "fp"), "distances")
    return stage(rows.drop("np", "home", "far", "few").join(exact, ["p", "fp"], "left"), "measured")


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p, x, n_p, n_x, a, b = (c.to_pylist() for c in batch.columns)
        sizes = [1 - min(m, n) / max(m, n) for m, n in zip(n_p, n_x, strict=True)]
        d = [max(s, least_distance(*pair)) for s, *pair in zip(sizes, a, b, n_p, n_x, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d, type=pa.float64())], names=["p", "x", "d"])


def _within_reach(measured: DataFrame, epsilon: float, tables: ExitStack) -> DataFrame:
    """``g``, ``fp``, ``n``, ``reach`` of the members that may still link with an open one; pivots have left.

    A region without open members left, because all were pivots, is gone. A missing distance says nothing.
    """
    rows = measured.withColumns({"d": F.coalesce("d", F.lit(0.0)), "top": F.coalesce("top", F.lit(1.0))})
    pivots = tables.enter_context(staged(measured.where("p = fp").select("g", "fp"), "gone"))
    rows = rows.where("p <> fp").join(pivots, ["g", "fp"], "left_anti")
    ranges = rows.where("open").groupBy("g", "p").agg(F.min("d").alias("low"), F.max("top").alias("high"))
    ranges = tables.enter_context(staged(ranges, "ranges"))
    within = (F.col("top") >= F.col("low") - epsilon - _SLACK) & (F.col("d") <= F.col("high") + epsilon + _SLACK)
    kept = rows.join(ranges, ["g", "p"]).groupBy("g", "fp", "n", "reach").agg(F.max("open").alias("open"), F.min(within).alias("within"))
    return kept.where("open or within").select("g", "fp", "n", "reach")


def _sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            fps, sets = [], []
            texts = shingler.sets(batch.column("text").to_pylist())
            for s, want in zip(texts, batch.column("want").to_pylist(), strict=True):
                if fingerprint(s) == want:
                    fps.append(want)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(fps, type=pa.int64()), pa.array(sets, type=pa.binary())], names=["fp", "s"])

    return run


def _distances(percent: int) -> Callable:
    epsilon = 1 - percent / 100

    def distance(a: pa.Scalar, b: pa.Scalar) -> float:
        x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        both = int((y[at] == x).sum())
        union = len(x) + len(y) - both
        if 100 * both >= percent * union:
            return min(1 - both / union, epsilon)
        return max(1 - both / union, epsilon + 1e-12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = [distance(a, b) for a, b in zip(batch.column("sp"), batch.column("sx"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("x"), pa.array(d, type=pa.float64())], names=["p", "x", "d"])

    return run
