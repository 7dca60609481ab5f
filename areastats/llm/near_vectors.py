"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors with a cosine of at least ``c`` are at most ``2 - 2c`` apart (squared). After a fixed
random rotation the coordinates are cut in blocks; in at least one of them a close pair must lie
within the block's share of that budget. So each block is joined by range on its own: the plane of
its first two coordinates is cut in cells two ranges wide, a vector has a home cell and is copied
into the cells within range, and a cell compares its home vectors with all that it holds. Whatever
is near in the block is verified with the exact cosine, and a pair counts in the first block that
finds it, so nothing is found twice and nothing needs to be made distinct.

Equal vectors are compared once, with their number. Cells are split in pieces of bounded size, and
a piece returns a count per vector and a star per group of linked vectors, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from areastats.llm.components import connected_components
from areastats.session import stage

BLOCKS = 8
#: Most vectors on either side of a piece.
PIECE = 32768
#: Rows of a piece that are compared at once.
STRIPE = 128
#: Allowance for rounding in the block distances; the cosine itself has none.
SLACK = 1e-9
_REPLICAS = "block int, cx int, cy int, id long, size long, home boolean, vector binary"


def rotation(dimensions: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(20).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_edges(dimensions: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, dimensions, min(BLOCKS, dimensions) + 1).astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def budgets(dimensions: int, cosine: float) -> np.ndarray:
    """Squared distance allowed in each block, in proportion to its coordinates."""
    return np.array([(b - a) / dimensions for a, b in block_edges(dimensions)]) * (2 - 2 * cosine) + SLACK


def units(raw: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, piece: int = PIECE
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows link if their cosine in double precision is at least ``cosine``, whatever their other
    columns hold. NULL vectors, zero vectors, empty ones and those with a NULL or non-finite component link with
    nothing; nor do vectors of different lengths. Equal vectors link with each other. Ids must not
    repeat; a row with a NULL id is returned without links. Other columns are not looked at.
    """
    narrow = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    kind = "float" if narrow else "double"  # floats travel as such; every sum is in double precision
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = stage(rows.select("vec_id", F.when(good, F.col("v")).alias("v")), "vectors")
    usable = rows.where(F.col("v").isNotNull())
    classes = stage(usable.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("size")), "vector-classes")
    lengths = [r[0] for r in classes.select(F.size("v")).distinct().collect()]
    links, stars = None, None
    for dimensions in lengths:  # one, unless models have been mixed
        found = stage(_joined(classes.where(F.size("v") == dimensions), dimensions, cosine, piece, "<f4" if narrow else "<f8"), "vector-links")
        links = found if links is None else links.unionByName(found)
    if links is None:
        none = F.lit(None).cast("long")
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.coalesce("vec_id", none).alias("component_id"), F.lit(True).alias("kept"))
    stars = connected_components(links.select(F.col("id").alias("a"), F.col("star").alias("b")))
    totals = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.join(totals, "id", "left").join(stars, "id", "left")
    known = known.select("v", "id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.join(known, "v", "left")
    component = F.coalesce(F.col("component"), F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _joined(classes: DataFrame, dimensions: int, cosine: float, piece: int, dtype: str) -> DataFrame:
    """Per piece and linked vector: ``id``, rows it links with, and the ``star`` of its group."""
    replicas = classes.mapInArrow(_replicate(dimensions, cosine, dtype), _REPLICAS)
    cell = ["block", "cx", "cy"]
    # Coordinates of unit vectors are bounded, and so is the number of cells.
    home, every = F.sum(F.col("home").cast("long")), F.count("*")
    sizes = replicas.groupBy(*cell).agg(F.ceil(home / piece).alias("kh"), F.ceil(every / piece).alias("ka"))
    sizes = stage(sizes.where("kh > 0"), "cell-sizes")
    place = F.xxhash64("id")
    rows = replicas.join(F.broadcast(sizes), cell).withColumns({"own_h": F.pmod(place, "kh"), "own_a": F.pmod(place, "ka")})

    # A home vector meets every piece of the others, any vector every piece of home vectors.
    def to(hi, aj, left, right):
        return F.struct(hi.alias("hi"), aj.alias("aj"), left.alias("is_left"), right.alias("is_right"))

    zero = F.lit(0).cast("long")
    own = F.transform(
        F.sequence(zero, F.col("ka") - 1), lambda j: to(F.col("own_h"), j, F.col("home"), j == F.col("own_a"))
    )
    others = F.transform(
        F.sequence(zero, F.col("kh") - 1), lambda i: to(i, F.col("own_a"), F.lit(False), i != F.col("own_h"))
    )
    goals = F.filter(F.concat(own, others), lambda g: g["is_left"] | g["is_right"])
    pieces = rows.withColumn("g", F.explode(goals)).select(*cell, "g.*", "id", "size", "vector").groupBy(*cell, "hi", "aj")
    return pieces.applyInArrow(_compare(dimensions, cosine, dtype), "id long, links long, star long")


def _replicate(dimensions: int, cosine: float, dtype: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, edges = rotation(dimensions), block_edges(dimensions)
        reach = np.sqrt(budgets(dimensions, cosine)) * (1 + 1e-9)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, dimensions)
            turned = units(raw.astype(np.float64)) @ turn
            blobs = pa.array([r.tobytes() for r in raw.astype(dtype)], type=pa.binary())
            for block, (a, b) in enumerate(edges):
                r = reach[block]
                x, y = turned[:, a], turned[:, a + 1] if b - a > 1 else np.zeros(len(turned))
                hx, hy = np.floor(x / (2 * r)).astype(int), np.floor(y / (2 * r)).astype(int)
                for dx in (-1, 0, 1):
                    for dy in (-1, 0, 1):
                        cx, cy = hx + dx, hy + dy
                        gap_x = np.maximum(np.maximum(cx * 2 * r - x, x - (cx + 1) * 2 * r), 0)
                        gap_y = np.maximum(np.maximum(cy * 2 * r - y, y - (cy + 1) * 2 * r), 0)
                        some = np.flatnonzero(gap_x**2 + gap_y**2 <= r * r)
                        if dx == dy == 0:
                            some = np.arange(len(x))
                        if not len(some):
                            continue
                        take = pa.array(some)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(some), block), type=pa.int32()),
                                pa.array(cx[some], type=pa.int32()),
                                pa.array(cy[some], type=pa.int32()),
                                batch.column("id").take(take),
                                batch.column("size").take(take),
                                pa.array(np.full(len(some), dx == dy == 0)),
                                blobs.take(take),
                            ],
                            names=["block", "cx", "cy", "id", "size", "home", "vector"],
                        )

    return run


def _compare(dimensions: int, cosine: float, dtype: str) -> Callable:
    def run(key, table):
        turn, edges, allowed = rotation(dimensions), block_edges(dimensions), budgets(dimensions, cosine)
        block = key[0].as_py()
        a, b = edges[block]
        raw = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype).astype(np.float64).reshape(-1, dimensions)
        ids, size = np.asarray(table["id"]), np.asarray(table["size"])
        unit = units(raw)
        turned = unit @ turn
        rows, others = (np.flatnonzero(np.asarray(table[c])) for c in ("is_left", "is_right"))
        # In order of a third coordinate, a stripe of rows meets only the others within range of it.
        # Distances are screened in single precision with room for its rounding, then taken in double.
        z = min(a + 2, b - 1)
        rows, others = (side[np.argsort(turned[side, z], kind="stable")] for side in (rows, others))
        reach = np.sqrt(allowed[block]) + 1e-6
        there = turned[others, a:b].astype(np.float32)
        norm, order = (there * there).sum(axis=1), turned[others, z]
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, len(rows), STRIPE):
            mine = rows[start : start + STRIPE]
            low, high = np.searchsorted(order, [turned[mine[0], z] - reach, turned[mine[-1], z] + reach])
            here = turned[mine, a:b].astype(np.float32)
            near = here @ there[low:high].T
            near *= -2
            near += norm[low:high]
            i, j = np.nonzero(near <= (allowed[block] + 1e-5 - (here * here).sum(axis=1))[:, None])
            i, j = mine[i], others[low + j]
            for s in range(0, len(i), 1 << 17):
                links.append(_verified(i[s : s + (1 << 17)], j[s : s + (1 << 17)], unit, turned, ids, edges, allowed, block, cosine))
        i = np.concatenate([x for x, _ in links]) if links else np.zeros(0, int)
        j = np.concatenate([y for _, y in links]) if links else np.zeros(0, int)
        counts = np.bincount(i, weights=size[j], minlength=len(ids)).astype(np.int64)
        # The same vector can stand on both sides; the smallest id of each group of linked ones.
        places, at = np.unique(ids, return_inverse=True)
        star = np.arange(len(places))
        while len(i):
            low = np.minimum(star[at[i]], star[at[j]])
            after = star.copy()
            for side in (i, j):
                np.minimum.at(after, star[at[side]], low)
            after = after[after]
            if (after == star).all():
                break
            star = after[star]
        held = np.unique(np.concatenate([i, j]))
        return pa.table({"id": ids[held], "links": counts[held], "star": places[star[at[held]]]})

    return run


def _verified(i, j, unit, turned, ids, edges, allowed, block, cosine) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with enough cosine that no earlier block finds as well."""
    other = ids[i] != ids[j]
    i, j = i[other], j[other]
    near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
    i, j = i[near], j[near]
    gap = turned[i] - turned[j]
    gap *= gap
    inside = np.add.reduceat(gap, [a for a, _ in edges], axis=1) <= allowed if len(i) else np.zeros((0, len(edges)), bool)
    first = inside[:, block] & ~inside[:, :block].any(axis=1)
    return i[first], j[first]
