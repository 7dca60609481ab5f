"""Benchmark decontamination by spaced seeds.

A mask looks at some places of a window of tokens and ignores the others, so a window still
matches where tokens at ignored places have been replaced. Every window of the benchmark is hashed
under every mask; every window of the documents is looked up. Where a look-up hits, the benchmark
item is laid along the document at that offset and the best stretch is found: one point for each
equal token, ``PENALTY`` off for each other. A document is reported with an item if the stretch
has ``min_tokens`` equal tokens (or all tokens the item has, if fewer).

Native: per document one array of token hashes, then explode, projection and broadcast join in
one stage, whose generated loop ends in a hash table of distinct offsets. Only the tokens that lie beside
an item go on from there, never a whole document: generated code keeps all rows of a document that pass an
explode or a join in memory until the next operator outside it takes them. What the windows need of
longer loops is computed over the array before the explode, so the generated method of the window
loop stays below the size up to which the JVM compiles methods (8,000 bytes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import inner_prefix, narrow, possible
from areastats.session import stage

#: Places that count are 1. Weight 8 over 11 or 12 tokens.
MASKS = ("11101100111", "110110110011", "111011010101")
#: Equal tokens of a stretch that make a leak.
MIN_TOKENS = 12
#: What a differing token costs; a stretch with more than a quarter of them loses.
PENALTY = 3
#: A benchmark of at most so many tokens is broadcast; a larger one is shuffled by its window keys.
BLOCK_TOKENS = 500_000
_SPLIT = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text."""
    words = F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(rows: DataFrame, tokens: str, masks: Sequence[str], *keep: str) -> DataFrame:
    """``pos`` and ``key`` of every window under every mask of every row, beside the columns ``keep``.

    A key is made from the mask and the tokens it counts. Masks and places come from one explode, so a row is opened once and stays in generated code. The
    tokens of a window are columns of their own before the masks choose among them: the masks share
    them, which keeps the generated method short.
    """
    shortest, longest = min(map(len, masks)), max(map(len, masks))
    places = F.size(tokens) - shortest + 1
    steps = F.when(places > 0, F.sequence(F.lit(0), places * len(masks) - 1))
    out = rows.select(*keep, F.explode(steps).alias("__step"))
    out = out.select(*keep, F.pmod("__step", F.lit(len(masks))).alias("mask"), F.expr(f"cast(__step div {len(masks)} as int)").alias("pos"))
    lengths = F.element_at(F.array(*[F.lit(len(m)) for m in masks]), F.col("mask") + 1)
    out = out.where(F.col("pos") + lengths <= F.size(tokens))
    used = [k for k in range(longest) if any(m[k : k + 1] == "1" for m in masks)]
    out = out.select("*", *[F.get(tokens, F.col("pos") + k).alias(f"__t{k}") for k in used])
    key = None
    for m, text in enumerate(masks):
        hashed = F.xxhash64(F.lit(m), *[f"__t{k}" for k, c in enumerate(text) if c == "1"])
        key = hashed if key is None else F.when(F.col("mask") == m, hashed).otherwise(key)
    return out.select(*keep, "pos", key.alias("key"))


def best_stretch(equal: Column) -> Column:
    """Equal tokens, first and last place of the stretch with the most points, for an array of booleans."""
    none = F.struct(
        F.lit(0).alias("points"), F.lit(0).alias("equal"), F.lit(0).alias("start"),
        F.lit(0).alias("best"), F.lit(0).alias("best_equal"), F.lit(0).alias("best_start"), F.lit(-1).alias("best_end"),
        F.lit(0).alias("at"),
    )

    def step(s: Column, hit: Column) -> Column:
        fresh = s["points"] <= 0
        points = F.when(fresh, 0).otherwise(s["points"]) + F.when(hit, 1).otherwise(-PENALTY)
        equal = F.when(fresh, 0).otherwise(s["equal"]) + F.when(hit, 1).otherwise(0)
        start = F.when(fresh, s["at"]).otherwise(s["start"])
        more = points > s["best"]
        return F.struct(
            points.alias("points"), equal.alias("equal"), start.alias("start"),
            F.when(more, points).otherwise(s["best"]).alias("best"),
            F.when(more, equal).otherwise(s["best_equal"]).alias("best_equal"),
            F.when(more, start).otherwise(s["best_start"]).alias("best_start"),
            F.when(more, s["at"]).otherwise(s["best_end"]).alias("best_end"),
            (s["at"] + 1).alias("at"),
        )

    return F.aggregate(equal, none, step)


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Token hashes ``b`` of the distinct token sequences, with the lowest item id of each."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), token_hashes(F.col(f"`{text_col}`")).alias("b"))
    items = items.where(F.size("b") > 0).groupBy(F.xxhash64(F.to_json("b")).alias("class"), "b")
    return items.agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] = MASKS,
    min_tokens: int = MIN_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_equal``, ``n_tokens``, ``doc_start``, ``doc_end`` of every leak.

    One row per document and benchmark item: the stretch with the most equal tokens (then the
    first place), its equal tokens, its length, and where it lies, in tokens, end exclusive.
    Items with the same tokens are one item, the lowest id. An item with fewer tokens than a mask
    has places is found where it stands as a whole; one without tokens (or NULL) never.
    NULL and empty documents have no leak. Rows with equal ids count as one document. A
    benchmark beyond ``block_tokens`` is not broadcast but shuffled, with the same result. Other columns are not
    looked at; either table may be empty.
    """
    items = stage(benchmark_items(benchmark, item_col, item_text_col), "benchmark")
    size = items.agg(F.coalesce(F.sum(F.size("b")), F.lit(0))).first()[0]
    longest = max(map(len, masks))
    short = [r[0] for r in items.where(F.size("b") < longest).select(F.size("b")).distinct().collect()]
    rows = narrow(docs, id_col, text_col).select("doc_id", token_hashes(F.col("text")).alias("h"))
    look_up = _hits if size <= block_tokens else _shuffled_hits
    found = _verified(look_up(rows, items, masks), min_tokens)
    for length in sorted(short):  # at most as many as a mask is long
        whole = look_up(rows, items.where(F.size("b") == length), ["1" * length])
        found = found.unionByName(_verified(whole, min_tokens))
    best = F.max(F.struct("n_equal", (-F.col("doc_start")).alias("before"), "n_tokens")).alias("best")
    found = found.groupBy("doc_id", "item_id").agg(best)
    start = -F.col("best.before")
    return found.select(
        "doc_id", "item_id", "best.n_equal", "best.n_tokens", start.alias("doc_start"), (start + F.col("best.n_tokens")).alias("doc_end")
    )


def _seeds(items: DataFrame, masks: Sequence[str]) -> DataFrame:
    seeds = windows(items.where(F.size("b") >= min(map(len, masks))), "b", masks, "class", "b")
    return seeds.select("key", "class", F.col("pos").alias("ipos"), F.size("b").alias("n_item"))


def _hits(rows: DataFrame, items: DataFrame, masks: Sequence[str]) -> DataFrame:
    """Documents and items with each offset of a hit and the tokens beside the item; the benchmark is broadcast."""
    found = _offsets(rows, _seeds(items, masks), masks)
    return found.join(F.broadcast(items.select("class", "item_id", "b")), "class")


def _offsets(rows: DataFrame, seeds: DataFrame, masks: Sequence[str]) -> DataFrame:
    """Documents and classes with each offset of a hit, once for all hits along it.

    From the explode to the grouping all is one generated loop: it puts hits into a hash table that can spill.
    """
    looked = windows(rows.withColumn("runs", _runs("h", masks)), "h", masks, "doc_id", "h", "runs")
    looked = looked.where(~_shifted(F.col("pos"), masks))
    hits = looked.join(F.broadcast(seeds), "key").withColumn("offset", F.col("pos") - F.col("ipos"))
    return hits.select("doc_id", "class", "offset", _beside().alias("part")).distinct()


def _beside() -> Column:
    """The tokens of a document that lie beside those of the item."""
    first = F.greatest(F.lit(0), -F.col("offset"))
    last = F.least(F.col("n_item"), F.size("h") - F.col("offset"))
    return F.slice("h", F.col("offset") + first + 1, last - first)


def _shuffled_hits(rows: DataFrame, items: DataFrame, masks: Sequence[str]) -> DataFrame:
    """The same for a benchmark that is too large to broadcast: still one pass over the windows.

    A bitmap of fixed size keeps most windows that no item has out of the shuffle; what travels is a
    window's key and place, and the tokens are joined again for the few documents with a hit.
    """
    named = rows.withColumn("th", F.xxhash64("h"))
    seeds = stage(_seeds(items, masks), "seeds")
    looked = windows(named.withColumn("runs", _runs("h", masks)), "h", masks, "doc_id", "th", "h", "runs")
    looked = looked.where(~_shifted(F.col("pos"), masks)).select("doc_id", "th", "pos", "key")
    hits = possible(looked, "key", seeds.select("key").distinct()).join(seeds, "key")
    hits = hits.select("doc_id", "th", "class", "n_item", (F.col("pos") - F.col("ipos")).alias("offset")).distinct()
    hits = stage(hits, "hits").withColumnsRenamed({"doc_id": "hit_id", "th": "hit_th"})
    named = possible(named, "th", hits.select("hit_th").distinct()).dropDuplicates(["doc_id", "th"])
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th"))
    found = hits.join(named, same).select("doc_id", "class", "offset", _beside().alias("part"))
    return found.join(items.select("class", "item_id", "b"), "class")


def _runs(tokens: str, masks: Sequence[str]) -> Column:
    """For every place, whether one token stands there and at all places before it that the longest mask covers.

    A function over the array, outside generated code: it ends at the first different token, so it
    costs one comparison for most places, and a window needs one look-up later.
    """
    places = range(1, max(map(len, masks)) + 1)

    def same(x: Column, i: Column) -> Column:
        run = F.lit(True)
        for k in places:
            run = run & F.coalesce(x == F.get(tokens, i - k), F.lit(False))
        return run

    return F.transform(tokens, same)


def _shifted(pos: Column, masks: Sequence[str]) -> Column:
    """Whether the window at ``pos`` only repeats the one before it: one token again and again.

    The first window of such a run stands for all of it, else a text of one word would hit at every place.
    """
    return F.coalesce(F.get("runs", pos + (max(map(len, masks)) - 1)), F.lit(False))


def _verified(hits: DataFrame, min_tokens: int) -> DataFrame:
    first = F.greatest(F.lit(0), -F.col("offset"))
    lined = F.zip_with(F.slice("b", first + 1, F.size("part")), "part", lambda a, b: a == b)
    out = hits.select("doc_id", "item_id", "offset", first.alias("first"), F.size("b").alias("n_item"), best_stretch(lined).alias("s"))
    out = out.where(F.col("s.best_equal") >= F.least(F.lit(min_tokens), F.col("n_item")))
    return out.select(
        "doc_id",
        "item_id",
        F.col("s.best_equal").alias("n_equal"),
        (F.col("s.best_end") - F.col("s.best_start") + 1).alias("n_tokens"),
        (F.col("offset") + F.col("first") + F.col("s.best_start")).alias("doc_start"),
    )


def remove_leaking(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak; all columns, also documents without an id."""
    leaking = find_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("doc_id").distinct()
    gone = f"{inner_prefix(docs)}id"
    return docs.join(leaking.toDF(gone), F.col(f"`{id_col}`").eqNullSafe(F.col(gone)), "left_anti")
