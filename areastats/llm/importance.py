"""Importance resampling: draw the documents whose n-grams look most like a target's.

N-grams are hashed into buckets. What a bucket gains is the logarithm of how much more of the target
falls into it than of the corpus; a document's weight is the mean gain of its n-grams. Gumbel noise
that depends on the id alone is added, so the highest scores are a draw without replacement in proportion to
the weights.

Two passes over the texts, each on whole batches with a table of n-grams (``ngram_table``): one adds
up buckets, one gathers gains. Between them the driver holds one number per bucket. The draw is
ordered over range partitions; only the drawn rows move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import inner_prefix
from areastats.llm.ngram_table import batches_of, intern
from areastats.session import stage

#: Buckets that n-grams are hashed into.
BUCKETS = 10_000
#: N-grams have one to so many words.
MAX_N = 1
#: Per cent of the documents with ``MIN_WORDS`` words that are drawn.
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
_INDEX_BITS = 33


def bucket_counts(texts: DataFrame, text_col: str = "text", *, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, pieces in batches_of(batch.column(0).to_pylist(), max_n):
                found = intern(pieces, max_n, buckets)
                np.add.at(total, found.bucket, found.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    counts = texts.select(F.col(f"`{text_col}`")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket in thousandths, rounded down; one is added to every count."""
    buckets = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + buckets) / ((source + 1.0) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigher(gains, max_n: int) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for of, pieces in batches_of(batch.column("text").to_pylist(), max_n):
                found = intern(pieces, max_n, len(gains.value))
                n, gained = found.per_text(gains.value[found.bucket])
                for sums, values in ((words, found.n_words), (features, n), (total, gained)):
                    np.add.at(sums, of, values)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            arrays = [batch.column("doc_id"), *map(pa.array, (words, features, weight))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return weigh


def importance_draw(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` per cent (rounded down) are drawn; ``rank``
    is 1, 2, 3 ... from the highest score, ties to the smaller id, and NULL for rows not drawn. NULL
    and empty texts have no n-grams, weight 0 and are not drawn (unless ``min_words`` is 0). A NULL id
    is hashed like an empty one and comes before all others. Rows with equal ids and scores are drawn one
    by one, in any order among them. An empty target leaves all gains to the corpus; an empty corpus
    gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    source = bucket_counts(docs, text_col, max_n=max_n, buckets=buckets)
    aim = bucket_counts(target, target_text_col, max_n=max_n, buckets=buckets)
    gains = spark.sparkContext.broadcast(bucket_gains(source, aim))  # one number per bucket
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    weighed = rows.mapInArrow(_weigher(gains, max_n), f"doc_id {id_type}, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id())
    return _ranked(stage(scored, "scored"), percent, min_words).drop("row")


def _ranked(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    # Scores are whole numbers within some ten thousands, whatever the number of documents.
    enough = F.col("n_words") >= min_words
    levels = sorted(((r["score"], r["n"]) for r in scored.where(enough).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in levels) // 100
    cutoff, above = None, 0
    for score, n in levels:
        if above >= wanted:
            break
        cutoff, above = score, above + n
    none = F.lit(None).cast("long")
    if cutoff is None:
        return scored.withColumn("rank", none)
    high = enough & (F.col("score") >= cutoff)
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    parts = max(1, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = scored.where(high).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = stage(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part, index = F.shiftright("place", _INDEX_BITS), F.col("place").bitwiseAND((1 << _INDEX_BITS) - 1)
    counts = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in counts)]).tolist()
    offsets = scored.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part long, before long")
    ranked = ordered.join(F.broadcast(offsets), part == F.col("part")).withColumn("rank", F.col("before") + index + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("place", "part", "before")
    return ranked.unionByName(scored.where(~high).withColumn("rank", none))


def draw_documents(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; rows that share an id come together."""
    drawn = importance_draw(docs, target, id_col=id_col, **options).where("rank is not null")
    name = f"{inner_prefix(docs)}id"
    return docs.join(drawn.select(F.col("doc_id").alias(name)), F.col(f"`{id_col}`").eqNullSafe(F.col(name)), "left_semi")
