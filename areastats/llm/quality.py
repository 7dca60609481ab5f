"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A document is a bag of terms: n-grams of character kinds, and marks for repeated words. TF-IDF
weights use document frequencies over all documents. The singular vectors of a bounded sample of
labelled documents span the latent space; the sample's vectors are broadcast, and every document
is compared with all of them by blocked matrix products. The ``neighbours`` most similar ones
vote, weighted by a power of their cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import narrow
from areastats.llm.ngrams import NGrams, document_frequencies, inverse_frequencies

#: Most labelled documents that are kept and broadcast.
SAMPLE = 2400
#: Hashed n-grams; marks come after them.
GRAMS = 2048
#: Each mark is one term, counted by how often it holds.
MARKS = 3
SLOTS = GRAMS + MARKS
DIMENSIONS = 48
NEIGHBOURS = 15
#: Power of the cosine in the vote.
SHARPNESS = 8
#: Documents multiplied with the labelled vectors at once.
BLOCK = 256


def term_counter() -> Callable[[str], np.ndarray]:
    """Function from a text to its term counts."""
    grams = NGrams("shapes", (3, 4), GRAMS, run=2)

    def count(text: str) -> np.ndarray:
        words = text.split()
        again = sum(map(str.__eq__, words, words[1:]))
        distinct = len(set(words))
        # A word that repeats the one before it, a word seen before, and a word at all.
        return np.concatenate([grams.counts(text), [again, len(words) - distinct, len(words)]])

    return count


class LatentSpace:
    """Vectors of texts: damped counts times inverse frequency, projected and normalised."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray):
        self.idf, self.axes = idf, axes

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        projected = weighted(counts, self.idf) @ self.axes
        size = np.linalg.norm(projected, axis=1, keepdims=True)
        return np.divide(projected, size, out=np.zeros_like(projected), where=size > 0)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1. Shares of the text, not counts, so its length does not matter."""
    grams = counts[:, :GRAMS].sum(axis=1, keepdims=True).astype(np.float32)
    share = np.sqrt(counts[:, :GRAMS] / np.maximum(grams, 1))
    words = np.maximum(counts[:, -1:], 1)
    marks = np.sqrt(counts[:, GRAMS:-1] / words)
    x = np.concatenate([share, marks, np.zeros_like(words)], axis=1).astype(np.float32) * idf
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def held_out(id_col: str, mod: int, remainder: int) -> Column:
    """Whether the checksum of the id as text leaves ``remainder``; a NULL id counts as empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(mod)) == remainder


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
    sample: int = SAMPLE,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Labels are learned only from rows with crc32(id) mod 5 other than 0, at most about ``sample``
    of them (those with the smallest hash of the id). Labels without a value or a document do
    nothing; repeated labels of an id are averaged. NULL and empty texts have no vector and get
    the mean label of the sample, 0.5 if there is none. Repeated rows get the same score. Columns of ``docs`` with the names of
    the new ones are replaced; all others stay and are not inputs.
    """
    known = (
        labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col, 5, 0))
        .groupBy(F.col(f"`{id_col}`").alias("doc_id"))
        .agg(F.avg(f"`{label_col}`").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = narrow(docs, id_col, text_col)
    n, frequencies = document_frequencies(rows, term_counter)
    idf = inverse_frequencies(n, frequencies, SLOTS)
    # At most ``sample`` rows are broadcast; repeated ids are taken once.
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    counts, votes = _sample_counts(texts)
    axes = _axes(weighted(counts, idf))
    space = LatentSpace(idf, axes)
    model = docs.sparkSession.sparkContext.broadcast((idf, axes, space.vectors(counts), votes))
    new = ["held_out", "score", "predicted"]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["score double"])
    scored = kept.mapInArrow(_scorer(model, kept.columns.index(text_col), neighbours), schema)
    return scored.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        held_out(id_col, 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _sample_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the sample: bounded by its size times the number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = term_counter()
        for batch in batches:
            rows = [count(t or "") for t in batch.column("text").to_pylist()]
            slots = [np.flatnonzero(r) for r in rows]
            columns = [batch.column("doc_id"), batch.column("label")]
            columns += [pa.array(slots, type=pa.list_(pa.int32()))]
            columns += [pa.array([r[s] for r, s in zip(rows, slots, strict=True)], type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "slots", "counts"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"doc_id {id_type}, label double, slots array<int>, counts array<long>")
    found = found.toArrow().sort_by("doc_id")
    out = np.zeros((found.num_rows, SLOTS), np.float32)
    for i, (slots, counts) in enumerate(zip(found["slots"].to_pylist(), found["counts"].to_pylist(), strict=True)):
        out[i, slots] = counts
    return out, np.array(found["label"].to_pylist(), np.float32)


def _axes(x: np.ndarray) -> np.ndarray:
    """Leading right singular vectors of the sample's term matrix."""
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    keep = np.argsort(-values)[:DIMENSIONS]
    return vectors[:, keep].astype(np.float32)


def vote(vectors: np.ndarray, labelled: np.ndarray, votes: np.ndarray, neighbours: int) -> np.ndarray:
    """Score of every vector by its nearest labelled vectors; exact over all of them."""
    if not len(votes):
        return np.full(len(vectors), 0.5)
    out = np.empty(len(vectors))
    k = min(neighbours, len(votes))
    for start in range(0, len(vectors), BLOCK):
        cosine = vectors[start : start + BLOCK] @ labelled.T
        near = np.argpartition(cosine, len(votes) - k, axis=1)[:, len(votes) - k :]
        weight = np.clip(np.take_along_axis(cosine, near, 1), 0, 1).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        score = (weight * votes[near]).sum(axis=1) / np.where(total > 0, total, 1)
        out[start : start + BLOCK] = np.where(total > 0, score, votes.mean())
    return np.clip(out, 0, 1)


def _scorer(model, text_at: int, neighbours: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, axes, labelled, votes = model.value
        space, count = LatentSpace(idf, axes), term_counter()
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            scores = [
                vote(space.vectors(np.array([count(t or "") for t in texts[a : a + BLOCK]])), labelled, votes, neighbours)
                for a in range(0, len(texts), BLOCK)
            ]
            score = np.concatenate([*scores, np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return run
