"""Language by sparse multinomial logistic regression on TF-IDF weighted character n-grams.

Weights are trained by follow-the-regularised-leader (proximal, one learning rate per weight) with
L1 and L2 penalties, on a bounded sample per language; document frequencies come from all rows
that may be learned from. A temperature fitted on a part of the sample that is not trained on
makes the probabilities honest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import narrow
from areastats.llm.ngrams import NGrams, document_frequencies, inverse_frequencies
from areastats.llm.quality import held_out

#: About so many documents of each language are trained on.
SAMPLE = 400
#: Hashed n-grams.
SLOTS = 1 << 14
ORDERS = (1, 2, 3)
#: Learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
EPOCHS = 4
#: One in so many sample rows is kept for the temperature.
CALIBRATION = 5
#: Language of a text without a letter.
UNKNOWN = "und"


def gram_counter() -> Callable[[str], np.ndarray]:
    return NGrams("letters", ORDERS, SLOTS, run=1 << 30).counts


def sparse_row(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and TF-IDF values, of length 1."""
    slots = np.flatnonzero(counts)
    values = (1 + np.log(counts[slots])) * idf[slots]
    return slots, values / max(np.linalg.norm(values), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class FTRL:
    """Follow-the-regularised-leader for softmax regression with sparse inputs."""

    def __init__(self, slots: int, classes: int):
        self.z, self.n = np.zeros((slots, classes)), np.zeros((slots, classes))

    def weights(self, slots) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        error = softmax(values @ w)
        error[label] -= 1
        g = np.outer(values, error)
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    a, b, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int) -> tuple[np.ndarray, float]:
    """Weights and temperature from sparse rows in a fixed order."""
    model = FTRL(SLOTS, classes)
    held = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(np.flatnonzero(~held)):
            model.learn(*rows[i], labels[i])
    w = model.weights(slice(None))
    logits = np.array([values @ w[slots] for (slots, values), h in zip(rows, held, strict=True) if h])
    return w, temperature(logits, labels[held])


def predict_language(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """Id, ``held_out``, ``lang_pred`` and ``score`` of every row.

    Learned from text and language of the rows with crc32(id) mod 4 other than 2 and a language.
    Of each language about ``sample`` rows are trained on, those with the smallest hash of id and text
    (all, if it has fewer). A NULL text or one without a letter is ``und`` with score 0; if there
    is nothing to learn from, every text is. A single learned language gets every other text.
    Repeated rows get equal results; a NULL id counts as an empty one. Other columns are not
    looked at.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )
    usable = rows.where(~held_out("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n, frequencies = document_frequencies(usable, gram_counter)
    idf = inverse_frequencies(n, frequencies, SLOTS)
    # The share of each language that gives ``sample`` rows on average; no row is ranked.
    place = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 30)) / float(1 << 30)
    shares = usable.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("share"))
    # One row per language; the weights, which the driver trains, have a column for each.
    chosen = usable.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("lang", "text", "doc_id")
    languages, counted = _sample_counts(chosen)
    names = sorted(set(languages))
    labels = np.array([names.index(v) for v in languages], np.int64)
    sparse = [sparse_row(c, idf) for c in counted]
    weights, degree = train(sparse, labels, max(len(names), 1))
    model = docs.sparkSession.sparkContext.broadcast((idf, weights.astype(np.float32), degree, names))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", "text").mapInArrow(_predictor(model), f"doc_id {id_type}, lang_pred string, score double")
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def _sample_counts(chosen: DataFrame) -> tuple[list[str], list[np.ndarray]]:
    """Languages and n-gram counts of the sample: bounded by its size times the number of slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = gram_counter()
        for batch in batches:
            rows = [count(t) for t in batch.column("text").to_pylist()]
            slots = [np.flatnonzero(r) for r in rows]
            columns = [batch.column("lang"), pa.array(slots, type=pa.list_(pa.int32()))]
            columns += [pa.array([r[s] for r, s in zip(rows, slots, strict=True)], type=pa.list_(pa.int64()))]
            columns += [batch.column("order")]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "slots", "counts", "order"])

    schema = "lang string, slots array<int>, counts array<long>, order long"
    ordered = chosen.select("lang", "text", F.xxhash64("doc_id", "text").alias("order"))
    found = ordered.mapInArrow(run, schema).toArrow().sort_by([("order", "ascending"), ("lang", "ascending")])
    counted = []
    for slots, counts in zip(found["slots"], found["counts"], strict=True):
        row = np.zeros(SLOTS, np.int64)
        row[np.array(slots.values)] = np.array(counts.values)
        counted.append(row)
    return found["lang"].to_pylist(), counted


def _predictor(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, weights, degree, names = model.value
        count = gram_counter()

        def one(text: str | None) -> tuple[str, float]:
            if text is None or not names or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0
            slots, values = sparse_row(count(text), idf)
            p = softmax((values @ weights[slots]) / degree)
            best = int(p.argmax())
            return names[best], float(p[best])

        for batch in batches:
            found = [one(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([f[0] for f in found], type=pa.string()), pa.array([f[1] for f in found], type=pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return run
