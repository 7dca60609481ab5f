import random

import numpy as np
import pytest

from brute import docs  # noqa: F401
from areastats.llm.language import FTRL, predict_language, softmax, temperature
from areastats.llm.ngrams import NGrams
from areastats.llm.quality import quality_scores, vote

ALPHABETS = {"aa": "abcde fgh", "bb": "nopqr stu", "cc": "éèñöü xyz"}


def prose(letters, n=60):
    return "".join(random.choice(letters) for _ in range(n))


def test_counts_do_not_depend_on_slices(monkeypatch):
    random.seed(1)
    text = prose("abc é, X.", 5000)
    whole = NGrams("letters", (1, 2, 3), 1 << 14, 1 << 30).counts(text)
    monkeypatch.setattr("areastats.llm.ngrams.SLICE", 777)
    assert (NGrams("letters", (1, 2, 3), 1 << 14, 1 << 30).counts(text) == whole).all()
    assert whole.sum() == 3 * (len(text) + 2) - 3


def test_learner_separates_and_sparsifies():
    rng = np.random.default_rng(0)
    model = FTRL(50, 2)
    for _ in range(400):
        y = int(rng.integers(2))
        model.learn(np.array([y, 2 + int(rng.integers(48))]), np.array([0.9, 0.4]), y)
    w = model.weights(slice(None))
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 and (w == 0).any()


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(1)
    labels = rng.integers(3, size=4000)
    honest = rng.standard_normal((4000, 3)) + 2 * np.eye(3)[labels]
    best = temperature(5 * honest, labels)

    def loss(t):
        return -np.log(softmax(5 * honest / t)[np.arange(4000), labels]).mean()

    assert loss(best) <= min(loss(best * 1.1), loss(best / 1.1))


def test_language_on_held_out_texts(docs):
    random.seed(2)
    schema = "doc_id long, text string, lang string"
    rows = [(i, prose(ALPHABETS[lang]), lang) for i in range(300) for lang in [random.choice(list(ALPHABETS))]]
    odd = [(900, None, "aa"), (901, "12 -- !", "bb"), (902, "", None), (903, prose("nopqr"), None), (904, prose("abcde", 300_000), "aa"), (None, prose("abcde"), None)]
    out = {r.doc_id: r for r in predict_language(docs([*rows, *odd, odd[3]], schema, score=1, slots="x")).collect()}
    held = [(out[i], lang) for i, _, lang in rows if out[i].held_out]
    assert len(held) > 40 and np.mean([r.lang_pred == lang for r, lang in held]) > 0.97
    assert [out[i].lang_pred for i in (900, 901, 902, 903, 904, None)] == ["und", "und", "und", "bb", "aa", "aa"]
    assert all(0 <= r.score <= 1 for r in out.values()) and out[900].score == 0


def test_language_with_nothing_or_one_language_to_learn(docs):
    schema = "doc_id long, text string, lang string"
    assert predict_language(docs([], schema)).collect() == []
    assert {r.lang_pred for r in predict_language(docs([(1, "abc", None), (2, "x", None)], schema)).collect()} == {"und"}
    assert {r.lang_pred for r in predict_language(docs([(i, "abc", "aa") for i in range(20)], schema)).collect()} == {"aa"}


def good(n=40):
    return " ".join(prose("abcdefg", random.randint(2, 8)).strip() for _ in range(n)) + "."


def bad(n=40):
    return random.choice([lambda: " ".join(prose("ABCDEF", 5) + "!!" for _ in range(n)), lambda: "word " * n, lambda: good(n).replace(" ", " | ")])()


def test_quality_on_held_out_labels(spark, docs):
    random.seed(3)
    truth = {i: int(random.random() < 0.7) for i in range(500)}
    rows = [(i, good() if q else bad()) for i, q in truth.items()] + [(900, None), (901, ""), (None, good()), (902, good(20_000)), (903, bad(20_000))]
    labels = spark.createDataFrame([*truth.items(), (1, truth[1]), (7777, 1), (None, 1), (2, None)], "doc_id long, quality int")
    df = docs(rows, score="old", label=1, slots=2)
    out = quality_scores(df, labels)
    assert set(out.columns) == {*df.columns, "held_out", "predicted"}
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [i for i in truth if found[i].held_out]
    assert len(held) > 60 and np.mean([found[i].predicted == truth[i] for i in held]) > 0.97
    assert found[902].predicted == 1 and found[903].predicted == 0 and found[900].score == found[901].score


def test_quality_does_not_look_at_held_out_labels(spark, docs):
    random.seed(4)
    rows = [(i, good() if i % 3 else bad()) for i in range(120)]
    label = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    first = {r.doc_id: (r.held_out, r.score) for r in quality_scores(docs(rows), label).collect()}
    from pyspark.sql import functions as F

    held = [i for i, (h, _) in first.items() if h]
    turned = label.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: (r.held_out, r.score) for r in quality_scores(docs(rows), turned).collect()} == first


def test_quality_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(docs([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert quality_scores(docs([]), none).collect() == []


def test_votes_against_a_loop():
    rng = np.random.default_rng(5)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (rng.standard_normal((300, 6)), rng.standard_normal((40, 6))))
    labels = rng.integers(2, size=40).astype(float)
    got = vote(x, y, labels, 5)
    for i in range(300):
        near = sorted(range(40), key=lambda j: -(x[i] @ y[j]))[:5]
        weight = [max(x[i] @ y[j], 0) ** 8 for j in near]
        assert got[i] == pytest.approx(sum(w * labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight))
