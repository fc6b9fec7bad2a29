"""Ordinal regression: held-out accuracy, gradients, odd rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from citypulse.llm import toxicity as X

from .conftest import DOCUMENTS, sentence

SIGNS = ("vile", "rotten", "hateful")


def toxic_text(seed: int, grade: int) -> str:
    words = sentence(seed, 30 + seed % 40).split()
    for k in range(grade * 2):
        words.insert((seed * 7 + k * 11) % len(words), SIGNS[(seed + k) % 3] + ("," if k % 2 else ""))
    if grade == 2:
        words.append("worst")
    return " ".join(words)


def made(first: int, count: int) -> tuple[list[tuple], list[int]]:
    grades = [(0, 0, 0, 1, 2)[i % 5] for i in range(first, first + count)]
    return [(i, toxic_text(i, g), "en", "s", 1) for i, g in zip(range(first, first + count), grades)], grades


@pytest.fixture(scope="module")
def model(spark):
    rows, grades = made(0, 1_000)
    labels = [(r[0], g) for r, g in zip(rows, grades)]
    return X.fit(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, "doc_id long, grade int"))


def test_held_out_accuracy(spark, model):
    rows, grades = made(5_000, 500)
    got = {r.doc_id: r for r in X.severity(spark.createDataFrame(rows, DOCUMENTS), model).collect()}
    right = [got[r[0]].grade == g for r, g in zip(rows, grades)]
    assert np.mean(right) > 0.97
    found = [(got[r[0]].grade > 0) == (g > 0) for r, g in zip(rows, grades)]
    assert np.mean(found) > 0.99
    means = [np.mean([got[r[0]].expected_severity for r, g in zip(rows, grades) if g == k]) for k in range(3)]
    assert means[0] < 0.1 < means[1] < means[2]


def test_shared_weights_and_ordered_thresholds(model):
    assert list(model.thresholds) == sorted(model.thresholds)
    assert len(model.thresholds) == 2 and 0 < len(model.weights) < 40
    chances = model.chances(0.0)
    assert chances == sorted(chances, reverse=True)


def test_descent_reaches_a_stationary_point():
    dice = np.random.default_rng(1)
    n, width = 400, 6
    dense = dice.random((n, width)) < 0.3
    score = dense @ np.array([2.0, -1.0, 0, 0, 1.0, 0]) + dice.logistic(size=n)
    y = (score > 0).astype(int) + (score > 1.5)
    row, column = np.nonzero(dense)
    mean = X._Loss(row, column, width, y, l2=1e-3)
    w, t = X._refined(mean, mean.start())
    assert X._picked(mean, np.zeros(width), rounds=2_000)[0] == pytest.approx(w, abs=1e-3)

    def loss(w, t):
        s = dense @ w
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        upper = 1 / (1 + np.exp(np.clip(edges[y] - s, -40, 40)))
        lower = 1 / (1 + np.exp(np.clip(edges[y + 1] - s, -40, 40)))
        upper[y == 0], lower[y == 2] = 1, 0
        return -np.log(upper - lower).mean() + 5e-4 * w @ w

    best = loss(w, t)
    for k in range(width):
        for step in (-0.02, 0.02):
            assert loss(w + step * np.eye(width)[k], t) > best
    for k in range(2):
        for step in (-0.02, 0.02):
            assert loss(w, t + step * np.eye(2)[k]) > best


def test_grades_of_labels(spark):
    rows = [(1, 0), (2, 1), (6, None), (None, 1), (7, 0), (7, 1)]
    got = X.graded(spark.createDataFrame(rows, "doc_id long, toxic int")).collect()
    assert {r.doc_id: r.grade for r in got} == {1: 0, 2: 1, 7: 1}


def test_toxic_or_not_becomes_three_grades():
    dice = np.random.default_rng(2)
    found, y = [], []
    for i in range(2_000):
        toxic = i % 5 == 0
        signs = dice.choice(12, size=1 + i % 8, replace=False) if toxic else []
        found.append(np.unique(np.concatenate((100 + dice.choice(3_000, 30), signs)).astype(np.int32)))
        y.append(int(toxic))
    model = X._fitted(found, np.array(y))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    score = [sum(model.weights.get(int(b), 0) for b in f) for f in found]
    grade = [sum(p >= 0.5 for p in model.chances(s)) for s in score]
    assert np.mean([(g > 0) == (t > 0) for g, t in zip(grade, y)]) > 0.99
    many = [g for g, f in zip(grade, found) if (f < 12).sum() >= 6]
    assert np.mean(np.array(many) == 2) > 0.9
    assert len(X._fitted(found, np.array(y), None).thresholds) == 1


def test_odd_rows(spark, model, odd_docs, odd_rows, no_docs):
    scored = X.severity(odd_docs, model)
    assert scored.count() == len(odd_rows)
    assert X.severity(no_docs, model).collect() == []
    labels = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = X.accepted(odd_docs, labels)
    assert kept.columns == odd_docs.columns


def test_without_two_grades_nothing_is_rejected(spark, odd_docs, odd_rows):
    for labels in ([], [(1, 1, 0)], [(1, 1, 1), (2, 1, 1)], [(9_999, 1, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert X.accepted(odd_docs, frame).count() == len(odd_rows)


def test_the_sample_is_bounded(spark):
    rows, grades = made(0, 100)
    docs = spark.createDataFrame(rows * 3, DOCUMENTS)
    labels = spark.createDataFrame([(r[0], g) for r, g in zip(rows, grades)], "doc_id long, grade int")
    a, b = X.fit(docs, labels, sample_rows=30), X.fit(docs.repartition(5), labels, sample_rows=30)
    assert a == b


def slow_severity(text: str | None, model: X.Model) -> tuple[float, int]:
    """Expected severity and grade of a text, from its different words one by one."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        lowered = lowered.replace(space, " ")
    words = {w.strip(X.MARKS.decode()) for w in lowered.split(" ")} - {""}
    places = {zlib.crc32(w.encode()) % X.BINS for w in words}
    score = math.fsum(model.weights.get(b, 0.0) for b in places)
    chances = [1 / (1 + math.exp(min(max(t - score, -50), 50))) for t in model.thresholds]
    return sum(chances), sum(p >= 0.5 for p in chances)


def test_scores_equal_those_by_single_words(spark, model, odd_docs):
    rows, _ = made(9_000, 200)
    rows += [(1, " ".join(SIGNS) * 5_000, "en", "s", 1), (2, "VILE!, (Rotten) 'hateful'\x0b...", "en", "s", 1), (2, "é vile", "en", "s", 1)]
    for docs in (odd_docs, spark.createDataFrame(rows, DOCUMENTS)):
        for r in X.severity(docs, model).collect():
            expected, grade = slow_severity(r.text, model)
            assert r.expected_severity == pytest.approx(expected, abs=2e-6) and r.grade == grade


def test_the_query_equals_scores_by_single_words(spark):
    """All documents of the small tables, with the model that the query itself fits."""
    from citypulse.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = X.fit(docs, X.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    want = sorted((r.doc_id, *slow_severity(r.text, model)) for r in docs.collect())
    got = sorted((r.doc_id, r.expected_severity, r.grade) for r in queries.queries()["op8_toxicity"](spark, sf_dir).collect())
    assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=2e-6)
