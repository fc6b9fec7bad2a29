"""Exact search against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from citypulse.llm import vafile as V

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def slow(rows: list[tuple], k: int = 10, queries: list[tuple] | None = None) -> list[tuple]:
    def numbers(vector):
        return [math.floor(1024 * float(np.float32(x))) for x in vector]

    valid = {
        (i, tuple(numbers(v))) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    asked = [r for r in valid if r[0] % 100 == 0] if queries is None else [(i, tuple(numbers(v))) for i, v, *_ in queries]
    out = []
    for q, a in asked:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def vectors(count: int, width: int = 8, seed: int = 1) -> list[tuple]:
    dice = np.random.default_rng(seed)
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(dice.normal(0, 0.3, (count, width)).astype(np.float32))]


def found(frame, **options) -> list[tuple]:
    return sorted(map(tuple, V.top_k(frame, **options).collect()))


def test_equals_all_products(spark, monkeypatch):
    monkeypatch.setattr(V, "VECTORS_A_CHUNK", 97)
    monkeypatch.setattr(V, "QUERIES_A_BLOCK", 4)
    rows = vectors(1_000)
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)


def test_ties_copies_and_bad_vectors(spark):
    rows = vectors(150, width=3, seed=4)
    same = rows[100][1]
    rows += [(i, same, 0) for i in range(1_000, 1_200)]  # copies of a query, two queries among them
    rows += [(i, [0.0, 0.0, 0.0], 0) for i in range(2_000, 2_030)]
    rows += [
        (3_000, None, 0), (3_100, [], 0), (3_200, [1.0, None, 1.0], 0), (3_300, [1.0, float("nan"), 1.0], 0),
        (3_400, [1.0, float("inf"), 1.0], 0), (None, [9.0, 9.0, 9.0], 0), rows[0], rows[0], (-100, [0.1, -0.2, 0.3], None),
    ]
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)


def test_few_rows_and_none(spark):
    rows = vectors(4)
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)
    assert len(found(spark.createDataFrame(rows, EMBEDDINGS))) == 3
    assert found(spark.createDataFrame(rows[1:], EMBEDDINGS)) == []
    assert found(spark.createDataFrame([], EMBEDDINGS)) == []
    assert found(spark.createDataFrame(rows[:1], EMBEDDINGS)) == []


def test_lengths_differ(spark):
    rows = [*vectors(120, width=5), *((i + 500, v[:3], 0) for i, v, _ in vectors(60, width=5, seed=8))]
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)


def test_own_queries_and_k(spark):
    rows, asked = vectors(300), [(7, vectors(1, seed=9)[0][1], 0), (5_000, vectors(1, seed=10)[0][1], 0)]
    got = found(spark.createDataFrame(rows, EMBEDDINGS), queries=spark.createDataFrame(asked, EMBEDDINGS), k=3)
    assert got == slow(rows, 3, asked)


@pytest.mark.parametrize("scale", [1e-4, 1.0, 1e4])
def test_scales(spark, scale):
    rows = [(i, [float(np.float32(x * scale)) for x in v], 0) for i, v, _ in vectors(300, seed=3)]
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)


def keyed(spark, rows: list[tuple]):
    numbers = V.whole_numbers(spark.createDataFrame(rows, EMBEDDINGS))
    return numbers.withColumnRenamed("vec_id", "key")


def test_few_exact_vectors_are_read(spark, monkeypatch):
    rows = vectors(8_000, width=32)
    monkeypatch.setattr(V, "QUERIES_A_BLOCK", 32)
    counts = []
    for size in (2_000, 125):
        monkeypatch.setattr(V, "VECTORS_A_CHUNK", size)
        near = V.candidates(keyed(spark, rows), keyed(spark, rows).where("key % 100 = 0"), 11)
        counts.append(near.count())
        assert near.groupBy("query").count().where("count < 11").count() == 0
    # of 80 x 8,000 pairs; what is left by all bounds does not depend on the chunks
    assert counts[0] == counts[1] < 0.05 * 80 * 8_000


def test_bounds_go_on_from_chunk_to_chunk():
    dice = np.random.default_rng(0)
    exact = np.floor(1024 * dice.normal(0, 0.2, (20_000, 32))).astype(np.int64)
    low, high = exact.min(0).astype(float), exact.max(0).astype(float)
    step = (high - low) / V.CELLS
    cells = np.clip(np.floor((exact - low) / step), 0, 255).astype(np.uint8)
    sizes = []
    for chunk in (20_000, 1_000, 7):
        block = V._Block([1, 2], exact[:2], low, step, 11)
        for start in range(0, len(exact) if chunk > 7 else 700, chunk):
            block.meet(cells[start : start + chunk], np.arange(start, min(start + chunk, len(exact))))
        found = list(block.candidates())
        for query, place, upper, lower in found:
            assert lower <= int(exact[query - 1] @ exact[place]) <= upper
        if chunk > 7:
            sizes.append(len(found))
            for query in (1, 2):
                best = np.argsort(-(exact @ exact[query - 1]), kind="stable")[:11]
                assert set(best.tolist()) <= {p for q, p, *_ in found if q == query}
    assert sizes[0] == sizes[1] < 400


def test_reading_stops_when_the_kth_is_certain():
    query = np.array([1], dtype="<i8").tobytes()
    read = []

    class Ids(list):
        def __iter__(self):
            read.append(self[0])
            return super().__iter__()

    rows = [(0, None, query, [100])]
    rows += [(0, float(v + 1), np.array([v], dtype="<i8").tobytes(), Ids([v])) for v in range(50, 0, -1)]
    assert list(V._in_order(rows, 3)) == [(100, 50, 50), (100, 49, 49), (100, 48, 48)]
    assert read == [50, 49, 48, 47]  # 47 may still reach 48 by its bound


def test_numbers_that_are_too_large(spark):
    large = [(100, [1e6, 1e6], 0), (1, [1e6, 7e5], 0), (2, [-1e6, 1e6], 0), (3, [1.0, 2.0], 0)]
    assert found(spark.createDataFrame(large, EMBEDDINGS)) == slow(large)  # past the exact range of a double
    with pytest.raises(Exception, match="score does not fit"):
        found(spark.createDataFrame([(100, [3e9, 3e9], 0), (1, [3e9, 3e9], 0)], EMBEDDINGS))
    with pytest.raises(Exception, match="component does not fit"):
        found(spark.createDataFrame([(100, [1e16], 0), (1, [1.0], 0)], EMBEDDINGS))


def test_narrow_ranges_far_from_zero(spark):
    dice = np.random.default_rng(2)
    rows = [(i, [float(np.float32(3e5 + x)) for x in v], 0) for i, v in enumerate(dice.normal(0, 0.5, (400, 4)))]
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)


def test_an_id_with_two_vectors(spark):
    rows = vectors(200, width=4)
    rows += [(7, [0.5, -0.5, 0.25, 1.0], 0), (8, rows[9][1], 0)]
    assert found(spark.createDataFrame(rows, EMBEDDINGS)) == slow(rows)
