"""Exact top-k search by inner product over a vector-approximation file, in two passes.

The file holds one byte a component. In the first pass blocks of queries meet chunks of cells, and no
exact vector: tables of a query's weight by component give bounds on every score, and the k-th lower
bound goes on from chunk to chunk of a task, so that a task hands on few vectors of each query, however
many chunks it sees. The second pass reads exact vectors for these candidates only, in the order
of their upper bounds, until the k-th best exact score is above the next bound. Equal vectors are
kept once with their k + 1 smallest ids: more of them can never be among the k results of a query.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.common import map_rows, materialised

K = 10
SCALE = 1024
CELLS = 256
VECTORS_A_CHUNK = 8_192
QUERIES_A_BLOCK = 512
#: Candidates that a task holds back before it hands them on; then later bounds cannot drop them here any more.
HELD = 500_000
#: Scores are longs.
LARGEST = (1 << 63) - 1


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (binary: floor(1024 x) of each component as an 8-byte number), each pair once.

    Rows without a vec_id, and vectors that are null, empty or hold null or non-finite components,
    are left out. A component that is no 8-byte number then is an error.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for vec_id, vector in rows:
            if vec_id is None or not vector or None in vector:
                continue
            exact = np.asarray(vector, dtype=np.float64)
            if np.isfinite(exact).all():
                if np.abs(SCALE * exact).max() >= LARGEST:
                    raise OverflowError(f"vec_id {vec_id}: a component does not fit into 8 bytes")
                yield vec_id, np.floor(SCALE * exact).astype("<i8").tobytes()

    return map_rows(embeddings.select("vec_id", "embedding"), run, "vec_id long, vector binary").distinct()


def _numbers(rows: list[bytes], width: int) -> np.ndarray:
    """One row for each vector; shorter ones are filled up with zeros."""
    if all(len(r) == 8 * width for r in rows):
        return np.frombuffer(b"".join(rows), dtype="<i8").reshape(-1, width)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for place, row in enumerate(rows):
        out[place, : len(row) // 8] = np.frombuffer(row, dtype="<i8")
    return out


def _ranges(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each component over all vectors; a short one counts as zeros there."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        for (vector,) in rows:
            v = np.frombuffer(vector, dtype="<i8")
            low[len(v)] = np.minimum(low.get(len(v), v), v)
            high[len(v)] = np.maximum(high.get(len(v), v), v)
        for size in low:
            yield from ((size, i, int(a), int(b)) for i, (a, b) in enumerate(zip(low[size], high[size])))

    found = map_rows(vectors.select("vector"), run, "size int, place int, low long, high long")
    # one row for each component
    rows = found.groupBy("place").agg(F.min("low"), F.max("high"), F.min("size")).orderBy("place").collect()
    shortest = min((r[3] for r in rows), default=0)
    low = np.array([r[1] if r.place < shortest else min(r[1], 0) for r in rows], dtype=np.float64)
    high = np.array([r[2] if r.place < shortest else max(r[2], 0) for r in rows], dtype=np.float64)
    return low, high


def _packed(rows: DataFrame, most: int, schema: str, pack: Callable[[np.ndarray], np.ndarray], width: int) -> DataFrame:
    """Rows (vector, key) in groups of up to ``most``: keys, and what ``pack`` makes of their vectors."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        rows = iter(rows)
        while group := list(islice(rows, most)):
            yield [key for _, key in group], pack(_numbers([v for v, _ in group], width)).tobytes()

    return map_rows(rows.select("vector", "key"), run, schema)


class _Block:
    """Bounds on the scores of a block of queries, over all chunks of cells that it meets.

    A score lies within ``slack`` of base + table . cells; all three are divided by the query's
    largest weight, so that single precision holds any of them. ``best`` has the k largest
    estimates so far: no vector counts whose estimate is more than twice the slack below the k-th.
    """

    def __init__(self, keys: list[int], queries: np.ndarray, low: np.ndarray, step: np.ndarray, k: int) -> None:
        wanted = queries.astype(np.float64)
        weights, sizes = wanted * step, np.abs(wanted)
        width = wanted.shape[1]
        self.keys, self.k = np.array(keys, dtype=np.int64), k
        self.unit = np.maximum(np.abs(weights).max(axis=1, initial=0), 1e-30)
        self.table = (weights / self.unit[:, None]).astype(np.float32)
        self.base = wanted @ (low + step / 2)
        # half a cell, what single precision may lose in the sum, and what double precision may lose in the rest
        loss = 0.5 * (1 + 1e-6) + CELLS * (width + 2) * 2.0**-23
        rest = sizes @ (np.abs(low) + CELLS * step) * 1e-12 + 1e-3
        self.slack = (np.abs(weights).sum(axis=1) * loss + rest) / self.unit
        self.best = np.full((len(keys), k), -np.inf, dtype=np.float32)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def _limit(self) -> np.ndarray:
        return np.nextafter((self.best.min(axis=1) - 2 * self.slack).astype(np.float32), np.float32(-np.inf))

    def meet(self, cells: np.ndarray, keys: np.ndarray) -> None:
        about = self.table @ cells.astype(np.float32).T
        if len(keys) >= self.k and not np.isfinite(self.best).all():
            self.best = np.maximum(self.best, np.partition(about, len(keys) - self.k, axis=1)[:, -self.k :])
            merged = True
        else:
            merged = False
        query, place = np.nonzero(about >= self._limit()[:, None])
        estimates = about[query, place]
        if not merged:
            starts = np.searchsorted(query, np.arange(len(self.keys) + 1))
            for q in np.flatnonzero(np.diff(starts)).tolist():
                every = np.concatenate((self.best[q], estimates[starts[q] : starts[q + 1]]))
                self.best[q] = np.partition(every, len(every) - self.k)[-self.k :]
        self.found.append((query, keys[place], estimates))
        self.held += len(query)

    def candidates(self) -> Iterator[tuple[int, int, float, float]]:
        """(query, class, upper, lower bound) of the vectors that the bounds of all chunks so far leave."""
        limit = self._limit()
        for query, keys, estimates in self.found:
            kept = np.flatnonzero(estimates >= limit[query])
            query, about = query[kept], estimates[kept].astype(np.float64)
            upper = self.base[query] + self.unit[query] * (about + self.slack[query])
            lower = self.base[query] + self.unit[query] * (about - self.slack[query])
            yield from zip(self.keys[query].tolist(), keys[kept].tolist(), upper.tolist(), lower.tolist())
        self.found, self.held = [], 0


def candidates(classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """query, class, upper, lower: for each query the classes that may be among its ``k`` best, by cells alone.

    Both tables have key and vector. What is left out lies below k others of the query for certain.
    """
    spark = classes.sparkSession
    low, high = _ranges(classes.select("vector").unionByName(wanted.select("vector")))
    width, step = len(low), np.maximum((high - low) / CELLS, 1e-9)

    def cells(exact: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((exact - low) / step), 0, CELLS - 1).astype(np.uint8)

    chunks = _packed(classes, VECTORS_A_CHUNK, "classes array<long>, cells binary", cells, width)
    chunks = materialised(chunks, "vafile-chunks")
    blocks = _packed(wanted, QUERIES_A_BLOCK, "queries array<long>, exact binary", lambda exact: exact, width)
    blocks = materialised(blocks, "vafile-blocks")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        block, asked = None, None
        for queries, exact, keys, packed in rows:
            if asked != queries:
                if block:
                    yield from block.candidates()
                asked = queries
                block = _Block(queries, np.frombuffer(exact, dtype="<i8").reshape(-1, width), low, step, k)
            block.meet(np.frombuffer(packed, dtype=np.uint8).reshape(-1, width), np.array(keys, dtype=np.int64))
            if block.held > HELD:
                yield from block.candidates()
        if block:
            yield from block.candidates()

    # every block meets every chunk: blocks go to all groups, a chunk to one of them. Blocks grow with
    # the table, so they are merged, which can spill, and not broadcast. The merge goes through a
    # group's chunks for one block after the other; in another order there would only be more candidates
    groups = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), chunks.count()))
    spread = blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).hint("merge")
    dealt = chunks.withColumn("to", F.pmod(F.xxhash64(F.col("classes")[0]), F.lit(groups)).cast("int"))
    pairs = spread.join(dealt, "to").select("queries", "exact", "classes", "cells")
    found = materialised(map_rows(pairs, run, "query long, class long, upper double, lower double"), "vafile-candidates")
    order = Window.partitionBy("query").orderBy(F.col("lower").desc())
    kth = found.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query", F.col("lower").alias("kth"))
    return found.join(kth, "query", "left").where("kth is null or upper >= kth").drop("kth")


def _product(a: np.ndarray, b: np.ndarray) -> int:
    """The whole product, the shorter vector going on with zeros."""
    size = min(len(a), len(b))
    a, b = a[:size], b[:size]
    if float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * size < LARGEST / 2:
        return int(a @ b)
    return sum(x * y for x, y in zip(a.tolist(), b.tolist()))


def _in_order(rows: Iterable[tuple], k: int) -> Iterator[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best of each query.

    Rows are (query, upper, vector, ids): first the query itself, its bound null, then its
    candidates by falling bounds. Those behind the one that makes the k-th result certain are passed over.
    """
    best: list[tuple[int, int]] = []
    query_id, asked = None, None

    def results() -> Iterator[tuple[int, int, int]]:
        for score, vec_id in best:
            if not -LARGEST <= score <= LARGEST:
                raise OverflowError(f"vec_id {query_id}, {vec_id}: the score does not fit into 8 bytes")
            yield query_id, vec_id, -score

    for _, upper, vector, ids in rows:
        exact = np.frombuffer(vector, dtype="<i8")
        if upper is None:
            yield from results()
            (query_id,), asked, best = ids, exact, []
        elif len(best) < k or upper >= -best[-1][0]:
            score = _product(asked, exact)
            for vec_id in ids:
                if vec_id != query_id:
                    insort(best, (-score, vec_id))
            del best[k:]
    yield from results()


def top_k(embeddings: DataFrame, queries: DataFrame | None = None, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query, ties to smaller ids.

    ``embeddings`` has vec_id and embedding; ``queries`` the same (default: the rows whose vec_id is
    divisible by 100). A vector with the query's own id is no result. Vectors of different lengths
    are compared as if the shorter one went on with zeros. Repeated rows count once. A component or
    a result's score that does not fit into 8 bytes is an error.
    """
    vectors = materialised(whole_numbers(embeddings), "vafile-vectors")
    wanted = vectors.where("vec_id % 100 = 0") if queries is None else whole_numbers(queries)
    first = Window.partitionBy("vector").orderBy("vec_id")
    members = vectors.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    classes = members.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = materialised(classes.withColumn("key", F.monotonically_increasing_id()), "vafile-classes")
    wanted = wanted.select("vector", F.array("vec_id").alias("ids"), F.monotonically_increasing_id().alias("key"))
    wanted = materialised(wanted, "vafile-queries")
    # one more than k: the query's own id may be one of them
    near = candidates(classes, wanted, k + 1).select("query", "upper", F.col("class").alias("key"))
    read = near.join(classes.hint("merge"), "key").select("query", "upper", "vector", "ids")
    asked = wanted.select(F.col("key").alias("query"), F.lit(None).cast("double").alias("upper"), "vector", "ids")
    ordered = asked.unionByName(read).repartition("query").sortWithinPartitions("query", F.col("upper").desc_nulls_first())
    found = map_rows(ordered, lambda rows: _in_order(rows, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
