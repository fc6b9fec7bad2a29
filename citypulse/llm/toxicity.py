"""Severity grades by cumulative-link ordinal regression over the words of a text.

The model is P(grade >= k) = sigmoid(score - threshold_k) with one weight vector for all the
ordered thresholds. A word counts once for a document, however often it occurs. It is fitted twice:
with an L1 penalty in proportion to what chance does to a word of its frequency, which picks the few
words that matter, then on those alone with a slight ridge, which takes back the shrinkage. Fitting uses a bounded sample of the labelled rows; scoring reads
every document whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.llm.common import judged, map_rows, word_blocks

BINS = 1 << 20
#: Labelled documents that the fit uses at most: those with the smallest hash of their doc_id.
SAMPLE_ROWS = 24_000
#: Words in fewer sampled documents, or in more than this share of them, are no features.
LEAST_DOCS, COMMON = 4, 0.5
PENALTY = 1.0
SEVERE_WORDS = 4
RIDGE = 1e-5
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CACHED_WORDS = 200_000


@dataclass(frozen=True)
class Model:
    """weights: by bin; thresholds: ascending, one for each grade from 1 on."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def chances(self, score: float) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        return [1 / (1 + np.exp(np.clip(t - score, -50, 50))) for t in self.thresholds]


class _Bins(dict):
    """The bin of a word as it stands in the text, -1 for one that is all marks."""

    def __missing__(self, word: bytes) -> int:
        bare = word.lower().strip(MARKS)
        found = zlib.crc32(bare) % BINS if bare else -1
        if len(self) < CACHED_WORDS:
            self[word] = found
        return found


def bins(text: bytes | None, known: _Bins) -> set[int]:
    """The bins of a whole text's words: lower case (A-Z), without marks at either end."""
    found: set[int] = set()
    for words in word_blocks(text or b""):
        found.update(map(known.__getitem__, words))
    found.discard(-1)
    return found


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade from the column toxic (0 or 1).

    A null toxic gives no label; of several labels of a document the highest counts.
    """
    rows = labels.where("doc_id is not null and toxic is not null")
    return rows.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("grade"))


def fit(
    docs: DataFrame, grades: DataFrame, sample_rows: int = SAMPLE_ROWS, severe_words: int | None = SEVERE_WORDS
) -> Model:
    """A model from ``grades`` (doc_id, grade: 0, 1, ...) of documents.

    Labels that only tell 0 from 1 do not say how severe a case is: with ``severe_words`` the
    documents of grade 1 that hold so many different ones of the picked words, or more, are grade 2.
    Labels without a document are left out. Without two different grades the model gives grade 0
    to everything. Only the bins of the sampled documents' words come to the driver.
    """
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    present = grades.join(docs.select("doc_id"), "doc_id", "left_semi")
    sample = present.orderBy(order, "doc_id").limit(sample_rows)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        known = _Bins()
        for doc_id, text, grade in rows:
            yield doc_id, grade, np.array(sorted(bins(text, known)), dtype=np.int32).tobytes()

    # broadcast: sample_rows rows of two numbers at most
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = map_rows(texts, run, "doc_id long, grade int, bins binary", binary=("text",))
    # rows with the same doc_id make one example each, up to the bound
    rows = sorted(map(tuple, found.orderBy(F.xxhash64("doc_id", F.lit("toxicity"))).limit(sample_rows).collect()))
    return _fitted([np.frombuffer(r[2], dtype=np.int32) for r in rows], np.array([r[1] for r in rows], dtype=int), severe_words)


def _fitted(found: list[np.ndarray], y: np.ndarray, severe_words: int | None = SEVERE_WORDS) -> Model:
    if len(np.unique(y)) < 2:
        return Model({}, (np.inf,) * max(1, int(y.max(initial=0))))
    n = len(y)
    docs_with = np.bincount(np.concatenate(found), minlength=BINS)
    usual = (docs_with >= LEAST_DOCS) & (docs_with <= max(COMMON * n, LEAST_DOCS))
    row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in found])
    column = np.concatenate(found)
    row, column = row[usual[column]], column[usual[column]]
    # a word that means nothing leans to either side by about this much
    share = docs_with / n
    toxic = (y > 0).mean()
    chance = np.sqrt(share * (1 - share) * toxic * (1 - toxic) / n)
    penalty = PENALTY * np.sqrt(2 * np.log(usual.sum() + 2)) * chance
    lean = np.abs(np.bincount(column, weights=(y > 0)[row] - toxic, minlength=BINS)) / n
    features = np.flatnonzero(usual & (lean >= penalty / 2))

    def restricted(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(BINS, -1)
        place[kept] = np.arange(len(kept))
        inside = place[column] >= 0
        return row[inside], place[column[inside]]

    weights, _ = _picked(_Loss(*restricted(features), len(features), y, l2=0), penalty[features])
    kept = features[weights != 0]
    if severe_words and y.max() == 1:
        signs, _ = restricted(features[weights > 0])
        y = y + ((y == 1) & (np.bincount(signs, minlength=n) >= severe_words))
    loss = _Loss(*restricted(kept), len(kept), y, l2=RIDGE)
    weights, thresholds = _refined(loss, loss.start())
    return Model({int(k): float(w) for k, w in zip(kept, weights)}, tuple(map(float, thresholds)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Loss:
    """The mean negative log-likelihood, with a ridge on the weights; rows and columns of the ones."""

    def __init__(self, row, column, width, y, l2):
        self.row, self.column, self.width, self.y, self.l2 = row, column, width, y, l2
        self.n, self.grades = len(y), int(y.max())

    def start(self) -> np.ndarray:
        above = np.array([np.clip(np.mean(self.y >= k), 0.5 / self.n, 1 - 0.5 / self.n) for k in range(1, self.grades + 1)])
        return -np.log(above / (1 - above)) + np.arange(self.grades) * 1e-6

    def __call__(self, w: np.ndarray, t: np.ndarray, slope: bool = True):
        """The value, and the slopes for the weights and the thresholds. Infinite if those are out of order."""
        if (np.diff(t) <= 0).any():
            return np.inf, None, None
        y = self.y
        score = np.bincount(self.row, weights=w[self.column], minlength=self.n)
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        low, high = _sigmoid(score - edges[y]), _sigmoid(score - edges[y + 1])
        low[y == 0], high[y == self.grades] = 1, 0
        inside = np.maximum(low - high, 1e-12)
        value = -np.log(inside).mean() + self.l2 / 2 * (w @ w)
        if not slope:
            return value, None, None
        pull = (low + high - 1) / self.n
        dw = np.bincount(self.column, weights=pull[self.row], minlength=self.width) + self.l2 * w
        dt = np.bincount(y, weights=low * (1 - low) / inside, minlength=self.grades + 2)
        dt -= np.bincount(y + 1, weights=high * (1 - high) / inside, minlength=self.grades + 2)
        return value, dw, dt[1:-1] / self.n


def _picked(loss: _Loss, l1: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient, with a step that adapts."""
    w, t = np.zeros(loss.width), loss.start()
    vw, vt, momentum, step = w, t, 1.0, 4.0
    for _ in range(rounds):
        value, dw, dt = loss(vw, vt)
        while True:
            nw = vw - step * dw
            nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
            nt = np.maximum.accumulate(vt - step * dt) + np.arange(len(t)) * 1e-9
            gw, gt = nw - vw, nt - vt
            bound = value + dw @ gw + dt @ gt + (gw @ gw + gt @ gt) / (2 * step)
            if loss(nw, nt, slope=False)[0] <= bound + 1e-12 or step < 1e-6:
                break
            step /= 2
        if (vw - nw) @ (nw - w) + (vt - nt) @ (nt - t) > 0:  # overshot: start the momentum anew
            momentum = 1.0
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pace = (momentum - 1) / after
        moved = np.abs(nw - w).max(initial=0) + np.abs(nt - t).max(initial=0)
        vw, vt = nw + pace * (nw - w), np.maximum.accumulate(nt + pace * (nt - t)) + np.arange(len(t)) * 1e-9
        w, t, momentum, step = nw, nt, after, step * 1.3
        if moved < 1e-5:
            break
    return w, t


def _refined(loss: _Loss, t: np.ndarray, rounds: int = 300, memory: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """The minimum without an L1 penalty, by limited-memory BFGS."""
    x = np.concatenate((np.zeros(loss.width), t))
    cut = loss.width

    def at(x):
        value, dw, dt = loss(x[:cut], x[cut:])
        return value, None if dw is None else np.concatenate((dw, dt))

    value, slope = at(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, used = slope.copy(), []
        for s, g, r in reversed(past):
            used.append(r * (s @ way))
            way -= used[-1] * g
        if past:
            s, g, _ = past[-1]
            way *= (s @ g) / (g @ g)
        for (s, g, r), a in zip(past, reversed(used)):
            way += s * (a - r * (g @ way))
        drop, step = slope @ way, 1.0
        while (found := at(x - step * way))[0] > value - 1e-4 * step * drop and step > 1e-10:
            step /= 2
        if found[1] is None or step <= 1e-10:
            break
        s, g = -step * way, found[1] - slope
        if s @ g > 1e-14:
            past = [*past[-(memory - 1) :], (s, g, 1 / (s @ g))]
        x, (value, slope) = x + s, found
        if np.abs(slope).max() < 1e-7:
            break
    return x[:cut], x[cut:]


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, and expected_severity (double) and grade (int).

    expected_severity is the sum of the chances of reaching each grade, at six places; the grade is
    the number of thresholds that are reached with a chance of one half or more. A null or empty
    text has the score 0. Columns of these names in ``docs`` are replaced.
    """
    added = T.StructType().add("expected_severity", T.DoubleType()).add("grade", T.IntegerType())

    def make():
        chances = _chances(model)

        def judge(text: bytes | None) -> tuple[float, int]:
            found = chances(text)
            return float(round(sum(found), 6)), sum(p >= 0.5 for p in found)

        return judge

    return judged(docs, "text", make, added)


def _chances(model: Model):
    """Function from a text to its chances of each grade; words are looked up once a task."""
    known, weights = _Bins(), model.weights

    def chances(text: bytes | None) -> list[float]:
        return model.chances(sum(weights[b] for b in sorted(bins(text, known)) if b in weights))

    return chances


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` of grade 0, with all columns; nothing is shuffled."""
    model = fit(docs, graded(labels))

    def make():
        chances = _chances(model)
        return lambda text: max(chances(text), default=0.0) < 0.5

    return judged(docs, "text", make)
