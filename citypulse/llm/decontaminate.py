"""Benchmark decontamination: BM25 over the test items with block-max WAND, then overlap of question and answer.

A passage leaks an item if it holds 80 % of the item's shingles of five words, and by these either the question to 80 %,
or some of the question's and some of the answer's. So a question alone is a leak where it is most of its
item; an answer alone, without a shingle of the question, is none, however long. A part of fewer than five words is too
short to tell: it need not be there.

The test items are the indexed documents, the passages of the training texts the queries. An item's
postings are scaled so that its score in a passage is 1 when the passage just holds enough of its
words: an item of n shingles of five words of which at least 80 % are in a passage lacks at most
0.2 n of its words there, so its passage has its whole BM25 weight but that of its 0.2 n heaviest
words at the most. Retrieving every score of 1 or more therefore loses no item that the check on
shingles would accept. Passages are two neighbouring tiles, a tile holding the longest item, so
that an item lies within one passage wherever it starts.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import judged, map_rows, word_blocks

SHINGLE = 5
OVERLAP = 0.8
K1, B = 1.2, 0.75
ITEMS_A_BLOCK = 8
CACHED_WORDS = 250_000
#: The index goes to every task, so its size is checked: words of all items together. Postings and
#: block maxima are at most as many.
MOST_ITEM_WORDS = 5_000_000
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A sign that is neither white space nor one of ``MARKS``.
A_WORD = r"[^\x09-\x0D\x20-/:-@\[-`{-~]"
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass
class Item:
    item_id: int
    words: list[int]
    question: int  # how many of the words are the question's

    def shingles(self, start: int, end: int) -> set[tuple[int, ...]]:
        part = self.words[start:end]
        return {tuple(part[i : i + SHINGLE]) for i in range(max(1, len(part) - SHINGLE + 1))} if part else set()

    def leaked(self, whole: float, question: float, answer: float) -> bool:
        """Whether a passage leaks the item that holds these shares of it, its question and its answer."""
        asked = question > 0 or self.question < SHINGLE
        told = answer > 0 or len(self.words) - self.question < SHINGLE
        return whole >= OVERLAP and asked and (told or question >= OVERLAP)


@dataclass
class Index:
    """vocabulary: word -> term; postings: of each term the items and impacts; bound: by term the
    largest impact. Of the blocks of ``ITEMS_A_BLOCK`` neighbouring items a term has some: those numbered
    top_blocks[top_starts[term] : top_starts[term + 1]], ascending, with their largest impacts in tops."""

    items: list[Item]
    vocabulary: dict[bytes, int]
    postings: list[tuple[list[int], list[float]]]
    top_starts: np.ndarray
    top_blocks: np.ndarray
    tops: np.ndarray
    bound: np.ndarray
    tile: int

    def top(self, term: int, block: int) -> float:
        start, end = self.top_starts[term], self.top_starts[term + 1]
        at = start + int(np.searchsorted(self.top_blocks[start:end], block))
        return float(self.tops[at]) if at < end and self.top_blocks[at] == block else 0.0


def bare(word: bytes) -> bytes:
    return word.lower().strip(MARKS)


def question_and_answer(text: str | None) -> tuple[str, str]:
    """The last sentence or line is the answer; a single one is a question without an answer."""
    parts = [p for p in SENTENCE_END.split((text or "").strip()) if p]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (" ".join(parts), "")


def build_index(items: Iterable[tuple[int, str, str]]) -> Index:
    """The index of (item_id, question, answer); items without words are left out."""
    vocabulary: dict[bytes, int] = {}
    kept = []
    for item_id, question, answer in sorted(items, key=lambda i: (i[0] is None, i[0], i[1], i[2])):
        parts = [[w for w in map(bare, (t or "").encode().split()) if w] for t in (question, answer)]
        words = [vocabulary.setdefault(w, len(vocabulary)) for part in parts for w in part]
        if words:
            kept.append(Item(item_id, words, len(parts[0])))
    if sum(len(i.words) for i in kept) > MOST_ITEM_WORDS:
        raise ValueError(f"the items hold more than {MOST_ITEM_WORDS} words; pass them in parts")
    n = len(kept)
    mean = sum(len(i.words) for i in kept) / max(1, n)
    having = Counter(t for i in kept for t in set(i.words))
    rows: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
    for place, item in enumerate(kept):
        norm = K1 * (1 - B + B * len(item.words) / mean)
        impact = {
            t: math.log(1 + (n - having[t] + 0.5) / (having[t] + 0.5)) * tf * (K1 + 1) / (tf + norm)
            for t, tf in Counter(item.words).items()
        }
        shingles = max(1, len(item.words) - SHINGLE + 1)
        spare = sum(sorted(impact.values(), reverse=True)[: math.floor((1 - OVERLAP) * shingles + 1e-9)])
        need = max(sum(impact.values()) - spare, 1e-9)
        for t, value in impact.items():
            rows[t].append((place, value / need))
    postings = [([p for p, _ in row], [v for _, v in row]) for row in rows]
    top_starts, top_blocks, tops = np.zeros(len(rows) + 1, dtype=np.int64), array("i"), array("f")
    for t, row in enumerate(rows):
        for place, value in row:  # in the order of places
            above = np.nextafter(np.float32(value), np.float32(np.inf))
            if len(tops) > top_starts[t] and top_blocks[-1] == place // ITEMS_A_BLOCK:
                tops[-1] = max(tops[-1], above)
            else:
                top_blocks.append(place // ITEMS_A_BLOCK)
                tops.append(above)
        top_starts[t + 1] = len(tops)
    maxima = np.array(tops, dtype=np.float32)
    # a term of the vocabulary is in an item, so it has a block
    bound = np.maximum.reduceat(maxima, top_starts[:-1]) if rows else maxima
    longest = max((len(i.words) for i in kept), default=1)
    return Index(kept, vocabulary, postings, top_starts, np.array(top_blocks, dtype=np.int32), maxima, bound, longest)


#: Block maxima that are added up at a time.
AT_A_TIME = 2_000_000
#: The threshold, less what sums of rounded numbers may be short of it.
ENOUGH = 1 - 1e-5


def retrieve(index: Index, terms: list[int]) -> list[tuple[int, float]]:
    """Every item that scores 1 or more on the given terms, by block-max WAND."""
    lists = [index.postings[t] for t in terms]
    bounds = [float(index.bound[t]) for t in terms]
    at = [0] * len(terms)
    order = list(range(len(terms)))
    found = []

    def current(k: int) -> int:
        return lists[k][0][at[k]]

    def advance(k: int, item: int) -> bool:
        at[k] = bisect_left(lists[k][0], item, at[k])
        return at[k] < len(lists[k][0])

    while order:
        order.sort(key=current)
        reach, pivot = 0.0, -1
        for place, k in enumerate(order):
            reach += bounds[k]
            if reach >= ENOUGH:
                pivot = place
                break
        if pivot < 0:
            break
        item = current(order[pivot])
        while pivot + 1 < len(order) and current(order[pivot + 1]) == item:
            pivot += 1
        block = item // ITEMS_A_BLOCK
        if sum(index.top(terms[k], block) for k in order[: pivot + 1]) < ENOUGH:
            # nothing up to the block's end, or to the next list's item, can reach the threshold
            onward = (block + 1) * ITEMS_A_BLOCK
            if pivot + 1 < len(order):
                onward = min(onward, current(order[pivot + 1]))
            order = [k for k in order if current(k) >= onward or advance(k, onward)]
        elif current(order[0]) == item:
            score = sum(lists[k][1][at[k]] for k in order[: pivot + 1])
            if score >= ENOUGH:
                found.append((item, score))
            order = [k for k in order if current(k) > item or advance(k, item + 1)]
        else:
            order = [k for k in order if current(k) >= item or advance(k, item)]
    return found


class _Terms(dict):
    """The term of a word in lower case, marks at its ends and all; -1: not in the index, -2: marks alone."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary, self.room = vocabulary, CACHED_WORDS

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(MARKS)
        term = self.vocabulary.get(plain, -1) if plain else -2
        if self.room:
            self.room -= 1
            self[word] = term
        return term


def leaks(index: Index, text: bytes | None, known: _Terms) -> list[tuple[int, float, float, float, float]]:
    """(place of the item, score, overlap, question's overlap, answer's overlap) of a whole text's items."""
    if not text or not index.items:
        return []
    blocks = [
        np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
        for words in word_blocks(text.lower())
    ]
    terms = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.int64)
    terms = terms[terms > -2]
    place = np.flatnonzero(terms >= 0)
    if not len(place):
        return []
    tile, width = place // index.tile, len(index.bound)
    # passage p holds the tiles p - 1 and p; a word counts once in a passage
    pairs = tile * width + terms[place]
    pairs = np.sort(np.concatenate((pairs, pairs + width)))
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    passage, term = np.divmod(pairs, width)
    best: dict[int, tuple] = {}
    for p, start, end in _promising(index, passage, term):
        for item, score in retrieve(index, term[start:end].tolist()):
            near = terms[max(0, (p - 2) * index.tile) : (p + 2) * index.tile].tolist()
            checked = _overlaps(index.items[item], near)
            if index.items[item].leaked(*checked):
                best[item] = max(best.get(item, (0.0, 0.0, 0.0, 0.0)), (checked[0], score, *checked[1:]))
    return [(item, score, whole, q, a) for item, (whole, score, q, a) in sorted(best.items())]


def _promising(index: Index, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The passages in which the block maxima of some block reach the threshold, with their terms' places.

    Blocks are added up for many passages at a time; only what may hold an item is searched.
    """
    starts = np.append(0, np.flatnonzero(passage[1:] != passage[:-1]) + 1)
    ends = np.append(starts[1:], len(passage))
    reach = np.add.reduceat(index.bound[term], starts)
    hopeful = np.flatnonzero(reach >= ENOUGH)
    held = np.diff(index.top_starts)
    blocks = -(-len(index.items) // ITEMS_A_BLOCK)
    entries = np.cumsum(np.add.reduceat(held[term], starts)[hopeful])
    first = 0
    while first < len(hopeful):
        before = entries[first - 1] if first else 0
        step = min(np.searchsorted(entries, before + AT_A_TIME) - first, AT_A_TIME // blocks)
        some = hopeful[first : first + max(1, int(step))]
        first += len(some)
        length = ends[some] - starts[some]
        terms = term[_ranges(starts[some], length)]
        at = _ranges(index.top_starts[terms], held[terms])
        cell = np.repeat(np.repeat(np.arange(len(some)), length), held[terms]) * blocks + index.top_blocks[at]
        sums = np.bincount(cell, weights=index.tops[at], minlength=len(some) * blocks).reshape(-1, blocks)
        for k in some[sums.max(axis=1) >= ENOUGH].tolist():
            yield int(passage[starts[k]]), int(starts[k]), int(ends[k])


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length."""
    offset = np.cumsum(lengths) - lengths
    return np.repeat(starts - offset, lengths) + np.arange(lengths.sum())


def _overlaps(item: Item, near: list[int]) -> tuple[float, float, float]:
    """The shares of the shingles of the item, its question and its answer that a passage holds.

    A part of fewer words than a shingle is one shingle; a part without words counts as held.
    """
    seen: dict[int, set[tuple[int, ...]]] = {}

    def share(start: int, end: int) -> float:
        wanted = item.shingles(start, end)
        size = min(SHINGLE, end - start)
        if size not in seen:
            seen[size] = set(zip(*(near[i:] for i in range(size)))) if size else set()
        return len(wanted & seen[size]) / len(wanted) if wanted else 1.0

    return share(0, len(item.words)), share(0, item.question), share(item.question, len(item.words))


def index_of(benchmark: DataFrame) -> Index:
    """The index of a benchmark table (item_id, text). Its size is checked in :func:`build_index`.

    Rows without a word are left out before rows are counted. What is left has a word each, so more
    rows than words are allowed are an error.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").rlike(A_WORD))
    rows = items.limit(MOST_ITEM_WORDS + 1).collect()
    if len(rows) > MOST_ITEM_WORDS:
        raise ValueError(f"the benchmark has more than {MOST_ITEM_WORDS} items; pass it in parts")
    return build_index((r.item_id, *question_and_answer(r.text)) for r in rows)


def contaminated(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap: what each text leaks.

    What a leak is says the module's head; the figures are those of the passage with the largest overlap. Null and
    empty texts leak nothing; rows with the same doc_id are looked at one by one.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        known = _Terms(index.vocabulary)
        for doc_id, text in rows:
            for item, *figures in leaks(index, text, known):
                yield doc_id, index.items[item].item_id, *(round(float(f), 6) for f in figures)

    schema = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    return map_rows(docs.select("doc_id", "text"), run, schema, binary=("text",))


def clean(docs: DataFrame, index: Index) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all columns; nothing is shuffled."""

    def make():
        known = _Terms(index.vocabulary)
        return lambda text: not leaks(index, text, known)

    return judged(docs, "text", make)
