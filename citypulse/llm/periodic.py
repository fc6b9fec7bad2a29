"""Periodic runs of words: a stretch that repeats its first few words several times over.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), at least
``max(least_length, least_exponent * q)`` long, that no neighbouring word extends keeping the period.

A suffix automaton takes a text's words one by one. Its suffix links are kept as a link-cut tree whose
preferred paths all have a colour: where their strings last ended. Each new word accesses its state; the
segments of the path to the root, from the deepest on, say which suffix last ended where. A suffix of
length L that last ended d words before, with d within L, is a square, and the L + d words up to
here have period d; the next words carry the stretch on until it is a whole run. As a suffix of three
periods or more cannot have occurred at a smaller distance without a smaller period, d is the smallest one.

The automaton is given only the parts of a text that can hold a run: behind a run's first period each word
stood at most a third of the rest's length before, so stretches of such words, and as much before them
as a period can take, are cut out. All runs are within these parts; what a cut shortens is not counted,
as the part that holds all of it finds it whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from citypulse.llm.common import map_rows

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class LastEnds:
    """Suffix automaton over whole numbers; ``append`` tells where the suffixes of the text so far ended last.

    State 0 is the empty string, -1 none. ``link`` is kept twice: as the automaton's suffix links, and as a
    link-cut tree of splay trees, one for each preferred path, keyed by depth. ``up`` is the parent in the
    splay tree, or from its root the path's parent. The colour stands at a splay tree's root.
    """

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]
        self.last, self.end = 0, -1

    def _state(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.length.append(length)
        for column in (self.link, self.left, self.right, self.up, self.colour):
            column.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        while (p := up[x]) >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == x):
                self._rotate(p)
            elif inner:
                self._rotate(x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child >= 0:
            up[child] = p
        up[p], up[x] = x, g
        if g >= 0 and left[g] == p:
            left[g] = x
        elif g >= 0 and right[g] == p:
            right[g] = x
        else:
            self.colour[x] = self.colour[p]

    def _above(self, clone: int, state: int) -> None:
        """Put a clone between a state and its parent, on the same preferred path: it ended last where that did."""
        self._splay(state)
        over = self.left[clone] = self.left[state]
        if over >= 0:
            self.up[over] = clone
        self.left[state], self.up[clone] = clone, state

    def _access(self, state: int) -> list[tuple[int, int]]:
        """Make the path to the root one of this end. (end, length) of the segments it had, the deepest first."""
        found = []
        below, x = state, self.up[state]
        while x >= 0:
            self._splay(x)
            if self.length[x]:
                found.append((self.colour[x], self.length[x]))
            if (cut := self.right[x]) >= 0:
                self.colour[cut] = self.colour[x]
            self.right[x], self.up[below] = below, x
            below, x = x, self.up[x]
        self.colour[below] = self.end
        return found

    def append(self, word: int) -> list[tuple[int, int]]:
        """(end, length), longest first: of the text's suffixes up to that length the last end before this one."""
        self.end += 1
        step, length, link = self.step, self.length, self.link
        new, p = self._state(self.end + 1, {}), self.last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = self._state(length[p] + 1, dict(step[q]))
                link[clone], link[q], link[new] = link[q], clone, clone
                self._above(clone, q)
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = clone
                    p = link[p]
        self.up[new] = link[new]
        self.last = new
        return self._access(new)


def stretches(words: list[int], least_length: int, least_exponent: int) -> list[tuple[int, int]]:
    """(first, end) of the parts that can hold a run, with room for its first period before."""
    seen: dict[int, int] = {}
    back = np.empty(len(words), dtype=np.int64)
    for i, word in enumerate(words):
        back[i] = i - seen.get(word, -len(words))
        seen[word] = i
    rest = least_exponent - 1
    # what a run has behind its first period, at least
    least = min(max(least_length - q, rest * q) for q in range(1, max(2, least_length)))
    active = back * rest <= len(words)
    while True:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], active, [0]))))
        starts, ends = edges[::2], edges[1::2]
        sizes = ends - starts
        long = sizes >= least
        holds = np.zeros(len(words), dtype=bool)
        for start, end, size in zip(starts[long], ends[long], sizes[long]):
            holds[start:end] = back[start:end] * rest <= size
        if (holds == active).all():
            return [(max(0, int(s) - int(e - s) // rest), int(e)) for s, e in zip(starts, ends)]
        active = holds


def runs(
    words: list[int], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start, then period.

    With ``least_exponent`` below 3 the last end of a suffix need not be one smallest period away, so it is refused.
    """
    if least_exponent < 3:
        raise ValueError("least_exponent must be 3 or more")
    found: set[tuple[int, int, int]] = set()
    for first, end in stretches(words, least_length, least_exponent):
        ends: dict[tuple[int, int], int] = {}
        automaton = LastEnds()
        for i in range(end - first):
            for last, length in automaton.append(words[first + i]):
                q = i - last
                if length >= (least_exponent - 1) * q:
                    ends[i + 1 - length - q, q] = i + 1
        for (start, q), stop in ends.items():
            start, stop = first + start, first + stop
            before = start > 0 and words[start - 1] == words[start - 1 + q]
            after = stop < len(words) and words[stop] == words[stop - q]
            if stop - start >= least_length and not before and not after:
                found.add((start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(words: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of so many words stay: all but those in a run behind its first period."""
    edges = np.zeros(words + 1, dtype=np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def numbered(words: Iterable[bytes]) -> list[int]:
    """Words as numbers, in the order of their first occurrence."""
    known: dict[bytes, int] = {}
    return [known.setdefault(w, len(known)) for w in words]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query's contract: in one of ten documents the rest from some word on becomes periodic.

    A null doc_id leaves the words as they are.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def periodic_runs(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """The runs of each text and digests of them and of the words that stay: a row for each row.

    Of the longest run (ties: smallest start, then period) start, length, period and exponent in
    thousandths; four nulls without a run. ``runs_sha256`` is of the lines start,length,period;
    ``collapsed_sha256`` of the words that stay, joined by a space. A null, empty or blank text has no words and no
    runs. Other columns are not read. ``change`` may give other words in the place of a text's own.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            words = (text or b"").split()
            words = change(doc_id, words) if change else words
            found = runs(numbered(words), least_length, least_exponent)
            best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            stay = [w for w, k in zip(words, kept(len(words), found)) if k] if found else words
            digests = ("".join(f"{s},{n},{q}\n" for s, n, q in found).encode(), b" ".join(stay))
            milli = 1000 * best[1] // best[2] if found else None
            yield doc_id, len(found), *best, milli, *(hashlib.sha256(d).hexdigest() for d in digests)

    return map_rows(docs.select("doc_id", "text"), run, SCHEMA, binary=("text",))


def collapsed(docs: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, text (the words that stay, joined by a space), n_words, n_dropped, runs: a row for each row.

    ``runs`` lists (start, length, period). A null text stays null, a text without runs as it is.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            words = (text or b"").split()
            found = runs(numbered(words), least_length, least_exponent)
            stay = [w for w, k in zip(words, kept(len(words), found)) if k] if found else words
            out = text if text is None or not found else b" ".join(stay)
            listed = [{"start": s, "length": n, "period": q} for s, n, q in found]
            yield doc_id, None if out is None else out.decode(), len(words), len(words) - len(stay), listed

    schema = (
        "doc_id long, text string, n_words long, n_dropped long, "
        "runs array<struct<start: long, length: long, period: long>>"
    )
    return map_rows(docs.select("doc_id", "text"), run, schema, binary=("text",))
