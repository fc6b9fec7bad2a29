"""Periodic runs against a search over all periods and places."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from citypulse.llm import periodic

from .conftest import DOCUMENTS, sentence


def slow_runs(words: list, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    found = []
    for q in range(1, len(words) // least_exponent + 1):
        i = q
        while i < len(words):
            start = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            length = i - start + q
            if length >= max(least_length, least_exponent * q):
                stretch = words[start - q : i]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((start - q, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random) -> list[int]:
    words = [rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randrange(70))]
    for _ in range(rng.randrange(4) if words else 0):
        a = rng.randrange(len(words))
        p, end = rng.randint(1, max(1, (len(words) - a) // 2)), rng.randint(a, len(words))
        for i in range(a, end):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least_length, least_exponent", [(6, 4), (1, 3), (12, 3), (30, 5), (2, 4)])
def test_runs_equal_those_of_a_search_over_all_periods(least_length, least_exponent):
    rng, total = random.Random(least_length), 0
    for _ in range(1_500):
        words = some_words(rng)
        want = slow_runs(words, least_length, least_exponent)
        assert periodic.runs(words, least_length, least_exponent) == want, words
        total += len(want)
    assert total > 30


def test_runs_that_overlap_or_touch_are_all_found():
    words = [*"abababab", *"babcbabcbabcbabc", *"ccccccc", *"dd"]
    assert periodic.runs(words) == slow_runs(words) and len(slow_runs(words)) >= 3


def test_last_ends_of_all_suffixes():
    rng = random.Random(5)
    for _ in range(200):
        words, automaton = [rng.randrange(3) for _ in range(40)], periodic.LastEnds()
        for i, word in enumerate(words):
            told = automaton.append(word)
            for length in range(1, i + 1):
                ends = [e for e in range(i) if e + 1 >= length and words[e + 1 - length : e + 1] == words[i + 1 - length : i + 1]]
                deep = [end for end, most in told if most >= length]
                assert (max(ends) if ends else None) == (deep[-1] if deep else None)


def test_long_runs_take_time_in_proportion():
    for period in (1, 3, 500):
        words = list(range(period)) * (60_000 // period)
        assert periodic.runs(words) == [(0, len(words), period)]


def test_least_exponent_below_three_is_refused():
    with pytest.raises(ValueError):
        periodic.runs([1] * 10, 6, 2)


def slow_row(doc_id, text) -> tuple:
    words = (text or "").encode().split()
    if doc_id is not None and words and zlib.crc32(b"%d" % doc_id) % 10 == 0:
        g, n = zlib.crc32(b"%d" % doc_id) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    first = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_query_over_odd_rows(spark, odd_docs, odd_rows):
    got = periodic.periodic_runs(odd_docs.where("text is null or length(text) < 9000"), change=periodic.planted)
    assert got.columns == periodic.SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    want = [slow_row(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 9000]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert any(r.n_runs for r in got.collect())


def test_collapsed_texts(spark, no_docs):
    rows = [(1, "x " + "go on " * 5 + "home", None, None, None), (2, None, None, None, None), (3, " a\n b ", None, None, None)]
    got = {r.doc_id: r for r in periodic.collapsed(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got[1].text == "x go on home" and got[1].n_dropped == 8 and tuple(got[1].runs[0]) == (1, 10, 2)
    assert got[2].text is None and got[3].text == " a\n b " and got[3].runs == []
    assert periodic.collapsed(no_docs).collect() == periodic.periodic_runs(no_docs).collect() == []


def test_one_long_text_and_the_longest_run_by_ties(spark):
    long = sentence(3, 30_000) + " " + "so it goes " * 3_000
    rows = [(11, long, None, None, None), (12, "a " * 8 + "b " + "c " * 8, None, None, None)]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert (got[11].start, got[11].length, got[11].period) == (30_000, 9_000, 3)
    assert (got[12].n_runs, got[12].start, got[12].exponent_milli) == (2, 0, 8_000)
