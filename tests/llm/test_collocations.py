"""Phrases against counts of whole texts."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from citypulse.llm import collocations

from .conftest import DOCUMENTS, sentence


def slow(rows: list[tuple], least: int = 10, top: int = 2_000, within: int = 50) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for _, text, lang, *_ in rows:
        held = counts.setdefault(lang or "und", Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            held.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for w, v in f.items() if len(w) == 1)
        found = []
        for w, a in f.items():
            if len(w) < 2 or a < least:
                continue
            value, _, left, right = min((10**6 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            longer = [v for x, v in f.items() if len(w) == 2 and len(x) == 3 and v >= least and w in (x[:2], x[1:])]
            if not any(100 * v >= within * a for v in longer):
                found.append((value, a, " ".join(w), left, right))
        ranked = sorted(found, key=lambda r: (-r[0], -r[1], r[2].encode()))[:top]
        out += [(lang, i, p, a, left, right, n, v) for i, (v, a, p, left, right) in enumerate(ranked, 1)]
    return sorted(out)


def corpus() -> list[tuple]:
    rows = [(i, sentence(i, 80) + (". New York City, new york" if i % 3 else "\tnew   york!"), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, "the the the the the " * 4, "de" if i % 2 else None, "s", 1) for i in range(7)]
    rows += [(200, None, "en", "s", 1), (201, "", None, None, None), (202, " ,.\n;", "fr", "s", 1)]
    rows += [(300 + i, "ÄÖ straße 漢字 ÄÖ straße 漢字\x0bx\x1cy x\x1cy", "de", "s", 1) for i in range(12)]
    return rows + rows[:20]


def test_phrases_equal_counts_of_whole_texts(spark):
    docs = spark.createDataFrame(corpus(), DOCUMENTS).repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == slow(corpus()) and len(got) > 20


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_small_tries_small_tables_of_bits_and_few_words_change_nothing(spark, monkeypatch, bits):
    """Containers burst, subtrees leave, ids begin anew, most pairs share a bit: the same phrases."""
    monkeypatch.setattr(collocations, "BLOCK", 500)
    docs = spark.createDataFrame(corpus(), DOCUMENTS).repartition(2)
    got = collocations.collocations(docs, least=4, top=15, within=80, burst=8, entries=200, vocabulary=60, bits=bits)
    assert sorted(map(tuple, got.collect())) == slow(corpus(), 4, 15, 80)


def test_runs_are_sorted_and_add_up(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 300)
    texts = [sentence(i, 400) for i in range(10)]
    batch = pa.record_batch({"lang": ["en"] * 10, "text": texts})
    batches = list(collocations.counted(iter([batch]), collocations.pairs_of, 16, 400, 10_000))
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    want = Counter(("en", w, None) for t in texts for w in t.split())
    want.update(("en", *p) for t in texts for p in zip(t.split(), t.split()[1:]))
    got = Counter()
    for lang, first, second, third, n in rows:
        assert third is None
        got[lang, first, second] += n
    assert got == want and len(rows) > len(want)
    for b in batches:
        keys = [(r["first"], r["second"] or "") for r in b.to_pylist()]
        assert keys == sorted(keys)


def test_a_table_of_bits_knows_every_frequent_pair(spark):
    pairs = [("en", f"a{i}", f"b{i % 7}") for i in range(500)]
    table = collocations.bits_of(spark.createDataFrame(pairs, "lang string, first string, second string").repartition(4), 1 << 12)
    left, right = (np.array([collocations.word_hash(p[k].encode()) for p in pairs], dtype=np.uint64) for k in (1, 2))
    place = collocations.pair_places(left, right, "en", 1 << 12)
    assert len(table) == 64 and ((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).all()


def test_scores_beyond_64_bits_are_exact(spark):
    big = [(987_654_321_012, 987_654_321_013, 999_999_999_999), (10**12, 10**12, 10**12), (10, 10**14, 3 * 10**13)]
    found = spark.createDataFrame(big, "a long, l long, r long").select(
        collocations.score(*(collocations.F.col(c) for c in "alr")).alias("s")
    )
    assert [r.s for r in found.collect()] == [10**6 * a * a // (left * right) for a, left, right in big]


def test_a_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 50)
    rows = [(1, sentence(5, 3_000), "en", "s", 1), (2, "x" * 300 + " y. " + "z z " * 40, "en", "s", 1)]
    batch = pa.record_batch({"lang": ["en"] * 2, "text": [r[1] for r in rows]})
    got = Counter()
    for b in collocations.counted(iter([batch]), collocations.pairs_of, 64, 1_000, 1_000):
        for r in b.to_pylist():
            got[r["first"], r["second"]] += r["n"]
    words = [r[1].replace(".", " .").split() for r in rows]
    want = Counter((a, b) for w in words for a, b in zip(w, w[1:]) if "." not in (a, b))
    assert Counter({k: n for k, n in got.items() if k[1]}) == want


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    got = sorted(map(tuple, collocations.collocations(odd_docs).collect()))
    assert got == slow(odd_rows) and {r[0] for r in got} >= {"en", "und"} - {"und"}
    assert collocations.collocations(no_docs).collect() == []


def test_candidates_of_a_language_are_ranked_in_parts_first(spark):
    """No one task sees all candidates of a language."""
    docs = spark.createDataFrame(corpus(), DOCUMENTS)
    plan = collocations.collocations(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") >= 2
