"""SimHash against brute force over every pair."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash

from citypulse.llm import simhash

from .conftest import DOCUMENTS, sentence


def slow_fingerprint(text: str | None, shingle: int = 3) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps: dict[int, int], radius: int = 3) -> dict[int, int]:
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in fps}


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b", "a b c", "Ä É x\x1cy z", "é\x85b c d e", "ab cd " * 50])
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = sentence(1, 5_000)
    whole = simhash.fingerprint(text.encode())
    plain = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda t: plain(t, 7))
    assert simhash.fingerprint(text.encode()) == whole == slow_fingerprint(text)


def test_masks_cover_every_difference_within_the_radius():
    masks = simhash.covering_masks(list(range(64)), 3)
    assert len(masks) == 15
    dice = random.Random(5)
    for size in (1, 2, 3):
        for _ in range(3_000):
            difference = sum(1 << b for b in dice.sample(range(64), size))
            assert any(not difference & m for m in masks)


def test_rows_equal_brute_force(spark, odd_docs, odd_rows):
    got = simhash.near_duplicates(odd_docs).collect()
    fps = {r[0]: slow_fingerprint(r[1]) for r in odd_rows if r[0] is not None}
    want = slow_components(fps)
    assert len(got) == len(odd_rows)
    assert {r.doc_id: r.fingerprint for r in got if r.doc_id is not None} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want


def test_chains_and_crowded_entries_lose_no_link(spark):
    dice = random.Random(7)
    fps = {}
    for _ in range(4):
        centre = dice.getrandbits(64)
        low = dice.sample(range(64), 14)
        for _ in range(150):  # many fingerprints that agree in 50 bits
            fps[len(fps)] = centre ^ sum(1 << b for b in dice.sample(low, dice.randint(0, 5)))
        for _ in range(20):  # a chain
            centre ^= sum(1 << b for b in dice.sample(range(64), 3))
            fps[len(fps)] = centre
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps.values()})
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {tuple(r) for r in simhash.links(frame, crowded=8).collect()}
    unsigned = [f % (1 << 64) for f in signed]
    want = {
        (signed[i], signed[j])
        for i, j in combinations(range(len(signed)), 2)
        if (unsigned[i] ^ unsigned[j]).bit_count() <= 3
    }
    assert got == want
    parts = {r.node: r.root for r in simhash.components(spark.createDataFrame(sorted(got), "a long, b long")).collect()}
    slow = slow_components({s: u for s, u in zip(signed, unsigned)})
    linked = {x for pair in want for x in pair}
    assert parts == {k: v for k, v in slow.items() if k in linked}


def test_one_of_each_keeps_all_columns_and_rows_without_id(spark, odd_docs, odd_rows):
    kept = simhash.one_of_each(odd_docs)
    assert set(kept.columns) == set(odd_docs.columns)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2
    groups = slow_components({r[0]: slow_fingerprint(r[1]) for r in odd_rows if r[0] is not None})
    assert {i for i in ids if i is not None} == set(groups.values())


def test_empty_table(spark, no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []


def test_copies_fall_together(spark):
    text = sentence(9, 200)
    rows = [(i, text, "en", "s", 1) for i in (5, 3, 8)] + [(1, sentence(10, 200), "en", "s", 1)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got == {5: 3, 3: 3, 8: 3, 1: 1}
