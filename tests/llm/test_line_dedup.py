"""Repeated runs of lines against brute force."""

from __future__ import annotations

import random

import xxhash

from citypulse.llm import line_dedup as L

from .conftest import DOCUMENTS, sentence


def tie(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def slow(rows: list[tuple], least: int) -> dict[tuple, str]:
    """Every run of lines of the size is looked up among all that stood before."""
    texts = sorted({(r[0] is not None, r[0] or 0, tie(r[1]), r[1]) for r in rows if r[1] is not None})
    seen: dict[tuple, tuple] = {}
    out = {}
    for given, doc_id, _, text in texts:
        lines = text.split("\n")
        kept = [(i, x.strip(L.BLANK)) for i, x in enumerate(lines) if x.strip(L.BLANK)]
        gone = set()
        runs = []
        for a in range(len(kept)):
            size = 0
            for b in range(a, min(len(kept), a + 25)):
                size += len(kept[b][1])
                if size >= least:
                    runs.append((a, b, tuple(x for _, x in kept[a : b + 1])))
        for a, b, run in runs:
            first = seen.setdefault(run, (given, doc_id, text, a))
            if first != (given, doc_id, text, a):
                after = kept[b + 1][0] if b + 1 < len(kept) else len(lines)
                gone.update(range(kept[a][0], after))
        out[doc_id if given else None, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def held(spark, rows: list[tuple], least: int) -> None:
    got = L.deduplicated(spark.createDataFrame(rows, DOCUMENTS).repartition(5), least).collect()
    assert len(got) == len(rows)
    want = slow(rows, least)
    originals = {}
    for doc_id, text, *_ in rows:
        originals.setdefault(doc_id, []).append(text)
    left = sorted(repr((r.doc_id, r.text)) for r in got)
    assert left == sorted(repr((d, None if t is None else want[d, t])) for d, ts in originals.items() for t in ts)


def test_equals_brute_force(spark):
    dice = random.Random(11)
    pool = [sentence(i, dice.randint(1, 14)) for i in range(40)]
    rows = []
    for i in range(120):
        lines = [dice.choice(pool) if dice.random() < 0.6 else sentence(1_000 + 50 * i + j, 6) for j in range(dice.randint(0, 12))]
        if i % 4 == 0:  # a passage that many texts share
            lines[3:3] = pool[5:9]
        if i % 9 == 0:
            lines += ["", "  \t", pool[0]]
        rows.append((i, "\n".join(lines), "en", "s", 1))
    for least in (30, 60, 120):
        held(spark, rows, least)


def test_one_long_line_and_many_short_ones(spark):
    passage = sentence(1, 60)
    short = "\n".join(sentence(50 + i, 3) for i in range(20))
    rows = [
        (1, f"a\n{passage}\nb", "en", "s", 1),
        (2, f"c\n  {passage}\t\nd", "en", "s", 1),
        (3, f"e\n{short}\nf", "en", "s", 1),
        (4, f"g\n{short}\nh", "en", "s", 1),
    ]
    got = {r.doc_id: (r.text, r.removed_lines) for r in L.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("c\nd", 1), 3: (rows[2][1], 0), 4: ("g\nh", 20)}


def test_a_run_within_the_same_text(spark):
    passage = sentence(2, 70)
    rows = [(1, f"{passage}\nx\n{passage}", "en", "s", 1)]
    assert [r.text for r in L.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()] == [f"{passage}\nx"]


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    out = L.deduplicated(odd_docs)
    assert out.columns == [*odd_docs.columns, "removed_lines"]
    held(spark, odd_rows, 150)
    assert L.deduplicated(no_docs).collect() == []


def test_no_python_in_the_plan(odd_docs):
    plan = L.deduplicated(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
