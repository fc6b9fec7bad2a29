"""Frequent lines against counts of whole texts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from citypulse.llm import line_frequency

from .conftest import DOCUMENTS, sentence

SPACE = "[\x20\x09-\x0d]+"


def words(text: str | None) -> list[str]:
    return [w for w in re.split(SPACE, text or "") if w]


def normal(line: str) -> str:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return re.sub("[0-9]+", "0", " ".join(words(lower)))


def slow(rows: list[tuple], most_docs=6, share=0.001, least_words=20, least_share=0.2) -> tuple[list[tuple], dict]:
    held: dict = {}
    texts: dict = {}
    for _, text, _, host, *_ in rows:
        for line in (text or "").split("\n"):
            if words(line):
                held.setdefault((host, normal(line)), set()).add(text)
                texts.setdefault(host, set()).add(text)
    out, left_text = [], {}
    for doc_id, text, _, host, *_ in rows:
        w, lines = words(text), (text or "").split("\n")
        seen = [x for x in lines if words(x)]
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        twice = {x for x in set(windows) if windows.count(x) > 1} if len(windows) < 3_000 else set()
        covered = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 8)}
        gone = [
            x for x in seen
            if len(held[host, normal(x)]) > most_docs and len(held[host, normal(x)]) > share * len(texts[host])
        ]
        left = len(w) - sum(len(words(x)) for x in gone)
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        kept = not failed and left >= least_words and left >= least_share * len(w)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        out.append((
            doc_id, len(w), sum(map(len, w)), symbols, len(seen) - len(set(seen)), len(covered), failed, kept, len(gone), left,
        ))
        if kept:
            left_text[doc_id] = text if not gone else "\n".join(x for x in lines if x not in gone)
    return out, left_text


def corpus() -> list[tuple]:
    """Hosts with menus, footers with numbers, copies of one text, depleted documents."""
    rows = []
    for i in range(40):
        host = "a" if i % 4 else "b"
        body = f"{sentence(i, 60)}\n\n  {sentence(1_000 + i, 25)} "
        rows.append((i, f"Home | News\n{body}\nPage {i} of  40\tgo ON", "en", host, 1))
    menu = "\n".join(f"entry {sentence(5_000 + k, 9)}" for k in range(12))
    rows += [(100 + i, f"{menu}\n{sentence(200 + i, 12 + 2 * i)}", "en", "a", 1) for i in range(12)]
    rows += [(200 + i, f"{sentence(300, 50)}\n{sentence(301, 30)}", "en", "b", 1) for i in range(15)]  # one text
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (302, " \n\t", "en", "a", 0)]
    rows += [(310 + i, f"no host here\n{sentence(400 + i, 30)}", "en", None, 1) for i in range(8)]
    rows += [(330, (sentence(9, 12) + "\n") * 4 + "#|x<", "en", "c", 1), (None, sentence(11, 30), "en", "a", 1)]
    return rows + [rows[3], rows[60]]


@pytest.mark.parametrize("limits", [{}, {"most_docs": 3, "share": 0.5}, {"least_words": 40, "least_share": 0.8}])
def test_verdicts_equal_counts_of_whole_texts(spark, limits):
    docs = spark.createDataFrame(corpus(), DOCUMENTS).repartition(3)
    got = sorted(map(repr, map(tuple, line_frequency.verdicts(docs, **limits).collect())))
    want = slow(corpus(), **limits)[0]
    assert got == sorted(map(repr, want))
    assert any(r[8] for r in want) and any(not r[6] and not r[7] for r in want) or limits


def test_copies_of_a_text_do_not_condemn_each_other(spark):
    got = line_frequency.verdicts(spark.createDataFrame(corpus(), DOCUMENTS)).where("doc_id between 200 and 214")
    assert [tuple(r) for r in got.select("kept", "n_removed_lines").collect()] == [(True, 0)] * 16


def test_cleaned_texts(spark):
    rows = corpus()
    got = line_frequency.cleaned(spark.createDataFrame(rows, DOCUMENTS))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts == slow(rows)[1] and "Home" not in texts[1] and "\n\n" in texts[1]


def test_odd_rows_keep_their_further_columns(spark, odd_docs, odd_rows, no_docs):
    got = line_frequency.cleaned(odd_docs)
    assert got.schema == odd_docs.schema
    rows = got.collect()
    assert rows and all(r.grade == 7 and odd_rows[r["size"]][1] == r.text for r in rows)
    short = odd_docs.where("text is null or length(text) < 20000")
    want = [r for r in slow(odd_rows)[0] if r[1] < 3_000]
    assert sorted(repr(tuple(r)) for r in line_frequency.verdicts(short).collect()) == sorted(map(repr, want))
    assert line_frequency.verdicts(no_docs).collect() == line_frequency.cleaned(no_docs).collect() == []


def test_long_texts(spark):
    text = "a b c d e f g h " * 20_000 + "\n" + "\n".join(f"line {i} x{i}" for i in range(50_000))
    row = line_frequency.verdicts(spark.createDataFrame([(1, text, "en", "s", 1)], DOCUMENTS)).first()
    assert (row.n_words, row.n_repeat_words, row.n_dup_lines, row.n_left) == (310_000, 160_000, 0, 310_000)


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame(corpus(), DOCUMENTS)
    for df in (line_frequency.verdicts(docs), line_frequency.cleaned(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_windows_at_a_texts_ends(spark):
    texts = ["a b c d e f g h", "a a a a a a a a", "a a a a a a a a a", "a b c d e f g h x a b c d e f g h"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(line_frequency.repeated_words(line_frequency.words_of(F.col("text")))).collect()]
    assert found == [0, 0, 9, 16]
