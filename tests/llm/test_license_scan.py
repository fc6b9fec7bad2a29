"""Licences found by fingerprints and alignment."""

from __future__ import annotations

import random

import pytest

from citypulse.llm import license_scan as L

from .conftest import DOCUMENTS, sentence

INDEX = L.build_index(L.TEMPLATES, naming=L.NAMING)


def found(text: str) -> list[tuple]:
    return L.licences(INDEX, text.encode(), L._Words(INDEX.vocabulary))


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
def test_every_template_is_found_whole(name):
    text = "Ein Text é. " + L.TEMPLATES[name] + " \n Und mehr."
    (hit,) = [f for f in found(text) if f[0] == name]
    assert hit[1] == 1.0
    assert text[hit[3] : hit[4]] == L.TEMPLATES[name]


def test_changed_words_lower_the_coverage():
    words = L.TEMPLATES["mit"].split()
    size = len(words)
    words[20] = "other"
    del words[70:73]
    words.insert(50, "put between")
    text = sentence(1, 50) + " " + " ".join(words) + " " + sentence(2, 50)
    (hit,) = found(text)
    assert hit[0] == "mit" and hit[1] == round((size - 4) / size, 6) and hit[2] == size - 4
    assert text[hit[3] : hit[4]] == " ".join(words)


def slow_lcs(a: tuple, b: list) -> int:
    before = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for i, y in enumerate(b):
            now.append(before[i] + 1 if x == y else max(before[i + 1], now[i]))
        before = now
    return before[-1]


def test_alignment_equals_the_full_one_within_the_band():
    template = tuple(range(40))
    for skip in range(1, 6):
        text = [99] * 3 + list(template[:10]) + list(template[10 + skip :]) + [98] * 4
        matched, first, last = L.aligned(template, text, 3)
        assert matched == slow_lcs(template, text) == 40 - skip
        assert (first, last) == (3, 3 + 39 - skip)


def test_a_third_of_a_template_is_no_licence():
    words = L.TEMPLATES["gpl-notice"].split()
    assert found(" ".join(words[: len(words) // 3])) == []


def test_notices_that_share_words():
    assert [f[0] for f in found("Licensed under CC BY-NC 4.0.")] == ["cc-by-nc-4.0-notice"]
    assert [f[0] for f in found("Licensed under CC BY 4.0.")] == ["cc-by-4.0-notice"]


def test_repetitions_are_found_each():
    text = "\n".join([L.TEMPLATES["mit-notice"], sentence(3, 30)] * 50)
    assert len(found(text)) == 50


def test_rows(spark, odd_docs, no_docs):
    assert L.scan(odd_docs).collect() == []
    assert L.scan(no_docs).collect() == []
    rows = [(1, "x\n" + L.TEMPLATES["mit-notice"], "en", "s", 1)] * 2 + [(2, None, "en", "s", 1)]
    got = [tuple(r) for r in L.scan(spark.createDataFrame(rows, DOCUMENTS)).collect()]
    assert got == [(1, "mit-notice", 1.0, 5, 2, 33)] * 2


def test_short_and_oversized_templates_are_refused(monkeypatch):
    with pytest.raises(ValueError, match="3 words"):
        L.build_index({"a": "two words"})
    monkeypatch.setattr(L, "MOST_TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError, match="in parts"):
        L.build_index({"a": "four words are here"})


SHORT = sorted(n for n, t in L.TEMPLATES.items() if len(t.split()) <= 12)


def enough(name: str, row: tuple, numbers: list, shift: int) -> bool:
    base = max(0, shift - L.BAND)
    matched, first, last = L.aligned(row, numbers[base:], shift - base)
    if matched < L.COVERAGE * len(row) - 1e-9:
        return False
    span = " " + " ".join(str(n) for n in numbers[base + first : base + last + 1]) + " "
    numbered = (" ".join(str(INDEX.vocabulary[L._bare(w)]) for w in p.encode().split()) for p in L.NAMING.get(name, ()))
    return all(f" {p} " in span for p in numbered)


def everywhere(text: str) -> set[str]:
    """The templates that alignment finds when it is tried at every place, without fingerprints."""
    words = L._Words(INDEX.vocabulary)
    numbers = [words[w] for w in text.lower().encode().split()]
    return {
        name
        for name, row in zip(INDEX.names, INDEX.words)
        if name in SHORT
        and any(
            enough(name, row, numbers, s)
            for s in range(-L.BAND - len(row), len(numbers) + L.BAND)
        )
    }


def variants(words: list[str]):
    for i in range(len(words)):
        once = [words[:i] + ["xx"] + words[i + 1 :], words[:i] + words[i + 1 :], words[:i] + ["xx"] + words[i:]]
        yield from once
        for j in range(i + 1, len(words)):
            yield once[0][:j] + ["yy"] + words[j + 1 :]
            yield once[0][:j] + ["yy"] + words[j:]
            yield words[:i] + words[i + 1 : j] + words[j + 1 :]


@pytest.mark.parametrize("name", SHORT)
def test_short_notices_with_changed_words_are_found_as_by_alignment_at_every_place(name):
    for words in variants(L.TEMPLATES[name].split()):
        text = " ".join(["before", "it", *words, "and", "after"])
        wanted, got = everywhere(text), {f[0] for f in found(text)}
        assert got <= wanted, text
        # a better one may take the place of one that it overlaps
        assert (name in wanted) == (name in got) or got, text
        assert bool(got) == bool(wanted), text


@pytest.mark.parametrize(
    "text, name, share",
    [
        ("Distributed under the MIT License.", "mit-notice", 0.8),
        ("Released under the BSD License.", "bsd-notice", 1.0),
        ("It is licensed under the GNU Lesser General Public License version 3.", "lgpl-work", 0.846154),
        ("This is licensed under the GNU Affero General Public License version 3.", "agpl-work", 0.923077),
        ("Released by us under our MIT own License.", "mit-notice", 0.8),
        ("Licensed under Apache License, Version 2.0", "apache-2.0-notice", 0.857143),
        ("Licensed with CC BY 4.0.", "cc-by-4.0-notice", 0.8),
    ],
)
def test_short_notices_with_changed_words(text, name, share):
    assert [(f[0], f[1]) for f in found(f"So: {text} End")] == [(name, share)]


def bare(word: str) -> str:
    return word.lower().strip(L.MARKS.decode())


def naming_words(name: str) -> set[str]:
    return {bare(w) for p in L.NAMING.get(name, ()) for w in p.split()}


@pytest.mark.parametrize("phase", range(5))
def test_long_templates_with_every_fifth_word_changed(phase):
    """But for those that name the licence: without them it is not that licence."""
    for name in ("mit", "gpl-notice", "isc", "unlicense"):
        words = [
            "xx" if i % 5 == phase and bare(w) not in naming_words(name) else w
            for i, w in enumerate(L.TEMPLATES[name].split())
        ]
        wanted = words.count("xx") <= len(words) - INDEX.needed[INDEX.names.index(name)]
        hits = [f[0] for f in found(sentence(1, 50) + " " + " ".join(words) + " " + sentence(2, 50))]
        assert (name in hits) == wanted


def test_an_edited_notice_beside_a_whole_one():
    text = "Distributed under the MIT License. Released under the MIT License. Released under our MIT License."
    assert [f[1] for f in found(text)] == [0.8, 1.0, 0.8]


@pytest.mark.parametrize(
    "text",
    ["Released under the Foo License.", "This work is licensed under the GNU General Public License, version 2.",
     "Licensed under CC BY 3.0.", "Licensed under the Apache License, Version 1.1."],
)
def test_other_names_are_no_match(text):
    assert found(f"So: {text} End") == []


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
def test_winnowing_selects_more_words_than_may_be_lacking(name):
    at = INDEX.names.index(name)
    words, window = L._bare_words(L.TEMPLATES[name]), INDEX.windows[at]
    places = sorted(p for hits in INDEX.postings.values() for t, p in hits if t == at)
    assert len(places) > len(words) - INDEX.needed[at]
    # the promise of winnowing: every run as long as the window holds a selected word
    assert all(any(s <= p < s + window for p in places) for s in range(len(words) - window + 1))
    # and no wider window would do
    assert window == len(words) or len(L.minima(words, window + 1)) <= len(words) - INDEX.needed[at]


@pytest.mark.parametrize("name", sorted(n for n, t in L.TEMPLATES.items() if len(t.split()) > 12))
def test_long_templates_with_words_changed_at_random(name):
    """As many words changed, left out or put between as the coverage allows: found, with the coverage that is left."""
    dice = random.Random(name)
    at = INDEX.names.index(name)
    words = L.TEMPLATES[name].split()
    free = [i for i, w in enumerate(words) if bare(w) not in naming_words(name)]
    for _ in range(12):
        lost = min(len(INDEX.words[at]) - INDEX.needed[at], len(free))
        gone = set(dice.sample(free, lost))
        out, put = [], 0
        for i, word in enumerate(words):
            if i in gone:
                out += ["xx"] if dice.random() < 0.7 else []
            else:
                out.append(word)
                # few enough not to leave the band
                if put < 4 and bare(word) not in naming_words(name) and dice.random() < 0.05:
                    out.append("yy")
                    put += 1
        hits = found(sentence(1, 40) + " " + " ".join(out) + " " + sentence(2, 40))
        assert any(h[0] == name and h[2] >= INDEX.needed[at] for h in hits) or any(
            h[1] >= INDEX.needed[at] / len(INDEX.words[at]) and h[2] >= INDEX.needed[at] for h in hits
        ), out


@pytest.mark.parametrize("count", [17, 25, 30])
def test_words_put_into_or_left_out_of_a_long_template(count):
    words = L.TEMPLATES["mit"].split()
    put = words[:60] + ["xx"] * count + words[60:]
    (hit,) = found(sentence(1, 50) + " " + " ".join(put) + " " + sentence(2, 50))
    assert hit[:3] == ("mit", 1.0, len(words))
    if len(words) - count >= INDEX.needed[INDEX.names.index("mit")]:
        (hit,) = found(sentence(1, 50) + " " + " ".join(words[:50] + words[50 + count :]) + " " + sentence(2, 50))
        assert hit[0] == "mit" and hit[2] == len(words) - count


def test_two_and_three_clauses():
    for name in ("bsd-2-clause", "bsd-3-clause"):
        assert [f[0] for f in found(L.TEMPLATES[name]) if f[0].endswith("clause")] == [name]
        assert not [f for f in found(L.TEMPLATES[name]) if f[0].startswith(("mit", "gpl"))]
    for name in ("lgpl-notice", "agpl-notice", "lgpl-work", "agpl-work"):
        assert [f[0] for f in found(L.TEMPLATES[name])] == [name]


def test_names_must_be_in_their_template():
    with pytest.raises(ValueError, match="naming words"):
        L.build_index({"a": "one two three four"}, naming={"a": ("two four",)})
