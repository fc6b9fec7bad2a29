"""Benchmark items in texts: retrieval and overlap against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from citypulse.llm import decontaminate as D

from .conftest import DOCUMENTS, sentence

ITEMS = [(i, sentence(500 + i, 12 + i % 9) + f" mark{i}.", sentence(900 + i, 6) + f" end{i}") for i in range(40)]
INDEX = D.build_index(ITEMS)


def leaks(text: str, index: D.Index = INDEX) -> list[int]:
    return [index.items[i].item_id for i, *_ in D.leaks(index, text.encode(), D._Terms(index.vocabulary))]


def slow_leaks(text: str, index: D.Index = INDEX) -> list[int]:
    known = D._Terms(index.vocabulary)
    terms = [t for t in (known[w] for w in text.lower().encode().split()) if t > -2]

    def held(words: list[int]) -> float:
        size = min(5, len(words))
        wanted = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
        seen = {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)}
        return len(wanted & seen) / len(wanted) if wanted else 1.0

    out = []
    for item in index.items:
        question, answer = item.words[: item.question], item.words[item.question :]
        both = all(len(part) < 5 or held(part) > 0 for part in (question, answer))
        if held(item.words) >= 0.8 and (both or held(question) >= 0.8):
            out.append(item.item_id)
    return out


def test_retrieval_equals_scoring_everything():
    dice = random.Random(2)
    width = len(INDEX.vocabulary)
    for _ in range(400):
        item = dice.choice(INDEX.items)
        terms = sorted(set(dice.sample(item.words, dice.randint(1, len(item.words)))) | set(dice.sample(range(width), 25)))
        score = defaultdict(float)
        for t in terms:
            for place, value in zip(*INDEX.postings[t]):
                score[place] += value
        assert {p for p, _ in D.retrieve(INDEX, terms)} == {p for p, s in score.items() if s >= D.ENOUGH}


@pytest.mark.parametrize("before", [0, 1, 17, 40, 1_000])
def test_an_item_is_found_wherever_it_starts(before):
    _, question, answer = ITEMS[7]
    assert leaks(f"{sentence(1, before)}\n{question.upper()}\n{answer}** {sentence(2, 90)}") == [7]


def test_texts_equal_brute_force():
    dice = random.Random(3)
    for n in range(150):
        _, question, answer = dice.choice(ITEMS)
        words = f"{question} {answer}".split()
        for _ in range(dice.randint(0, 4)):  # some changes
            place = dice.randrange(len(words))
            dice.choice([lambda: words.__setitem__(place, "other"), lambda: words.insert(place, "more"), lambda: words.pop(place)])()
        text = f"{sentence(n, dice.randint(0, 200))} {' '.join(words)} {sentence(n + 1, dice.randint(0, 200))}"
        assert leaks(text) == slow_leaks(text), text


LONG = [(1, "one question of seven plain words here?", sentence(70, 60)), (2, "short one?", sentence(71, 30)), (3, sentence(72, 30), "yes"), (4, sentence(73, 40), sentence(74, 6))]


def test_question_and_answer_decide():
    index = D.build_index(ITEMS + [(100 + i, q, a) for i, q, a in LONG])
    (_, seven, told), (_, short, answer), (_, asked, yes), (_, most, rest) = LONG
    cases = [
        (seven, []),  # a question alone, a tenth of its item
        (most, [104]),  # a question alone, most of its item
        (rest, []),
        (told, []),  # its answer alone, nine tenths of it
        (f"{seven[:-12]} {told}", [101]),  # four of its words are no shingle, five are some of the question
        (f"{seven.split(' ', 3)[3]} {told}", []),
        (f"{short} {answer}", [102]),
        (answer, [102]),  # too short a question to be missed
        (short, []),
        (f"{asked} no", [103]),
        (yes, []),
        (f"{' '.join(asked.split()[:24])} {yes}", []),
        (f"{' '.join(asked.split()[:26])}", [103]),
    ]
    for text, want in cases:
        whole = f"{sentence(5, 33)} {text} {sentence(6, 50)}"
        assert slow_leaks(whole, index) == want and leaks(whole, index) == want, (text, want)


def test_parts_of_items_equal_brute_force():
    """A share of the question, a share of the answer, changed or not."""
    index = D.build_index(ITEMS + [(100 + i, q, a) for i, q, a in LONG])
    dice, found = random.Random(4), 0
    for n in range(300):
        place = dice.randrange(len(ITEMS) + len(LONG))
        _, question, answer = (ITEMS + LONG)[place]
        parts = [w.split() for w in (question, answer)]
        kept = [p[: round(len(p) * dice.choice([0, 0.3, 0.8, 0.9, 1, 1]))] for p in parts]
        words = kept[0] + kept[1]
        if words and dice.random() < 0.5:
            words[dice.randrange(len(words))] = "other"
        text = f"{sentence(n, dice.randint(0, 90))} {' '.join(words)} {sentence(n + 1, dice.randint(0, 90))}"
        assert leaks(text, index) == slow_leaks(text, index), text
        found += bool(leaks(text, index))
    assert 50 < found < 250


def test_question_and_answer():
    assert D.question_and_answer("A b? C d. E f.") == ("A b? C d.", "E f.")
    assert D.question_and_answer("only one") == ("only one", "")
    assert D.question_and_answer(None) == ("", "")


def test_odd_items():
    index = D.build_index([(1, "", ""), (2, "one", ""), (3, None, None), (None, "two words", "")])
    assert [i.item_id for i in index.items] == [2, None]
    assert leaks("just one here", index) == [2]
    assert leaks("nothing", D.build_index([])) == []


def test_size_of_the_index_is_checked(monkeypatch):
    monkeypatch.setattr(D, "MOST_ITEM_WORDS", 3)
    with pytest.raises(ValueError, match="in parts"):
        D.build_index([(1, "four words are here", "")])


def test_rows(spark, odd_docs, odd_rows, no_docs):
    leak = f"{sentence(5, 30)} {ITEMS[3][1]} {ITEMS[3][2]}"
    rows = [(900, leak, "en", "s", 1), (900, leak, "en", "s", 1), (None, leak, "en", "s", 1), (901, sentence(6, 50), "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = sorted((r.doc_id or -1, r.item_id, r.overlap) for r in D.contaminated(docs, INDEX).collect())
    assert got == [(-1, 3, 1.0), (900, 3, 1.0), (900, 3, 1.0)]
    assert [r.doc_id for r in D.clean(docs, INDEX).collect()] == [901]
    kept = D.clean(odd_docs, INDEX)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)
    assert D.clean(no_docs, INDEX).collect() == []


def test_index_of_a_table(spark):
    items = spark.createDataFrame([(1, "A question here? Yes."), (2, None), (None, "x y z")], "item_id long, text string")
    assert [(i.item_id, i.question, len(i.words)) for i in D.index_of(items).items] == [(1, 3, 4), (None, 3, 3)]


def test_rows_without_words_do_not_displace_items(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_ITEM_WORDS", 8)
    rows = [(i, (None, "", " \n", "?! .")[i % 4]) for i in range(40)] + [(50, "one two three."), (51, "é 7?")]
    items = spark.createDataFrame(rows, "item_id long, text string").coalesce(1)
    assert [i.item_id for i in D.index_of(items).items] == [50, 51]
    many = spark.createDataFrame([(i, "\u00a0") for i in range(9)], "item_id long, text string")
    with pytest.raises(ValueError, match="in parts"):
        D.index_of(many)


def test_block_maxima_are_at_most_as_many_as_the_words():
    items = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i} the", "") for i in range(2_000)]
    index = D.build_index(items)
    arrays = [v for v in vars(index).values() if hasattr(v, "nbytes")]
    assert sum(a.nbytes for a in arrays) <= 32 * sum(len(i.words) for i in index.items)
    assert leaks("x " + items[1234][1] + " y " + items[77][1], index) == [77, 1234]


@pytest.mark.parametrize("at_a_time", [1, 7, 100])
def test_passages_are_looked_at_a_few_at_a_time(monkeypatch, at_a_time):
    text = " ".join(f"{sentence(n, 60)} {q} {a}" for n, (_, q, a) in enumerate(ITEMS[:9]))
    monkeypatch.setattr(D, "AT_A_TIME", at_a_time)
    assert leaks(text) == slow_leaks(text) == list(range(9))
