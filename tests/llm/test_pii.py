"""Base kinds against the plain patterns, further kinds on examples."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from citypulse.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ANCHORS = pii.automaton()


def valid(kind: str, found: str) -> bool:
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and pii.luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def slow(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def base(text: str) -> list[tuple[int, int, str]]:
    return [s for s in pii.spans(text, ANCHORS) if s[2] in pii.BASE]


@pytest.mark.parametrize("signs", ["0123456789.@+- ()ab4é:/\n", "0123456789. -+@a", "01.", "a.@-", "+0() "])
def test_base_kinds_equal_the_patterns(signs):
    dice = random.Random(3)
    for _ in range(8_000):
        text = "".join(dice.choice(signs) for _ in range(dice.randint(0, 50)))
        assert base(text) == slow(text), text


def test_cards_with_a_right_check_digit():
    dice = random.Random(4)
    for _ in range(2_000):
        digits = "".join(dice.choice("0123456789") for _ in range(dice.randint(13, 18)))
        digits += next(c for c in "0123456789" if pii.luhn(digits + c))
        text = "x " + "".join(c + dice.choice(["", "", " ", "-"]) for c in digits) + dice.choice(["", " 7", "."])
        assert base(text) == slow(text), text


@pytest.mark.parametrize(
    "text, wanted",
    [
        ('token = "04dbebab91ab85687d33eeaa" x', ["secret 04dbebab91ab85687d33eeaa"]),
        ("see https://u:p@ex.com:80/a?b). now", ["url https://u:p@ex.com:80/a?b", "email p@ex.com"]),
        ("IBAN: DE89 3704 0044 0532 0130 00 AND SO", ["account DE89 3704 0044 0532 0130 00"]),
        ("account no. 12345678, more", ["account 12345678"]),
        ("a token is nice and mytoken: 123456", []),
        ("http://nohost /x", []),
        ("é\U0001f600 a@b.c", ["email a@b.c"]),
    ],
)
def test_further_kinds(text, wanted):
    assert [f"{k} {text[a:b]}" for a, b, k in pii.spans(text, ANCHORS)] == wanted


def test_masked():
    text = "to a@b.c or +1 (555) 555-0100."
    assert pii.masked(text, pii.spans(text, ANCHORS)) == "to <email> or <phone>."


def test_very_long_numbers_and_texts():
    text = "1" * 4_000 + "." + "2" * 4_000 + ".3.4 " + "a" * 200_000 + "@b.c"
    assert base(text) == slow(text)


def test_every_row_comes_back(spark, odd_docs, odd_rows, no_docs):
    got = pii.personal_data(odd_docs).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in odd_rows)
    texts = {r[0]: r[1] for r in odd_rows}
    for r in got:
        if r.doc_id is not None:
            want = pii.written(slow(texts[r.doc_id] or ""))
            assert r.n_spans == (r.spans.count(",") + 1 if r.spans else 0)
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert pii.personal_data(no_docs).collect() == []


@pytest.mark.parametrize("size", [6, 127, 128, 129, 300, 1_000, 100_000])
@pytest.mark.parametrize("cue, kind", [("token = ", "secret"), ("account: ", "account"), ('"db_password": "', "secret")])
def test_values_of_any_size_are_covered_whole(size, cue, kind):
    value = "a1" * (size // 2) + "b" * (size % 2)
    text = f"x {cue}{value}" + ('"' if cue.endswith('"') else "") + " y"
    assert [(k, text[a:b]) for a, b, k in pii.spans(text, ANCHORS)] == [(kind, value)]
    assert value[-6:] not in pii.masked(text, pii.spans(text, ANCHORS))


JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dBjftJeZ4CVP-mB92K27uhbUJU1p1r_wW1gFWFOEjXk"


@pytest.mark.parametrize("value", [JWT, "aGVsbG8/d29ybGQ+MTIzNDU2Nzg5MA==", "/9j+4AAQ/SkZ=", "p4ss!w0rd$%&x", "pässwörd12€"])
@pytest.mark.parametrize("cue", ["token", "access_token", "client_secret", "db_password", "AUTH_TOKEN", "x-api_key", "Secret"])
@pytest.mark.parametrize("form", ["{}={}", "{}: {}", '"{}": "{}"', "{} = '{}'", "see ({}={}).", "{}={},\nnext"])
def test_secrets_of_any_marks_behind_cues_of_any_prefix(value, cue, form):
    text = "a " + form.format(cue, value) + " b"
    assert [text[a:b] for a, b, k in pii.spans(text, ANCHORS) if k == "secret"] == [value]


@pytest.mark.parametrize("cue", ["accessToken", "apiKey", "ApiKey", "api-key", "X-Api-Key", "API-KEY", "dbPassword", "client2Secret", "pwd", "DB_PWD", "userPwd"])
@pytest.mark.parametrize("form", ["{}={}", "{}: {}", '"{}": "{}"', "see ({}={})."])
def test_secrets_behind_cues_in_camel_case_and_other_forms(cue, form):
    text = "a " + form.format(cue, JWT) + " b"
    assert [text[a:b] for a, b, k in pii.spans(text, ANCHORS) if k == "secret"] == [JWT]


def test_bearer():
    for text in (f"Authorization: Bearer {JWT}", f"-H 'authorization: bearer {JWT}'", f"token: Bearer {JWT}"):
        assert [text[a:b] for a, b, k in pii.spans(text, ANCHORS) if k == "secret"] == [JWT]
    for text in ("the bearer 1234567 of this", "bearer of news", "Bearer token", "forbearer abcdef1234567890abcdef"):
        assert pii.spans(text, ANCHORS) == []


def test_a_quoted_value_ends_at_its_own_quote():
    text = """password = "it's(1,2);" and secret='a\\'b"123,' token "abc123", token=abc123"x"""
    got = [text[a:b] for a, b, k in pii.spans(text, ANCHORS) if k == "secret"]
    assert got == ["it's(1,2);", "a\\'b\"123,", "abc123", "abc123"]


@pytest.mark.parametrize("text", ["_token", "mytoken: 123456", "MYTOKEN: 123456", "myTOKEN: 123456", "HToken: 123456", "tokenX=123456", "token (see 12345678)", "token: nothing here", "token=1.", "tokens=123456"])
def test_no_secret(text):
    assert pii.spans(text, ANCHORS) == []


@pytest.mark.parametrize("part", ["token=", 'token="', "token='x", "account-no.", "secret: ", "my_account=a"])
def test_many_cues_without_values_are_read_once(part):
    assert pii.spans(part * 40_000, ANCHORS) == []
