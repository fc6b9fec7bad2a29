"""Personal data in whole texts: anchors found by Aho-Corasick, expanded by local parsers.

One automaton finds at-signs, plus signs, digits, scheme marks and the cues that announce an
identifier. Only there a parser looks left and right for the boundaries of an address, number or
account, and validates what it has found. Each kind is scanned from left to right without overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
from pyspark.sql import DataFrame

from citypulse.llm.common import map_rows

#: The order of kinds at one place. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
HOST = re.compile(r"(?:[^/?#@]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|localhost)(?::[0-9]{1,5})?(?=[/?#]|\Z)")
#: Between a cue and its value.
BETWEEN = re.compile(r"(?:[\x20_-]?(?:no|nr|number|id)\b\.?)?[\x20\"']{0,2}[:=#]?[\x20\"']{0,2}", re.ASCII | re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{5,}", re.ASCII)
#: A secret's value goes on to white space or a quote, or to the quote that it began with; a backslash takes a sign along.
SECRET = {"": re.compile(r"[^\s\"']*"), '"': re.compile(r'(?:\\\S|[^\s"])*'), "'": re.compile(r"(?:\\\S|[^\s'])*")}
LEAST_SECRET = 6
DIGIT = re.compile(r"[0-9]")
ACCOUNT_CUES = ("iban", "account", "acct", "passport", "customer", "member")
SECRET_CUES = ("token", "password", "passwd", "pwd", "secret", "api_key", "api-key", "apikey")
#: Further forms of cues, beside lower case, a capital at the start, and capitals.
CAMEL_CUES = ("apiKey", "ApiKey", "Api-Key", "Api_Key")
#: The word before a credential of a request; with no sign between them, only a long value counts.
BEARER, LEAST_BEARER = "bearer", 16


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in "0123456789":
        found.add_word(sign, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in (cue, cue.capitalize(), cue.upper()):
                found.add_word(form, (kind, len(form)))
    for form in CAMEL_CUES:
        found.add_word(form, ("secret", len(form)))
    for form in (BEARER, BEARER.capitalize(), BEARER.upper()):
        found.add_word(form, ("secret", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _email(text: str, at: int, after: int) -> tuple[int, int] | None:
    start = at
    while start > after and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _ips(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """The matches in a chain of dotted numbers, four parts each from its start, and the chain's end."""
    chain = DOTTED.match(text, start)
    parts = chain[0].split(".")
    found = []
    for first in range(0, len(parts) - 3, 4):
        four = parts[first : first + 4]
        size = sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            found.append((start, start + size))
        start += size + 1
    return found, chain.end()


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    run = DIALLED.match(text, plus)
    if not run:
        return None
    number = run[0].rstrip(" ().-")
    digits = sum(c.isdigit() for c in number)
    return (plus, plus + len(number)) if len(number) >= 4 and 10 <= digits <= 15 else None


def _url(text: str, mark: int, after: int) -> tuple[int, int] | None:
    start = mark
    while start > after and text[start - 1] in SCHEME:
        start -= 1
    while start < mark and not text[start].isalpha():
        start += 1
    run = ADDRESS.match(text, mark + 3) if start < mark else None
    if not run:
        return None
    rest = run[0].rstrip(".,;:!?)]*#$%&")
    return (start, mark + 3 + len(rest)) if HOST.match(rest) else None


class _Values:
    """Ends of secret values, and the digits in them: each part of a text is read once for each kind of quote."""

    def __init__(self, text: str):
        self.text = text
        self.read = dict.fromkeys(SECRET, (0, 0))
        self.digit = -1

    def end(self, at: int, quote: str) -> int:
        start, end = self.read[quote]
        if not start <= at < end:
            end = SECRET[quote].match(self.text, at).end()
            self.read[quote] = at, end
        return end

    def has_digit(self, at: int, end: int) -> bool:
        if self.digit < at:
            found = DIGIT.search(self.text, at)
            self.digit = found.start() if found else len(self.text)
        return self.digit < end


def _secret(text: str, start: int, at: int, values: _Values) -> tuple[int, int] | None:
    """The value at ``at``, what is between it and its cue beginning at ``start``.

    Marks that end a sentence or close a bracket are left out behind a value without quotes. Without
    a quote, colon or the like before it a value begins with a letter or digit.
    """
    quote = text[at - 1] if text[at - 1] in "\"'" else ""
    end = values.end(at, quote)
    if not values.has_digit(at, end) or not (set(text[start:at]) & set("\"':=#") or text[at].isalnum()):
        return None
    if not quote or text[end : end + 1] != quote:
        while end > at and text[end - 1] in ".,;:)]}>":
            end -= 1
    return (at, end) if end - at >= LEAST_SECRET else None


def _announced(text: str, start: int, end: int, kind: str, values: _Values) -> tuple[int, int] | None:
    """The value that a cue at start:end announces.

    The cue must be a word, or the end of one behind ``_`` or ``-``, or behind a small letter or digit if it
    begins with a capital and goes on in small letters, as in ``accessToken``.
    """
    if text[end : end + 1].isalnum():
        return None
    if start and text[start - 1].isalnum():
        camel = text[start].isupper() and text[start + 1].islower()
        if not camel or text[start - 1].isupper():
            return None
    at = BETWEEN.match(text, end).end()
    if at == end:
        return None
    if kind == "secret":
        found = _secret(text, end, at, values)
        bearer = found and text[start:end].lower() == BEARER
        return None if bearer and found[1] - found[0] < LEAST_BEARER else found
    if iban := IBAN.match(text, at):
        while (size := len(iban[0])) and not iban_holds(iban[0].replace(" ", "")):
            # words in capitals may follow
            shorter = iban[0].rfind(" ")
            iban = IBAN.fullmatch(iban[0], 0, shorter) if shorter > 0 else None
            if not iban:
                break
        else:
            return at, at + size
    value = VALUE.match(text, at)
    if value and any(c.isdigit() for c in value[0]):
        return at, at + len(value[0].rstrip("-_"))
    return None


def spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a whole text, by start, then in the order of ``KINDS``. In code points."""
    found: list[tuple[int, int, str]] = []
    after = dict.fromkeys(KINDS, 0)
    values = _Values(text)

    def keep(kind: str, span: tuple[int, int] | None) -> None:
        if span:
            found.append((*span, kind))
            after[kind] = span[1]

    for last, (anchor, size) in anchors.iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= after["ip"]:
                four, after["ip"] = _ips(text, at)
                found.extend((*s, "ip") for s in four)
            if at >= after["card"]:
                run = DIGITS.match(text, at)
                after["card"] = run.end() if run else at + 1
                if run and 14 <= len(digits := re.sub(r"[\x20-]", "", run[0])) <= 19 and luhn(digits):
                    found.append((at, run.end(), "card"))
        elif anchor == "at":
            keep("email", _email(text, at, after["email"]))
        elif anchor == "plus":
            keep("phone", _phone(text, at))
        elif anchor == "scheme":
            if at >= after["url"]:
                keep("url", _url(text, at, after["url"]))
        elif at >= after[anchor]:
            keep(anchor, _announced(text, at, last + 1, anchor, values))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans by kind, their digest, all spans and their number: a row for each row.

    Null and empty texts have no spans. Positions count code points, the end is exclusive.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        anchors = automaton()
        for doc_id, text in rows:
            found = spans(text, anchors) if text else []
            base = [s for s in found if s[2] in BASE]
            kinds = [s[2] for s in base]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            yield doc_id, *(kinds.count(k) for k in BASE), digest, written(found), len(found)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return map_rows(docs.select("doc_id", "text"), run, schema)


def masked(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first one names the whole."""
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join((*out, text[at:]))
