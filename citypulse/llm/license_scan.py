"""Licence texts and notices in documents: winnowed fingerprints pick candidates, banded alignment decides.

A template of n words may lack a fifth of them. Its words are winnowed: each has a value, and the
least value of every window of consecutive words is selected. A template's window is the widest that
selects one word more than may be lacking. So every alignment that reaches the coverage holds a
selected word, whatever else was changed or put between, and so does every run of unbroken words as
long as the window. An inverted index leads from a selected word in a document to the template and
the diagonal. The longest common subsequence around it bounds what alignment can reach; where that is
enough, the words are aligned with the template's in every band that holds the diagonal. Where
something long was put in or left out, the bands of the selected words around are joined to a wide
one. The share of the template's words that match is its coverage. Words that name the licence must
stand unbroken within the span.
"""

from __future__ import annotations

import math
import re
from bisect import bisect, insort
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from citypulse.llm.common import map_rows, word_blocks

LEAST_WORDS = 3
BAND = 8
COVERAGE = 0.8
#: What is put in or left out at one place may be up to this part of a template.
GAP = 4
CACHED_WORDS = 250_000
#: The index goes to every task, so its size is checked: words of all templates together.
MOST_TEMPLATE_WORDS = 2_000_000
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: The usual wording of public licences and their notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "gpl-3.0-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "bsd-notice": "Released under the BSD License.",
    "lgpl-work": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-work": "This work is licensed under the GNU Affero General Public License, version 3.",
    "lgpl-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
        "not be removed or altered from any source distribution."
    ),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
        "notices in the Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all "
        "derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor."
    ),
}

#: The words that name a licence. Each phrase must stand unbroken in the span of an alignment.
NAMING = {
    "apache-2.0-notice": ("Apache License", "Version 2.0"),
    "apache-2.0-header": ("Apache License", "Version 2.0"),
    "mit-notice": ("MIT",),
    "gpl-3.0-work": ("GNU General Public License", "version 3"),
    "gpl-notice": ("GNU General Public License",),
    "mpl-2.0-notice": ("Mozilla Public License",),
    "cc-by-4.0-notice": ("CC BY 4.0",),
    "cc-by-nc-4.0-notice": ("CC BY-NC 4.0",),
    "cc-by-sa-work": ("Creative Commons", "Attribution-ShareAlike 4.0"),
    "bsd-notice": ("BSD",),
    "lgpl-work": ("GNU Lesser General Public License", "version 3"),
    "agpl-work": ("GNU Affero General Public License", "version 3"),
    "lgpl-notice": ("GNU Lesser General Public License",),
    "agpl-notice": ("GNU Affero General Public License",),
}


@dataclass(frozen=True)
class Index:
    """names, words, least matches and naming phrases by template; vocabulary: word -> number.

    windows: how many words are winnowed to one, by template; postings: number of a selected word ->
    (template, place).
    """

    names: tuple[str, ...]
    words: tuple[tuple[int, ...], ...]
    needed: tuple[int, ...]
    naming: tuple[tuple[tuple[int, ...], ...], ...]
    windows: tuple[int, ...]
    vocabulary: dict[bytes, int]
    postings: dict[int, list[tuple[int, int]]]


def _bare(word: bytes) -> bytes:
    return word.lower().strip(MARKS)


def _bare_words(text: str) -> list[bytes]:
    return [w for w in map(_bare, text.encode().split()) if w]


def minima(words: list[bytes], window: int) -> list[int]:
    """The places of the least value in each window, the last of equal ones.

    A word's value is its length, the longest first, as long words are rare in texts; then XXH64.
    """
    values = [(-len(w), xxhash.xxh64_intdigest(w)) for w in words]
    waiting: deque[int] = deque()
    places: list[int] = []
    for at, value in enumerate(values):
        while waiting and values[waiting[-1]] >= value:
            waiting.pop()
        waiting.append(at)
        if waiting[0] <= at - window:
            waiting.popleft()
        if at >= window - 1 and (not places or places[-1] != waiting[0]):
            places.append(waiting[0])
    return places


def winnowed(words: list[bytes], least: int) -> tuple[int, list[int]]:
    """(window, places) of the widest window that selects ``least`` places or more.

    What a wider window selects, a narrower one selects too, so the numbers only fall.
    """
    narrow, wide = 1, len(words)
    while narrow < wide:
        middle = (narrow + wide + 1) // 2
        if len(minima(words, middle)) >= least:
            narrow = middle
        else:
            wide = middle - 1
    return narrow, minima(words, narrow)


def build_index(
    templates: dict[str, str], coverage: float = COVERAGE, naming: dict[str, tuple[str, ...]] | None = None
) -> Index:
    """Templates of fewer than ``LEAST_WORDS`` words say too little and are refused, and so is a name that is not in its template."""
    vocabulary: dict[bytes, int] = {}
    names, rows, needed, phrases, windows = [], [], [], [], []
    postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for template, (name, text) in enumerate(sorted(templates.items())):
        bare = _bare_words(text)
        if len(bare) < LEAST_WORDS:
            raise ValueError(f"{name}: a template needs {LEAST_WORDS} words or more")
        names.append(name)
        rows.append(tuple(vocabulary.setdefault(w, len(vocabulary)) for w in bare))
        needed.append(max(1, math.ceil(coverage * len(bare) - 1e-9)))
        phrases.append(tuple(
            tuple(vocabulary.get(w, -1) for w in _bare_words(phrase)) for phrase in (naming or {}).get(name, ())
        ))
        if not _holds(rows[-1], phrases[-1]):
            raise ValueError(f"{name}: its naming words are not in the template")
        window, places = winnowed(bare, len(bare) - needed[-1] + 1)
        windows.append(window)
        for place in places:
            postings[rows[-1][place]].append((template, place))
    if sum(map(len, rows)) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates hold more than {MOST_TEMPLATE_WORDS} words; pass them in parts")
    return Index(tuple(names), tuple(rows), tuple(needed), tuple(phrases), tuple(windows), vocabulary, dict(postings))


def _holds(words: Sequence[int], phrases: tuple[tuple[int, ...], ...]) -> bool:
    """Whether each phrase stands unbroken in ``words``."""
    return all(
        any(tuple(words[i : i + len(phrase)]) == phrase for i, word in enumerate(words) if word == phrase[0])
        for phrase in phrases
    )


class _Words(dict):
    """The number of a word as it stands in the text; -1: in no template, -2: marks alone."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary, self.room = vocabulary, CACHED_WORDS
        self.places: dict[int, dict[int, int]] = {}

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(MARKS)
        number = self.vocabulary.get(plain, -1) if plain else -2
        if self.room:
            self.room -= 1
            self[word] = number
        return number


def _most(template: tuple[int, ...], places: dict[int, int], text: list[int]) -> int:
    """The length of the longest common subsequence; ``places`` has a bit for each place of a word in the template."""
    whole = free = (1 << len(template)) - 1
    for word in text:
        if here := places.get(word):
            met = free & here
            free = (free + met | free - met) & whole
    return len(template) - free.bit_count()


def alignments(index: Index, numbers: np.ndarray, words: _Words) -> Iterator[tuple[int, int, int, int]]:
    """(template, matched words, first, last place in the text) of every alignment with enough matches and its names."""
    prints = np.zeros(len(index.vocabulary) + 1, dtype=bool)  # the last one is for words in no template
    prints[list(index.postings)] = True
    at = np.flatnonzero(prints[numbers])
    hits: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    found = numbers[at]
    for word in np.unique(found).tolist():
        here = at[found == word]
        for template, place in index.postings[word]:
            hits[template].append((here, here - place))
    for template, parts in hits.items():
        row = index.words[template]
        places, diagonals = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(places, kind="stable")
        places, diagonals = places[order], diagonals[order]
        # a window with fewer words of the template than are needed holds no alignment
        member = np.zeros(len(prints), dtype=bool)
        member[list(row)] = True
        upto = np.concatenate(([0], np.cumsum(member[numbers])))
        margin = _reach(row)[1]
        ends = np.clip(diagonals + (len(row) + margin), 0, len(numbers)), np.clip(diagonals - margin, 0, len(numbers))
        worth = np.flatnonzero(upto[ends[0]] - upto[ends[1]] >= index.needed[template])
        if not len(worth):
            continue
        if template not in words.places:
            words.places[template] = defaultdict(int)
            for i, word in enumerate(row):
                words.places[template][word] |= 1 << i
        for one in _of_template(
            row, index.needed[template], index.naming[template], places, diagonals, worth, numbers, words.places[template]
        ):
            yield template, *one


def _reach(row: tuple[int, ...]) -> tuple[int, int]:
    """(how far apart joined diagonals may be, how many words before and behind a diagonal any band takes)."""
    reach = len(row) // GAP if len(row) // GAP > 2 * BAND else 0
    return reach, max(2 * BAND, reach + BAND)


def _of_template(
    row: tuple[int, ...], needed: int, naming: tuple, ats: np.ndarray, diagonals: np.ndarray, worth: np.ndarray,
    numbers: np.ndarray, places: dict[int, int],
) -> Iterator[tuple[int, int, int]]:
    """(matched words, first, last place in the text) from the selected words of one template.

    ``ats`` has their places in the text, in order, ``diagonals`` their diagonals, ``worth`` which of them to try.

    One on the diagonal d is tried in the bands around d - BAND ... d + BAND, which are all that hold
    d. Around an exact copy they all give that copy. If more words would match farther off, the band
    from the lowest to the highest diagonal of the selected words in reach is tried too; reach
    is a part of the template's length, and none where a single band reaches as far.
    """
    size = len(row)
    reach, margin = _reach(row)
    tried: dict[tuple[int, int], tuple[int, int, int]] = {}

    def attempt(low: int, high: int) -> tuple[int, int, int]:
        if (low, high) not in tried:
            base = max(0, low - BAND)
            text = numbers[base : max(0, high + size + BAND + 1)].tolist()
            matched, first, last = aligned(row, text, low - base, high - base)
            named = matched >= needed and _holds(text[first : last + 1], naming)
            tried[low, high] = (matched if named else 0), base + first, base + last
        return tried[low, high]

    # where any two alignments in reach overlap, one with the most matches makes others needless
    alone = 2 * needed > size + 4 * BAND
    for middle in diagonals[worth].tolist():
        near = numbers[max(0, middle - margin) : max(0, middle + size + margin)].tolist()
        if not _holds(near, naming) or (most := _most(row, places, near)) < needed:
            continue
        if middle >= 0 and tuple(numbers[middle : middle + size].tolist()) == row:
            yield size, middle, middle + size - 1
            continue
        best = 0
        close = _most(row, places, numbers[max(0, middle - 2 * BAND) : max(0, middle + size + 2 * BAND)].tolist()) if reach else most
        if close >= needed:
            for shift in sorted(range(middle - BAND, middle + BAND + 1), key=lambda s: abs(s - middle)):
                found = attempt(shift, shift)
                best = max(best, found[0])
                if found[0] >= needed:
                    yield found
                if alone and found[0] == close:
                    break
        if reach and best < most:
            around = diagonals[np.searchsorted(ats, middle - margin) : np.searchsorted(ats, middle + size + margin, "right")]
            around = around[np.abs(around - middle) <= reach]
            if around.max() - around.min() > 2 * BAND:
                found = attempt(int(around.min()), int(around.max()))
                if found[0] >= needed:
                    yield found


def _apart(found: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of alignments of one template that overlap the one with the most matches stays, then the tightest, then the first."""
    taken: dict[int, list[tuple[int, int]]] = defaultdict(list)
    kept = []
    for template, matched, first, last in sorted(set(found), key=lambda f: (-f[1], f[3] - f[2], f[2], f[0])):
        spans = taken[template]
        i = bisect(spans, (first, last))
        if (i == 0 or spans[i - 1][1] < first) and (i == len(spans) or spans[i][0] > last):
            insort(spans, (first, last))
            kept.append((template, matched, first, last))
    return kept


def aligned(template: tuple[int, ...], text: list[int], shift: int, upto: int | None = None) -> tuple[int, int, int]:
    """(matched words, first, last place in the text) of the best alignment within the band.

    The template's word i is compared with the text's i + shift - BAND ... i + upto + BAND (``upto``
    is ``shift`` if not given). Matches count one, skipped words and mismatches nothing; of equal
    alignments the tightest at its end wins.
    """
    if list(template) == text[max(shift, 0) : shift + len(template)] and shift >= 0:
        return len(template), shift, shift + len(template) - 1
    none = (0, 0, 0)  # matched, -first, -last: larger is better
    width = 2 * BAND + 1 + (0 if upto is None else upto - shift)
    before = [none] * (width + 2)
    for i, word in enumerate(template):
        now = [none] * (width + 2)
        for offset in range(width):
            place = i + shift - BAND + offset
            best = max(before[offset + 2], now[offset])  # skip the template's word, or the text's
            if 0 <= place < len(text) and text[place] == word and word >= 0:
                came = before[offset + 1]
                here = (came[0] + 1, came[1] if came[0] else -place, -place)
                best = max(best, here, key=lambda b: (b[0], b[1] - b[2] if b[0] else 0))
            now[offset + 1] = best
        before = now
    matched, first, last = max(before, key=lambda b: (b[0], b[2] - b[1] if b[0] else 0))
    return matched, -first, -last


def licences(index: Index, text: bytes, words: _Words) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, start, end) of a whole text; code points, end exclusive."""
    blocks = [np.fromiter(map(words.__getitem__, block), dtype=np.int64, count=len(block)) for block in word_blocks(text.lower())]
    if not blocks:
        return []
    every = np.concatenate(blocks)
    kept = np.flatnonzero(every > -2)
    found = [
        (template, matched, int(kept[first]), int(kept[last]))
        for template, matched, first, last in _apart(alignments(index, every[kept], words))
    ]
    if not found:
        return []
    wanted = {place for _, _, *ends in found for place in ends}
    spots = {i: m.span() for i, m in enumerate(WORD.finditer(text)) if i in wanted}
    out = []
    for template, matched, first, last in found:
        before = text[: spots[first][0]].decode()
        inside = text[spots[first][0] : spots[last][1]].decode()
        size = len(index.words[template])
        spread = np.count_nonzero(every[first : last + 1] > -2) > size + 2 * BAND
        found_row = (index.names[template], round(matched / size, 6), matched, len(before), len(before) + len(inside))
        out.append((found_row, spread))
    best = [a for a, spread in out if not any(_gives_way(a, spread, b) for b, _ in out)]
    return sorted(best, key=lambda r: (r[3], r[4], r[0]))


def _gives_way(a: tuple, spread: bool, b: tuple) -> bool:
    """Words that a template shares with another one at the same place speak for the better match.

    So does what lies within an alignment that is spread, as the third clause of a licence of three in that of two.
    """
    if not (b[3] < a[4] and a[3] < b[4]):
        return False
    return (b[1] > a[1] and b[2] >= a[2]) or (spread and b[1] >= a[1] and b[2] > a[2])


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
    naming: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """doc_id, template, coverage, matched_words, start, end: a row for each licence found in a text.

    The span goes from the first to the last matched word, marks at their ends included. Of templates
    that overlap in the text one gives way to another of higher coverage and no fewer matched words;
    so a whole notice within a whole licence is reported beside it. Other words may stand for some of a
    template's, as far as the coverage allows, but not for those that ``naming`` lists for it
    (default: ``NAMING`` for the library's own templates). Null and empty texts have none.
    """
    index = build_index(TEMPLATES, coverage, NAMING) if templates is None else build_index(templates, coverage, naming)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        words = _Words(index.vocabulary)
        for doc_id, text in rows:
            for found in licences(index, text or b"", words):
                yield doc_id, *found

    schema = "doc_id long, template string, coverage double, matched_words int, start long, end long"
    return map_rows(docs.select("doc_id", "text"), run, schema, binary=("text",))
