"""License notices in texts: winnowed fingerprints pick candidates, an alignment confirms them.

Templates are cut into runs of a few words; of each window of runs the least hash is kept. The kept
hashes index the templates, so a text that repeats a window of a template, word for word, meets it.
Around the places where they meet, text and template are aligned within a band of diagonals; what is
reported is the share of the template's words that the text has in order, and where it has them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import (
    BASE,
    LOWER,
    U64,
    Words,
    flat,
    mix,
    slices,
    span_hashes,
)

# Words in a fingerprint, and runs in a window: a match of RUN + WINDOW - 1 words is never missed.
RUN = 3
WINDOW = 3
# Diagonals on either side of the one where text and template meet, at most; half a template's words
# at most too, so that its next occurrence lies outside.
BAND = 12
COVERAGE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1

RESULT = (
    "doc_id long, license string, coverage double, n_matched int, n_words int, start long, end long"
)

# Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
        ' in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License."
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution."
    ),
    "CC-BY-4.0 line": "Licensed under CC BY 4.0",
    "CC-BY-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies."
    ),
    "MIT line": "Released under the MIT License",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

LETTERS = np.zeros(256, bool)
LETTERS[128:] = LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Runs of letters and digits, A-Z in lower case, and their hashes."""
    words = Words(data, offsets, LETTERS)
    return words, span_hashes(LOWER[data], words.starts, words.ends)


def _runs(hashes: np.ndarray) -> np.ndarray:
    """Hashes of RUN successive words from each place."""
    n = max(0, len(hashes) - RUN + 1)
    out = np.zeros(n, np.uint64)
    for i in range(RUN):
        out += mix(hashes[i : i + n] + U64(BASE * (i + 1) % (1 << 64)))
    return mix(out)


def winnowed(runs: np.ndarray) -> list[int]:
    """Places of the least hash of each window, the rightmost of equals."""
    places = set()
    for i in range(max(1, len(runs) - WINDOW + 1)):
        window = runs[i : i + WINDOW]
        if len(window):
            places.add(i + len(window) - 1 - int(window[::-1].argmin()))
    return sorted(places)


class Templates:
    """Templates' word hashes, and an inverted index of their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = sorted(templates)
        data, offsets = flat(pa.array([templates[n] for n in self.names], pa.string()))
        words, hashes = _words(data, offsets)
        self.words = [hashes[a:b] for a, b in zip(words.rows[:-1], words.rows[1:], strict=True)]
        listed = []
        for number, own in enumerate(self.words):
            runs = _runs(own)
            listed += [(int(runs[p]), number, p) for p in winnowed(runs)]
        listed.sort()
        self.prints = np.array([x[0] for x in listed], np.uint64)
        self.entries = np.array([x[1:] for x in listed], np.int64).reshape(-1, 2)

    def meets(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of ``runs``, templates, and places in those, that have a fingerprint in common."""
        lo = np.searchsorted(self.prints, runs, "left")
        there = np.flatnonzero(lo < len(self.prints))
        there = there[self.prints[lo[there]] == runs[there]]
        hi = np.searchsorted(self.prints, runs[there], "right")
        count = hi - lo[there]
        place = np.repeat(there, count)
        first = np.repeat(lo[there] - (np.cumsum(count) - count), count)
        entry = self.entries[first + np.arange(len(place))]
        return place, entry[:, 0], entry[:, 1]


def band(template: np.ndarray) -> int:
    return min(BAND, max(1, len(template) // 2))


def aligned(template: np.ndarray, text: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """(text word, template word) that match, in order, in the best alignment near the diagonal.

    The whole template is aligned with any part of the text: text words before and after are free.
    """
    n, width = len(template), 2 * band(template) + 1
    offsets = np.arange(width) + diagonal - band(template)  # text place minus template place
    low = -(1 << 20)
    scores = np.full((n + 1, width), low, np.int64)
    starts = offsets
    scores[0] = np.where((starts >= 0) & (starts <= len(text)), 0, low)
    equal = np.zeros((n + 1, width), bool)
    ramp = GAP * np.arange(width)
    for i in range(1, n + 1):
        at = i - 1 + offsets
        inside = (at >= 0) & (at < len(text))
        equal[i] = inside & (text[at.clip(0, max(0, len(text) - 1))] == template[i - 1])
        step = scores[i - 1] + np.where(inside, np.where(equal[i], MATCH, MISMATCH), low)
        skip = np.append(scores[i - 1][1:], low) + GAP  # a template word that the text lacks
        here = np.maximum(np.maximum(step, skip), low)
        here[at + 1 == 0] = np.maximum(here[at + 1 == 0], GAP * i)  # before the text begins
        here[(at + 1 < 0) | (at + 1 > len(text))] = low
        scores[i] = np.maximum.accumulate(here - ramp) + ramp  # text words in between
    i, j = n, int(scores[n].argmax())
    # Template words after the text's end count as lacking, too.
    for last, column in enumerate(len(text) - np.arange(n + 1) - int(offsets[0])):
        if 0 <= column < width and scores[last, column] + GAP * (n - last) > scores[i, j] + GAP * (n - i):
            i, j = last, int(column)
    found = []
    while i > 0:
        at = i - 1 + int(offsets[j])
        value = scores[i, j]
        if 0 <= at < len(text) and value == scores[i - 1, j] + (MATCH if equal[i, j] else MISMATCH):
            if equal[i, j]:
                found.append((at, i - 1))
            i -= 1
        elif j + 1 < width and value == scores[i - 1, j + 1] + GAP:
            i, j = i - 1, j + 1
        elif j > 0 and value == scores[i, j - 1] + GAP:
            j -= 1
        else:
            break
    return found[::-1]


def chained(pairs: set[tuple[int, int]]) -> list[int]:
    """Text words of a longest series of pairs that ascends in the text and in the template."""
    ends: list[int] = []
    last: list[int] = []
    ordered = sorted(pairs, key=lambda x: (x[0], -x[1]))
    before: list[int] = []
    for at, (_, where) in enumerate(ordered):
        place = bisect_left(ends, where)
        before.append(last[place - 1] if place else -1)
        ends[place : place + 1] = [where]
        last[place : place + 1] = [at]
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(ordered[at][0])
        at = before[at]
    return out[::-1]


def notices(
    hashes: np.ndarray, places: np.ndarray, numbers: np.ndarray, at: np.ndarray, templates: Templates
) -> list[tuple[int, list[int]]]:
    """Templates and the matched words of one text, best first, without overlaps.

    Regions that hold enough of a template by themselves come first. Of what is left, regions of one
    template that lie within its length of each other are joined one by one, as long as that adds words:
    those that match in any of them are chained in the order of text and template, which leads over
    what was inserted or left out.
    """
    regions: dict[tuple[int, int], list[int]] = defaultdict(list)
    for place, number, where in zip(places.tolist(), numbers.tolist(), at.tolist(), strict=True):
        # Meetings on nearly the same diagonal belong to one occurrence.
        diagonal = place - where
        regions[number, diagonal // band(templates.words[number])].append(diagonal)
    found, partial = {}, defaultdict(list)
    for (number, _), diagonals in regions.items():
        template = templates.words[number]
        middle = sorted(diagonals)[len(diagonals) // 2]
        start = max(0, middle - band(template))
        stop = min(len(hashes), middle + len(template) + band(template))
        pairs = aligned(template, hashes[start:stop], middle - start)
        matched = [start + m for m, _ in pairs]
        if matched and len(matched) >= COVERAGE * len(template):
            found[number, matched[0], matched[-1]] = matched
        elif matched:
            partial[number].append([(start + m, w) for m, w in pairs])
    out: list[tuple[int, list[int]]] = []
    taken: list[tuple[int, int]] = []

    def take(candidates: dict[tuple[int, int, int], list[int]]) -> None:
        ranked = sorted(
            candidates.items(),
            key=lambda x: (-len(x[1]), -len(x[1]) / len(templates.words[x[0][0]]), x[0]),
        )
        for (number, first, last), matched in ranked:
            if all(last < a or first > b for a, b in taken):
                taken.append((first, last))
                out.append((number, matched))

    take(found)
    joint = {}
    for number, parts in partial.items():
        length = len(templates.words[number])
        # Words of notices that are reported already are not used again.
        parts = [[x for x in p if all(not a <= x[0] <= b for a, b in taken)] for p in parts]
        parts = sorted(p for p in parts if p)
        first = 0
        while first < len(parts):
            group, end, best, after = set(), parts[first][0][0], [], first
            while after < len(parts) and parts[after][0][0] <= end + length:
                end = max(end, parts[after][-1][0])
                group |= set(parts[after])
                matched = chained(group)
                if len(matched) <= len(best) and len(best) >= COVERAGE * length:
                    break  # the next piece is of the next notice
                best = max(best, matched, key=len)
                after += 1
            if len(best) >= COVERAGE * length:
                joint[number, best[0], best[-1]] = best
                first = after
            else:
                first += 1
    take(joint)
    return out


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each notice found: the license, how much of it, and where (code points).

    A notice is found if the text has a run of RUN + WINDOW - 1 of its words (all of a shorter one's
    runs may do) and COVERAGE of them in order, in pieces that have such a run each and are less than
    the notice's length apart; what stands between them is part of the span. Less than COVERAGE is not
    reported. Of overlapping notices the one with most words is reported. A null or empty text has none; null and repeated ids are kept.
    """
    known = Templates(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _found(part, known)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT)


def _found(part: pa.RecordBatch, known: Templates) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"))
    words, hashes = _words(data, offsets)
    places, numbers, at = known.meets(_runs(hashes))
    row = np.searchsorted(words.rows, places, "right") - 1
    inside = places + RUN <= words.rows[row + 1]
    places, numbers, at, row = (x[inside] for x in (places, numbers, at, row))
    # Code points are bytes that do not continue a character.
    points = None
    ids = part.column("id").to_pylist()
    out: list[tuple] = []
    for r in np.unique(row).tolist():
        lo, hi = words.rows[r], words.rows[r + 1]
        mine = row == r
        own = notices(hashes[lo:hi], places[mine] - lo, numbers[mine], at[mine], known)
        if own and points is None:
            points = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        for number, matched in own:
            begin, end = words.starts[lo + matched[0]], words.ends[lo + matched[-1]]
            n = len(known.words[number])
            base = points[offsets[r]]
            out.append(
                (
                    ids[r],
                    known.names[number],
                    len(matched) / n,
                    len(matched),
                    n,
                    int(points[begin] - base),
                    int(points[end] - base),
                )
            )
    kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    names = ("doc_id", "license", "coverage", "n_matched", "n_words", "start", "end")
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.record_batch(
        {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
    )
