"""License scans (operator 8): winnowed template fingerprints, then banded alignment of words.

The words of every template give hashes of k consecutive words, of which winnowing keeps
one at least in each window. An inverted index of these finds where a document may hold a
template; there the words of both are aligned in a band around the diagonal of the hits.
The templates are a parameter of bounded size and go to the tasks whole. A match must have the
words that tell licenses and versions apart; of templates that align with one span, one is named.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, text_of, words_of

#: Words of a fingerprint, and fingerprints of a window of which one is kept.
GRAM, WINDOW = 3, 4
#: Share of a template's words that must be matched in order.
MIN_COVERAGE = 0.8
_CASED = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

# Public license notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
}


def _notices() -> dict[str, str]:
    """Notices by the version of a license, as usual; short forms and SPDX tags too."""
    found = {}
    for kind, word, versions in (("gpl", "", "1 2 3"), ("lgpl", "Lesser ", "2.1 3"), ("lgpl", "Library ", "2"), ("agpl", "Affero ", "3")):
        for v in versions.split():
            name, title = f"{kind}-{v if '.' in v else v + '.0'}", f"GNU {word}General Public License"
            found[f"{name}-notice"] = f"This work is licensed under the {title}, version {v}."
            found[f"{name}-short"] = f"Licensed under the {kind.upper()} version {v}."
            found[f"{name}-header"] = (
                f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as "
                f"published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
            )
    forms = {"by": "", "by-sa": "-ShareAlike", "by-nc": "-NonCommercial", "by-nd": "-NoDerivatives"}
    forms |= {"by-nc-sa": "-NonCommercial-ShareAlike", "by-nc-nd": "-NonCommercial-NoDerivatives"}
    for form, words in forms.items():
        for v, where in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            found[f"cc-{form}-{v}-notice"] = f"This work is licensed under a Creative Commons Attribution{words} {v} {where} License."
            found[f"cc-{form}-{v}-short"] = f"Licensed under CC {form.upper()} {v}."
    for v in ("1.1", "2.0"):
        found[f"mpl-{v}-notice"] = f"This work is licensed under the Mozilla Public License, version {v}."
    found["mpl-2.0-header"] = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    )
    for v, where in (("1.0", "v10.html"), ("2.0", "2.0/")):
        found[f"epl-{v}-notice"] = f"This work is licensed under the Eclipse Public License, version {v}."
        found[f"epl-{v}-header"] = (
            f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {v} "
            f"which is available at https://www.eclipse.org/legal/epl-{where}"
        )
    for name in ("BSD 2-Clause", "BSD 3-Clause", "ISC"):
        found[f"{name.lower().replace(' ', '-')}-notice"] = f"Released under the {name} License."
    for name in (
        "MIT ISC BSD-2-Clause BSD-3-Clause Apache-2.0 MPL-1.1 MPL-2.0 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 "
        "CC0-1.0 Unlicense OFL-1.1 EPL-1.0 EPL-2.0"
    ).split():
        found[f"{name.lower()}-spdx"] = f"SPDX-License-Identifier: {name}"
    return found


# The short form of this one has the notice's name.
TEMPLATES = {k: v for k, v in _notices().items() if k != "cc-by-nc-4.0-short"} | {
    "cc-by-nc-4.0-long": _notices()["cc-by-nc-4.0-notice"]
} | TEMPLATES
TEMPLATES |= {
    f"{p.name.removesuffix('.txt')}-text": p.read_text(encoding="utf-8") for p in files(__package__).joinpath("licenses").iterdir()
}

#: Words that tell licenses apart; numbers tell versions where they follow one of these or of VERSIONED, or such a number.
TELLING = "affero lesser noncommercial sharealike noderivatives noderivs nc sa nd mit apache bsd isc mozilla eclipse gnu gpl lgpl agpl mpl epl cc0"
VERSIONED = "version v license attribution by"
#: From so many words on, a text's telling words are compared by their counts, and not in their order with the numbers.
LONG = 200

SCHEMA = "doc_id bigint, template string, coverage double, n_matched bigint, start bigint, end bigint"


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, equal to those that Spark's xxhash64 gives."""
    words = re.findall(ALNUM_WORD, _lower(text))
    return np.array([xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words], np.uint64)


def grams(hashes: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash for each run of ``size`` words; for the whole if there are fewer."""
    size = min(size, len(hashes))
    h = np.full(max(len(hashes) - size + 1, 0) if size else 0, size, np.uint64)
    for k in range(size):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + len(h)]
        h ^= h >> np.uint64(29)
    return h


def winnow(prints: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions of the smallest print of every window, the last of equal ones."""
    window = min(window, len(prints))
    found = set()
    for a in range(len(prints) - window + 1 if window else 0):
        part = prints[a : a + window]
        found.add(a + window - 1 - int(part[::-1].argmin()))
    return sorted(found)


def banded_match(template: list[int] | np.ndarray, words: list[int] | np.ndarray, shift: int, band: int) -> list[tuple[int, int]]:
    """Matched positions of a longest common subsequence whose pairs (i, j) have |j - i - shift| <= band."""
    template, words = np.asarray(template), np.asarray(words)
    width, m, n = 2 * band + 1, len(template), len(words)
    rows = np.zeros((m + 1, width + 1), np.int32)
    for i in range(m):
        above, first = rows[i], i + shift - band
        row = above[1:].copy()
        a, b = max(0, -first), min(width, n - first)
        if a < b:
            same = words[first + a : first + b] == template[i]
            row[a:b] = np.maximum(row[a:b], (above[a:b] + 1) * same)
        rows[i + 1, :width] = np.maximum.accumulate(row)
    i, k, found = m - 1, max(range(width), key=lambda k: (rows[m][k], -abs(k - band))), []
    while i >= 0 and k >= 0:
        here, j = rows[i + 1][k], i + shift - band + k
        if not here:
            break
        if k and rows[i + 1][k - 1] == here:
            k -= 1
        elif k + 1 < width and rows[i][k + 1] == here:
            i, k = i - 1, k + 1
        else:
            found.append((i, j))
            i -= 1
    return found[::-1]


def _telling(words: np.ndarray) -> list[int]:
    """The telling words, and the numbers that tell versions, in their order."""
    found, before = [], False
    for w in words.tolist():
        told = w in _TELLING or before and w in _NUMBERS
        if told:
            found.append(w)
        before = told or w in _VERSIONED
    return found


def _is_told(template: np.ndarray, span: np.ndarray) -> bool:
    """Whether a span has the telling words of a template, and no others."""
    if len(template) < LONG:
        return _telling(template) == _telling(span)
    own, other = (Counter(w for w in words.tolist() if w in _TELLING) for words in (template, span))
    return all(abs(own[w] - other[w]) <= max(2, own[w] // 2) for w in own | other)


_TELLING, _VERSIONED = ({int(h) for h in word_hashes(words)} for words in (TELLING, VERSIONED))
_NUMBERS = {int(h) for h in word_hashes(" ".join(map(str, range(100))))}


class Spans:
    """Spans by their lengths' powers of two, sorted by start: those that meet another one are found without looking at all."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}

    def add(self, first: int, last: int) -> None:
        insort(self.by_length.setdefault((last - first + 1).bit_length(), []), (first, last))

    def met(self, first: int, last: int) -> Iterator[tuple[int, int]]:
        for bits, spans in self.by_length.items():
            for at in range(bisect_left(spans, (first - (1 << bits),)), len(spans)):
                if spans[at][0] > last:
                    break
                if spans[at][1] >= first:
                    yield spans[at]


class Index:
    """Templates and an inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: word_hashes(t) for name, t in sorted(templates.items())}
        self.words = {name: w for name, w in self.words.items() if len(w)}
        self.counts = {name: np.unique(w, return_counts=True) for name, w in self.words.items()}
        self.sizes = sorted({min(GRAM, len(w)) for w in self.words.values()})
        self.places: dict[int, dict[int, list[tuple[str, int]]]] = {s: defaultdict(list) for s in self.sizes}
        for name, w in self.words.items():
            prints = grams(w)
            for at in winnow(prints):
                self.places[min(GRAM, len(w))][int(prints[at])].append((name, at))
        self.sorted = {s: np.array(sorted(p), np.uint64) for s, p in self.places.items()}

    def most(self, name: str, part: np.ndarray) -> int:
        """So many words of a template a part of a document can match at most: those in common, in any order."""
        own, counts = self.counts[name]
        at = np.minimum(np.searchsorted(own, part), len(own) - 1)
        return int(np.minimum(np.bincount(at[own[at] == part], minlength=len(own)), counts).sum())

    def scan(self, words: np.ndarray, min_coverage: float) -> list[tuple[str, int, int, int]]:
        """(template, matched words, first word, last word) of the matches in a document, by place, one for a span."""
        shifts: dict[str, set[int]] = defaultdict(set)
        for size in self.sizes:
            if len(words) < size:
                continue
            prints = grams(words, size)
            at = np.minimum(np.searchsorted(self.sorted[size], prints), len(self.sorted[size]) - 1)
            for hit in np.flatnonzero(self.sorted[size][at] == prints).tolist():
                for name, place in self.places[size][int(prints[hit])]:
                    if len(words) >= min_coverage * len(self.words[name]):
                        shifts[name].add(hit - place)
        found = []
        for name, own in shifts.items():
            template, band = self.words[name], max(2, len(self.words[name]) // 10)
            matches, done = [], None
            for shift in sorted(own):
                if done is not None and shift - done <= band:
                    continue  # the band of the one before covers it
                done = shift
                a, b = max(0, shift - band), min(len(words), shift + len(template) + 2 * band)
                part = words[a:b]
                if self.most(name, part) < min_coverage * len(template):
                    continue
                pairs = banded_match(template, part, shift + band // 2 - a, band + band // 2)
                if len(pairs) >= min_coverage * len(template) and _is_told(template, part[pairs[0][1] : pairs[-1][1] + 1]):
                    matches.append((name, len(pairs), a + pairs[0][1], a + pairs[-1][1]))
            kept = Spans()
            for m in sorted(matches, key=lambda m: (-m[1], m[2])):
                if not any(kept.met(m[2], m[3])):
                    kept.add(m[2], m[3])
                    found.append(m)
        # Templates that share the most of a span compete: coverage times matched words, so that a whole text
        # goes before a notice in it, and the text of the right version before the like one of another.
        best: list[tuple[str, int, int, int]] = []
        kept = Spans()
        for m in sorted(found, key=lambda m: (-m[1] * m[1] / len(self.words[m[0]]), m[2], m[0])):
            shared = lambda o: min(m[3], o[1]) - max(m[2], o[0]) + 1  # noqa: B023, E731
            if not any(2 * shared(o) > min(m[3] - m[2], o[1] - o[0]) + 1 for o in kept.met(m[2], m[3])):
                best.append(m)
                kept.add(m[2], m[3])
        return sorted(best, key=lambda m: (m[2], m[0]))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """A row for every match: doc_id, template, coverage (share of its words), n_matched, start and end in code points.

    Whole texts are scanned. Templates that align with one span (half of the shorter one at least) give one
    row, that of the best coverage and size; other matches of several templates may overlap at their ends.
    The words that tell licenses and versions apart must be the template's.
    Texts that are null, empty or hold no template give no rows, repeated rows give theirs
    each, an empty list of templates gives none. Other columns are not used.
    """
    index = Index(TEMPLATES if templates is None else templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy().view(np.uint64)
            rows = []
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                found = index.scan(values[a:b], min_coverage)
                if found:
                    spans = [m.span() for m in _CASED.finditer(batch.column(1)[i].as_py())]
                    doc_id = batch.column(0)[i].as_py()
                    for name, n, first, last in found:
                        rows.append((doc_id, name, n / len(index.words[name]), n, spans[first][0], spans[last][1]))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "template", "coverage", "n_matched", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    hashes = F.transform(words_of(text_of(docs), ALNUM_WORD), lambda w: F.xxhash64(w))
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"), hashes.alias("words"))
    return rows.mapInArrow(scanned, SCHEMA)
