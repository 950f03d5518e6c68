"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

The templates' word k-grams are hashed, the smallest hash of each window of
consecutive k-grams is kept (winnowing), and an inverted index maps each kept
hash to templates and positions.  A text's hashes are looked up in the index;
hits of one template on nearby diagonals form a candidate region, in which
banded alignments of template against text count matched words and find the
span of each occurrence.  The index is built from the given templates only and is broadcast;
``MAX_TEMPLATE_WORDS`` bounds it, larger template sets are refused.

Because both sides keep the minimum of every window, a run of ``GRAM + KEEP - 1``
words that a text shares with a template is always found.

Defined cases
    null or empty text: no matches.  Repeated rows: each its own.  Overlapping
    matches: the one with most matched words stays (ties: the earlier, then
    the template's name).  Empty table: empty result.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame

from journey.llm.common import map_rows, q
from journey.llm.wordhash import gram_hashes, word_hashes

# --- fixed values: texts of public licenses and notices ------------------------------
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."),
    "mit-notice": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer."),
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}
# --- parameters ---------------------------------------------------------------------------
GRAM, KEEP = 3, 2
BAND = 6
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000
# ----------------------------------------------------------------------------------------------

_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_WORD = re.compile(r"[0-9a-zA-Z\u0080-\U0010ffff]+")


def hashes_of(text: str) -> np.ndarray:
    return word_hashes(text.encode().lower(), _IS_WORD)


def winnow(grams: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """Positions of the smallest hash in each window of ``keep`` k-grams (the rightmost of equals)."""
    n = len(grams) - keep + 1
    if n <= 0:
        return np.flatnonzero(grams == grams.min()) if len(grams) else np.zeros(0, np.int64)
    wins = np.lib.stride_tricks.sliding_window_view(grams, keep)
    return np.unique(np.arange(n) + keep - 1 - np.argmin(wins[:, ::-1], axis=1))


class TemplateIndex:
    """Inverted index of winnowed k-grams: hash -> (template, word position)."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM):
        self.names = sorted(templates)
        self.words = [hashes_of(templates[n]) for n in self.names]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError("too many template words for one index")
        places = defaultdict(list)
        for t, words in enumerate(self.words):
            grams = gram_hashes(words, gram)
            for p in winnow(grams):
                places[int(grams[p])].append((t, int(p)))
        self.places = dict(places)
        self.keys = np.sort(np.array(list(places), np.uint64))
        self.gram = gram

    def candidates(self, words: np.ndarray) -> dict[int, list[int]]:
        """Template -> sorted diagonals (text position minus template position) of the hits."""
        grams = gram_hashes(words, self.gram)
        if not len(grams) or not len(self.keys):
            return {}
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        out = defaultdict(list)
        known = np.flatnonzero(self.keys[at] == grams)
        if not len(known):
            return {}
        kept = set(winnow(grams).tolist())
        for p in known.tolist():
            for t, place in self.places[int(grams[p])]:
                # a gram that the text's own window passes over still counts where the template kept it
                if p in kept or len(self.words[t]) < self.gram + KEEP:
                    out[t].append(p - place)
        return {t: sorted(d) for t, d in out.items()}

    def regions(self, words: np.ndarray):
        """(template, first diagonal, last diagonal): hits closer than the band belong together."""
        for t, diagonals in self.candidates(words).items():
            first = last = diagonals[0]
            for d in diagonals[1:]:
                if d - last > BAND:
                    yield t, first, last
                    first = d
                last = d
            yield t, first, last


def align(template: np.ndarray, words: np.ndarray, first: int, last: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, start, end) of the best alignment on the diagonals [first - band, last + band].

    Maximises matches less a half for each unmatched word of either side
    between matches; start and end are word positions in the text.
    """
    low, high = first - band, last + band
    width = high - low + 1
    gone = -1.0
    # per diagonal: score, matches, start, end of the best alignment that ends there
    row = [(0.0, 0, -1, -1)] * width
    best = (0.0, 0, -1, -1)
    n = len(words)
    for i, w in enumerate(template):
        new = []
        for k in range(width):
            p = i + low + k
            score, m, s, e = row[k]
            if 0 <= p < n and words[p] == w:
                cell = (score + 1, m + 1, p if s < 0 else s, p + 1)
            else:
                cell = (score - 1.0, m, s, e)
                if k + 1 < width and row[k + 1][0] - 0.5 > cell[0]:  # the template's word is missing
                    cell = (row[k + 1][0] - 0.5, *row[k + 1][1:])
                if k and new[k - 1][0] - 0.5 > cell[0]:  # the text has a word more
                    cell = (new[k - 1][0] - 0.5, *new[k - 1][1:])
                if cell[0] <= gone and cell[1] == 0:
                    cell = (0.0, 0, -1, -1)
            new.append(cell)
            if cell[0] > best[0]:
                best = cell
        row = new
    return best[1], best[2], best[3]


def windows(n_template: int, n_words: int, first: int, last: int):
    """(start, end, first diagonal, last diagonal) of the text windows of a region.

    Matches less half the extras are above 0, so an alignment spans less than
    three templates and lies in one of the overlapping windows as a whole.
    """
    start, end, reach = max(0, first - BAND), min(n_words, last + BAND + n_template), 3 * n_template
    for a in range(start, max(start, end - 2 * reach) + reach, reach):
        yield a, min(end, a + 2 * reach), first - BAND, last + BAND


def matches_of(text: str, index: TemplateIndex, min_coverage: float = MIN_COVERAGE) -> list[tuple[str, float, int, int]]:
    """(template, coverage, start, end) in code points, by start; matches do not overlap.

    Whatever a chosen match leaves free of a window is aligned again, until nothing
    there reaches the coverage, so repeated notices are found one by one.
    """
    words = hashes_of(text)
    found: list[tuple] = []

    def look(t, a, b, low, high):
        template = index.words[t]
        if b - a < min_coverage * len(template):
            return
        low, high = max(low, a - len(template) + 1), min(high, b - 1)
        n, s, e = align(template, words[a:b], low - a, high - a, 0) if low <= high else (0, 0, 0)
        if n and n >= min_coverage * len(template):
            heapq.heappush(found, (-n, a + s, index.names[t], a + e, t, (a, b, low, high)))

    for t, first, last in index.regions(words):
        for window in windows(len(index.words[t]), len(words), first, last):
            look(t, *window)
    if not found:
        return []
    chosen: list[tuple] = []
    taken = np.zeros(len(words), bool)
    while found:
        n, s, name, e, t, (a, b, low, high) = heapq.heappop(found)
        if not taken[s:e].any():
            taken[s:e] = True
            chosen.append((s, e, name, -n / len(index.words[t])))
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken[a:b], [True]]))) + a
        for free in edges.reshape(-1, 2).tolist():
            look(t, *free, low, high)
    places = [m.span() for m in _WORD.finditer(text)]
    return [(name, coverage, places[s][0], places[e - 1][1]) for s, e, name, coverage in sorted(chosen)]


def scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
         min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, n_matches, licenses, spans, coverage) of every row.

    ``licenses``: distinct template names, sorted; ``spans``: name:start:end by
    start; ``coverage``: the largest share of a template's words matched, 0 if none.
    """
    kind = df.select(q(doc_id)).schema[0].dataType.simpleString()
    index = df.sparkSession.sparkContext.broadcast(TemplateIndex(templates))

    def rows(cols):
        got = {"doc_id": cols["doc_id"], "n_matches": [], "licenses": [], "spans": [], "coverage": []}
        for t in cols["text_"]:
            m = matches_of(t, index.value, min_coverage) if t else []
            got["n_matches"].append(len(m))
            got["licenses"].append(",".join(sorted({x[0] for x in m})))
            got["spans"].append(",".join(f"{x[0]}:{x[2]}:{x[3]}" for x in m))
            got["coverage"].append(max((x[1] for x in m), default=0.0))
        return got

    picked = df.select(q(doc_id).alias("doc_id"), q(text).cast("string").alias("text_"))
    return map_rows(picked, rows, f"doc_id {kind}, n_matches long, licenses string, spans string, coverage double")
