"""License notices in texts: winnowed template fingerprints, an inverted index, and banded alignment.

The k-grams of a template's words are winnowed (the smallest hash of every ``window`` neighbours) into an inverted index
from hash to (template, place).  A text's k-grams are looked up; hits of one template on nearly one diagonal are a
candidate.  The template is then aligned with the text around it in a band about that diagonal: matches score 1, other
words and gaps cost a half.  Reported are the matched words, their share of the template (coverage) and the span; of
templates that match the same span, the one with the most matched words, then the largest coverage (all of them if equal).
A notice of at most ``SHORT`` words must hold just the template's deciding words (license names, ``nc``, ``sharealike``, versions, ...), so a
short template doesn't take the license beside it.

The set: short notices, headers or conditions of the licenses in ``TEMPLATES``, the ``CC-BY`` family in versions 3.0 and
4.0, ``SPDX-License-Identifier`` lines of the identifiers in ``SPDX_IDS``, and "All rights reserved".

The index holds templates only, a bounded parameter, and travels with the tasks; texts are read once, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import texts_of

GRAM, WINDOW, BAND, COVERAGE, SHORT = 3, 2, 6, 0.8, 16
WORD = re.compile(r"[^\W_]+")

# Common license notices, each under its SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "All-rights-reserved": "All rights reserved.",
    "BSD-2-Clause-notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "Licensed under CC0 1.0 Universal.",
    "CC0-1.0-dedication": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/"),
    "EPL-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later "
        "version."),
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version."),
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software."),
}
for _id, _words in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
                    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
                    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items():
    for _version, _where in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES.setdefault(f"CC-{_id}-{_version}-notice", f"Licensed under CC {_id} {_version}.")
        TEMPLATES.setdefault(f"CC-{_id}-{_version}-text", "This work is licensed under a Creative Commons "
                             f"{_words} {_version} {_where} License.")
del TEMPLATES["CC-BY-NC-4.0-notice"], TEMPLATES["CC-BY-4.0-text"]  # CC-BY-NC-4.0 and CC-BY-4.0 above
SPDX_IDS = ("0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 "
            "CC-BY-SA-4.0 CC-BY-NC-4.0 CC0-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only "
            "GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 Unlicense "
            "WTFPL Zlib").split()
TEMPLATES |= {f"{_id}-spdx": f"SPDX-License-Identifier: {_id}" for _id in SPDX_IDS}

# Words that tell short notices apart, besides numbers and SPDX identifiers' words.
DECIDING = frozenset("cc cc0 by nc sa nd noncommercial sharealike noderivatives lesser affero library mozilla eclipse boost "
                     "creative gnu reserved".split()) | {w.lower() for i in SPDX_IDS for w in WORD.findall(i)}


def gram_keys(ids: np.ndarray, k: int) -> np.ndarray:
    """One number for every k-gram of word numbers; -1 if it holds an unknown word."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    keys, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(k):
        part = ids[j:j + n]
        known &= part >= 0
        with np.errstate(over="ignore"):
            keys = (keys ^ (part.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(31)
    return np.where(known, (keys >> np.uint64(1)).astype(np.int64), -1)


class LicenseIndex:
    """Inverted index of the winnowed k-grams of templates."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW):
        self.gram, self.names = gram, list(templates)
        words = [[w.lower() for w in WORD.findall(t)] for t in templates.values()]
        self.vocab = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.templates = [self.numbers(ws) for ws in words]
        self.deciding = np.array([i for w, i in self.vocab.items() if w in DECIDING or w.isdigit()], np.int64)
        marks = []
        for t, ids in enumerate(self.templates):
            keys = gram_keys(ids, min(gram, len(ids)))
            for lo in range(max(1, len(keys) - window + 1)):
                part = keys[lo:lo + window]
                if len(part):
                    at = lo + int(part.argmin())
                    marks.append((int(keys[at]), t, at))
        self.marks = np.array(sorted(set(marks)), np.int64).reshape(-1, 3)

    def numbers(self, words: list[str]) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w.lower(), -1) for w in words], np.int64)

    def candidates(self, ids: np.ndarray, band: int) -> list[tuple[int, int]]:
        """(template, diagonal): the place in the text where the template would start."""
        keys = gram_keys(ids, self.gram)
        lo = np.searchsorted(self.marks[:, 0], keys, side="left")
        n = np.searchsorted(self.marks[:, 0], keys, side="right") - lo
        n[keys < 0] = 0
        hits = sorted((int(self.marks[m, 1]), int(at - self.marks[m, 2])) for at in np.flatnonzero(n)
                      for m in range(lo[at], lo[at] + n[at]))
        out: list[tuple[int, int]] = []
        for t, diagonal in hits:  # a run of near diagonals of a template is one candidate
            if not out or out[-1][0] != t or diagonal - out[-1][1] > band:
                out.append((t, diagonal))
        return out


def align(template: np.ndarray, ids: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, last place in the text): the best alignment of the whole template with the text in the band
    ``diagonal - band`` to ``diagonal + 2 * band``; words of the text before and after it are free."""
    low, width = diagonal - band, 3 * band + 1
    none = (0.0, 0, -1, -1)  # score, matches, first, last
    # Cell (i, d): template words up to i, text words up to i + low + d.
    row = [none] * (width + 1)
    for i, word in enumerate(template.tolist()):
        new = []
        for d in range(width):
            at = i + low + d
            score, matches, first, last = row[d]
            if 0 <= at < len(ids) and ids[at] == word:
                best = (score + 1, matches + 1, first if first >= 0 else at, at)
            else:
                best = (score - 0.5, matches, first, last)
            up = row[d + 1] if d + 1 < width else None  # a template word the text hasn't
            if up is not None and up[0] - 0.5 > best[0]:
                best = (up[0] - 0.5, *up[1:])
            if new and new[-1][0] - 0.5 > best[0]:  # a text word the template hasn't
                best = (new[-1][0] - 0.5, *new[-1][1:])
            new.append(best)
        row = [*new, none]
    return max(row[:width], key=lambda c: (c[0], c[1], -c[2]))[1:]


def decided(index: LicenseIndex, t: int, span: np.ndarray) -> bool:
    """Whether a short template and the text's ``span`` hold the same deciding words; long templates always."""
    own = index.templates[t]
    if len(own) > SHORT:
        return True
    a, b = (np.sort(x[np.isin(x, index.deciding)]) for x in (own, span))
    return np.array_equal(a, b)


def scan(text: str | None, index: LicenseIndex, band: int = BAND, coverage: float = COVERAGE, everywhere: bool = False) -> list[tuple]:
    """(license, coverage, matched words, start, end, first word, last word), in text order; of overlapping matches of one
    template the best, of templates that share most of a span those with the most matched words, then the largest coverage.
    ``everywhere`` aligns at every place instead of asking the index (for tests)."""
    words = WORD.findall(text) if text else []
    ids = index.numbers(words)
    found = [(t, d) for t in range(len(index.templates)) for d in range(-len(index.templates[t]), len(ids))] if everywhere \
        else index.candidates(ids, band)
    if not found:
        return []
    hits = []
    for t, diagonal in found:
        size = len(index.templates[t])
        near = set(ids[max(0, diagonal - band):max(0, diagonal + size + 2 * band)].tolist())
        if sum(w in near for w in index.templates[t].tolist()) < coverage * size:  # no alignment has more
            continue
        matched, first, last = align(index.templates[t], ids, diagonal, band)
        if size and matched >= coverage * size and decided(index, t, ids[first:last + 1]):
            hits.append((t, -matched, last - first, first, last))
    kept: list[tuple] = []
    for t, matched, _, first, last in sorted(hits):
        if not any(k[0] == t and first <= k[4] and k[3] <= last for k in kept):
            kept.append((t, -matched, 0, first, last))
    shared = lambda a, b: 2 * (min(a[4], b[4]) - max(a[3], b[3]) + 1) > min(a[4] - a[3], b[4] - b[3]) + 1
    best: list[tuple] = []
    rank = lambda k: (k[1], k[1] / len(index.templates[k[0]]))
    for hit in sorted(kept, key=rank, reverse=True):
        if not any(rank(k) > rank(hit) and shared(k, hit) for k in best):
            best.append(hit)
    kept = best
    if not kept:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return sorted(((index.names[t], n / len(index.templates[t]), n, places[a][0], places[b][1], a, b)
                   for t, n, _, a, b in kept), key=lambda r: (r[3], r[0]))


_MATCHES = ("doc_id long, license string, coverage double, matched_words int, start int, stop int, first_word int, "
            "last_word int")


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, gram: int = GRAM, window: int = WINDOW,
                    band: int = BAND, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice found: ``doc_id``, ``license``, ``coverage`` (matched share of the template's words, at least
    ``coverage``), ``matched_words``, ``start``/``stop`` (characters), ``first_word``/``last_word``.

    A match has ``gram + window - 1`` template words in a row, so up to that many differ nowhere.  Null and empty texts hold
    none; repeated rows repeat; of templates that match one span the best, equally good ones all; extra columns are ignored; an empty table
    or no templates give no rows."""
    index = LicenseIndex(TEMPLATES if templates is None else templates, gram, window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _MATCHES.split(", ")]
        for batch in batches:
            rows = [(doc, *hit) for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"])
                    for hit in scan(text, index, band, coverage)]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
    return texts_of(docs, id_col, text_col).filter(F.col("text").isNotNull()).mapInPandas(run, _MATCHES)
