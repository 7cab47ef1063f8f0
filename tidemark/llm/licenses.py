"""License scans by patience alignment of texts with license templates.

Words that occur once in the text and once in the template are anchors; the
longest increasing subsequence of their places keeps those in order, and the
gaps between kept anchors are aligned in the same way, where further words have
become unique.  A template is found if the words so aligned, in the densest
stretch of the text, cover at least ``min_coverage`` of it.  Where copies stand
so close together that words are not unique, the tightest stretch with the
longest chain of words is searched instead.

A license has several texts (notices, short forms, its whole body); it is found
by the one that aligns best.  Words that tell licenses with like texts apart
(version, kind) must stand in the stretch, and of the licenses of one family
only the better one is reported for a stretch.

Only words of the templates matter to the alignment, so a text is first reduced
to the places of such words; a template is tried only if enough of its words
occur at all, which no text that reaches the coverage fails.

Defined cases: null and empty texts hold no license; a license found twice in
a text is reported once, at its best stretch; repeated rows are reported each;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Notices as their licenses give them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met: Redistributions of source code must retain the above copyright "
           "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
           "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution.",
}
# Further texts of a license: notices as their licenses give them, and usual short forms.
VARIANTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    *((name, f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} "
             f"Public License as published by the Free Software Foundation; either version {version} of the License, or "
             "(at your option) any later version.")
      for name, kind, version in (
          ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.0", "Library General", "2"),
          ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))
      for thing in ("program", "library")),
    *((name, f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} "
             f"Public License as published by the Free Software Foundation, version {version}.")
      for name, kind, version in (
          ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
          ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))),
    *((name, f"{lead} licensed under the GNU {kind} Public License{version}")
      for name, kind, number in (
          ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
          ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))
      for lead in ("This work is", "") for version in (f", version {number}.", f" v{number}.")),
    ("AGPL-3.0", "Notwithstanding any other provision of this License, if you modify the Program, your modified version must "
                 "prominently offer all users interacting with it remotely through a computer network (if your version "
                 "supports such interaction) an opportunity to receive the Corresponding Source of your version by "
                 "providing access to the Corresponding Source from a network server at no charge, through some standard "
                 "or customary means of facilitating copying of software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights "
                "to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
                 "Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
    *((f"CC-{tag}-4.0", text) for tag, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
      for text in (f"This work is licensed under a Creative Commons {name} 4.0 International License.",
                   f"Licensed under CC {tag} 4.0.")),
    *((name, f"{lead} under the {short} License.")
      for name, short in (("MIT-notice", "MIT"), ("ISC", "ISC"), ("Apache-2.0", "Apache 2.0"), ("MPL-2.0", "Mozilla Public 2.0"))
      for lead in ("Released", "Licensed", "Distributed")),
    *((name, f"SPDX-License-Identifier: {tag}")
      for name, tags in {"Apache-2.0": "Apache-2.0", "MIT-notice": "MIT", "ISC": "ISC", "MPL-2.0": "MPL-2.0",
                         "BSD": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "Unlicense": "Unlicense",
                         **{f"CC-{t}-4.0": f"CC-{t}-4.0" for t in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
                         **{n: f"{n} {n}-only {n}-or-later" for n in (
                             "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GFDL-1.3")}}.items()
      for tag in tags.split()),
]
# Words that tell a license from its likes: those that a text of it has must stand in the stretch found.
TELLING = {
    "Apache-2.0": "apache 2.0", "MIT-notice": "mit", "ISC": "isc", "MPL-2.0": "mozilla 2.0", "BSD-3-Clause": "neither endorse",
    "GPL-2.0": "licensed gnu 2 v2", "GPL-3.0": "licensed gnu 3 v3 incompatible", "LGPL-2.0": "library 2", "LGPL-2.1": "licensed lesser 2.1 v2.1",
    "LGPL-3.0": "licensed lesser 3 v3", "AGPL-3.0": "licensed affero 3 v3 remotely", "CC0-1.0": "cc0", "GFDL-1.3": "documentation 1.3",
    "CC-BY-4.0": "by attribution 4.0", "CC-BY-SA-4.0": "by-sa attribution-sharealike 4.0",
    "CC-BY-NC-4.0": "by-nc attribution-noncommercial 4.0", "CC-BY-ND-4.0": "by-nd attribution-noderivatives 4.0",
    "CC-BY-NC-SA-4.0": "by-nc-sa attribution-noncommercial-sharealike 4.0",
    "CC-BY-NC-ND-4.0": "by-nc-nd attribution-noncommercial-noderivatives 4.0",
}
# Licenses with texts so alike that of overlapping stretches only the better aligned one is meant.
FAMILY = {name: "gnu" if "GPL" in name else "cc" for name in TELLING if "GPL" in name or name.startswith("CC-")}


@cache
def bodies() -> list[tuple[str, str]]:
    """Whole licenses, as their publishers give them (``license_texts``)."""
    folder = files("tidemark.llm").joinpath("license_texts")
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


MIN_COVERAGE = 0.8
MAX_STRETCH = 2.0       # words of the text that may hold the alignment, in template lengths
SHORT = 256             # words up to which a template found is searched for a still better stretch
_WORD = regex.compile(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*")


def license_words(text: str) -> list[str]:
    """Words as compared: lower case, without punctuation around them."""
    return _WORD.findall(text.lower())


def longest_increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence (patience piles with back pointers)."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for i, x in enumerate(places):
        pile = bisect_left(tops, x)
        back.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(x)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = x, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience_align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places (in a, in b) of equal words, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:       # equal ends need no anchor
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: i for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and in_b.get(w) == 1}
        pairs = [(at[w], j) for j, w in enumerate(b[b0:b1], b0) if w in at]
        kept = [pairs[k] for k in longest_increasing([i for i, _ in pairs])]
        if not kept:
            continue
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def tight_stretch(group: list[tuple[int, str]], template: list[str], width: int, price: int) -> tuple[int, int, int]:
    """Most words aligned in a stretch of at most ``width`` words, and the stretch, where words are too repeated for anchors.

    Piles as in ``longest_increasing``, one per place of the template, keep the chain that is best by
    price * words + first place: a word less is worth ``price`` words of width, so that a chain does not
    reach back from one copy of the template into another.
    """
    where: dict[str, list[int]] = {}
    for j, w in enumerate(template, 1):
        where.setdefault(w, []).append(j)
    at = {w: np.array(js) for w, js in where.items()}
    top = np.full(len(template) + 1, -1, np.int64)          # (price * words + first) << 32 | first, running maximum
    best = (0, 0, 0)
    for i, w in group:
        js = at[w]
        value = np.maximum(top[js - 1], (i << 32) | i) + (price << 32)
        first = value & 0xFFFFFFFF
        n = ((value >> 32) - first) // price
        n[i - first >= width] = 0
        k = int((n * (1 << 32) + first).argmax())
        best = max(best, (int(n[k]), int(first[k]), i + 1), key=lambda x: (x[0], x[1] - x[2]))
        top[js] = np.maximum(top[js], value)
        np.maximum.accumulate(top, out=top)
    return best


class Scanner:
    """Templates, prepared: a text of each license, further ``variants``, and the words that tell a license."""

    def __init__(self, templates: dict[str, str], min_coverage: float, max_stretch: float,
                 variants: list[tuple[str, str]] = (), telling: dict[str, str] | None = None,
                 family: dict[str, str] | None = None):
        self.min_coverage, self.max_stretch, self.family = min_coverage, max_stretch, family or {}
        self.templates = []
        for name, text in dict.fromkeys([*templates.items(), *variants]):
            words = license_words(text)
            own = Counter(words)
            self.templates.append((name, words, own, own.keys() & set((telling or {}).get(name, "").split())))
        self.vocabulary = {w for _, words, _, _ in self.templates for w in words}

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, word after the last) of each license found."""
        if not text:
            return []
        known = self.vocabulary
        places = [(i, w) for i, w in enumerate(license_words(text)) if w in known]
        present = Counter(w for _, w in places)
        hits = []
        for name, template, own, telling in self.templates:
            need = self.min_coverage * len(template)
            if (len(places) < need or not telling <= present.keys()
                    or sum(min(n, present[w]) for w, n in own.items()) < need):
                continue
            for group in self._groups(places, own, len(template)):
                n, first, end = self._at(group, template)
                if n and n >= need and telling <= {w for i, w in group if first <= i < end}:
                    hits.append((2 * n - len(template), name, n / len(template), first, end))
        # Words aligned less words missed: of several texts of a license, and of licenses alike, the one meant.
        best: dict[str, tuple] = {}
        for hit in hits:
            score, name, _, first, end = hit
            beaten = name in self.family and any(
                s > score and other != name and self.family.get(other) == self.family[name] and a < end and first < b
                for s, other, _, a, b in hits)
            if not beaten and (name not in best or (score, -first) > (best[name][0], -best[name][3])):
                best[name] = hit
        return [hit[1:] for hit in best.values()]

    def _groups(self, places, own, n) -> Iterator[list[tuple[int, str]]]:
        """Stretches of the text that hold enough of the template's words, each with its surroundings."""
        mine = [(i, w) for i, w in places if w in own]
        width, need, low, last = int(self.max_stretch * n), self.min_coverage * n, 0, -1
        start, held, overlap = None, Counter(), 0           # overlap: words held, each as often as the template has it
        for high, (i, w) in enumerate(mine):
            held[w] += 1
            overlap += held[w] <= own[w]
            while i - mine[low][0] >= width:
                out = mine[low][1]
                overlap -= held[out] <= own[out]
                held[out] -= 1
                low += 1
            if overlap >= need:
                if start is None or low > last:
                    if start is not None:
                        yield mine[start:last + 1]
                    start = low
                last = high
        if start is not None:
            yield mine[start:last + 1]

    def _at(self, group, template) -> tuple[int, int, int]:
        """Most words aligned within a stretch of allowed width, and that stretch."""
        pairs = patience_align([w for _, w in group], template)
        at = [group[i][0] for i, _ in pairs]
        best, low = (0, 0, 0), 0
        for high, x in enumerate(at):
            while x - at[low] >= self.max_stretch * len(template):
                low += 1
            if high - low + 1 > best[0]:
                best = (high - low + 1, at[low], x + 1)
        held = Counter(w for _, w in group)
        bound = sum(min(n, held[w]) for w, n in Counter(template).items())
        width = int(self.max_stretch * len(template))
        enough = bound if len(template) <= SHORT else self.min_coverage * len(template)
        for price in (width, width // 4, 8, 2):
            if best[0] >= enough:
                break
            best = max(best, tight_stretch(group, template, width, max(2, price)), key=lambda x: (x[0], x[1] - x[2]))
        return best


def scan_licenses(docs: DataFrame, *, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text",
                  min_coverage: float = MIN_COVERAGE, max_stretch: float = MAX_STRETCH) -> DataFrame:
    """A row (key, license, coverage, first_word, end_word) for each license found in each text."""
    scanner = (Scanner(templates, min_coverage, max_stretch) if templates else
               Scanner(TEMPLATES, min_coverage, max_stretch, [*VARIANTS, *bodies()], TELLING, FAMILY))
    schema = T.StructType([docs.schema[key], T.StructField("license", T.StringType()),
                           T.StructField("coverage", T.DoubleType()), T.StructField("first_word", T.LongType()),
                           T.StructField("end_word", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *hit) for i, t in enumerate(batch.column(1)) for hit in scanner.scan(t.as_py())]
            at, name, coverage, first, end = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(name, pa.string()),
                pa.array(coverage, pa.float64()), pa.array(first, pa.int64()), pa.array(end, pa.int64())],
                names=[key, "license", "coverage", "first_word", "end_word"])
    return docs.select(key, text).mapInArrow(work, schema)
