"""License scans by patience alignment.

A text's words are aligned with a template's: words that occur once in both are anchors, the
longest increasing subsequence of their places keeps those in order, and the gaps between them are
aligned the same way; equal words at both ends of a gap match first. The coverage is the share of
the template's words that are matched; the words that name the license and its version must be
among them, with no others between, so a notice of one license is not taken for another's. A long text is searched window by window: only a window
with enough of the template's words can reach the least coverage, the fullest goes first, and what
it leaves on either side is searched again, so every copy of a notice is found.

Defined results: null and empty texts have no match; a text shorter than a template can match it in
part. Case and punctuation at the ends of words do not count. Texts of any length are read whole.
Equal texts have equal matches, repeated rows a match each. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import EDGES

LEAST_COVERAGE = 0.8

# Customary notices and short texts of licenses, by SPDX name.
_LICENSED = "This work is licensed under the "
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met"
)
_BSD_TWO = (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the"
    " above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission. "
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted, provided that the above copyright notice and this permission"
    " notice appear in all copies."
)


def _gnu(name: str, version: str) -> tuple[str, ...]:
    return (
        f"{_LICENSED}GNU {name} License, version {version}.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        f" the GNU {name} License as published by the Free Software Foundation, either"
        f" version {version} of the License, or (at your option) any later version.",
    )


def _commons(kind: str, version: str = "4.0") -> str:
    return f"This work is licensed under a Creative Commons {kind} {version} International License."


TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "GPL-3.0": _gnu("General Public", "3"),
    "GPL-2.0": _gnu("General Public", "2"),
    "LGPL-3.0": _gnu("Lesser General Public", "3"),
    "LGPL-2.1": _gnu("Lesser General Public", "2.1"),
    "AGPL-3.0": _gnu("Affero General Public", "3"),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", _commons("Attribution-NonCommercial")),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", _commons("Attribution")),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", _commons("Attribution-ShareAlike")),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", _commons("Attribution-NoDerivatives")),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", _commons("Attribution-NonCommercial-ShareAlike")),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", _commons("Attribution-NonCommercial-NoDerivatives")),
    "BSD-3-Clause": (_BSD, _BSD + _BSD_TWO + _BSD_THIRD),
    "BSD-2-Clause": (_BSD + _BSD_TWO,),
    "ISC": ("Released under the ISC License.", _ISC),
}
# What tells a license from others: where a template holds one of these (of several that overlap the
# longer), all of its words must be matched, one behind the other.
NAMES = tuple(
    f"{name} {version}".split()
    for name, versions in {
        "apache license": ("version 2.0",), "mit license": ("",), "isc license": ("",),
        "gnu general public license": ("",), "gnu lesser general public license": ("",),
        "gnu affero general public license": ("",), "version": ("2", "2.1", "3"),
        "mozilla public license": ("version 2.0", "v 2.0"), "neither the name of": ("",),
        "cc": ("by 4.0", "by-nc 4.0", "by-sa 4.0", "by-nd 4.0", "by-nc-sa 4.0", "by-nc-nd 4.0"),
        "creative commons": tuple(
            f"attribution{kind} 4.0" for kind in
            ("", "-noncommercial", "-sharealike", "-noderivatives", "-noncommercial-sharealike", "-noncommercial-noderivatives")
        ),
    }.items()
    for version in versions
)


def words_of(text: str | None) -> list[str]:
    return [w for w in (raw.strip(EDGES) for raw in text.lower().split()) if w] if text else []


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by piles of cards."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(places)
    for i, place in enumerate(places):
        at = bisect_left(tops, place)
        below[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(place)
            piles.append(i)
        else:
            tops[at], piles[at] = place, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places (in the text, in the template), in order."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a == b or c == d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        once = {w for w, n in ours.items() if n == 1 and theirs.get(w) == 1}
        if not once:
            continue
        where = {w: a + i for i, w in enumerate(text[a:b]) if w in once}
        anchors = [(where[w], c + j) for j, w in enumerate(template[c:d]) if w in once]
        anchors = [anchors[i] for i in increasing([x for x, _ in anchors])]
        matched += anchors
        for (x, y), (u, v) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            todo.append((x + 1, u, y + 1, v))
    return sorted(matched)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, words_of(text)
        self.counts = Counter(self.words)
        self.window = len(self.words) + max(4, len(self.words) // 4)
        self.names = [
            (at, name) for name in NAMES for at in range(len(self.words)) if self.words[at : at + len(name)] == name
        ]

    def named(self, pairs: list[tuple[int, int]]) -> bool:
        """Whether the words of each name are matched, one behind the other."""
        where = {t: p for p, t in pairs}
        return all(
            at in where and all(where.get(at + i) == where[at] + i for i in range(len(name))) for at, name in self.names
        )

    def matches(self, text: list[str], least: float) -> Iterator[tuple[str, float, int, int]]:
        """(name, coverage, first word, end) of every copy found, from left to right."""
        need = -(-int(least * 1000) * len(self.words) // 1000)
        inside = np.fromiter((w in self.counts for w in text), np.int64, len(text))
        full = np.concatenate(([0], np.cumsum(inside)))
        todo, out = [(0, len(text))], []
        while todo:
            a, b = todo.pop()
            if full[b] - full[a] < need:
                continue
            starts = np.arange(a, max(a + 1, b - self.window + 1))
            sums = full[np.minimum(starts + self.window, b)] - full[starts]
            best = int(sums.argmax())
            if sums[best] < need:
                continue
            start = int(starts[best])
            end = min(start + self.window, b)
            pairs = align(text[start:end], self.words)
            if len(pairs) >= need and self.named(pairs):
                spans = [(start, pairs)]
                for place in (start + pairs[0][0], start + pairs[-1][0] + 1 - self.window):
                    place = max(a, place)  # the window may have cut the copy's end or start
                    spans.append((place, align(text[place : min(b, place + self.window)], self.words)))
                start, pairs = max((s for s in spans if self.named(s[1])), key=lambda s: len(s[1]))
                first, last = start + pairs[0][0], start + pairs[-1][0] + 1
                out.append((self.name, len(pairs) / len(self.words), first, last))
                todo += [(a, first), (last, b)]
            else:  # no copy in this window: go on behind its first word, and before its end
                todo += [(a, min(start + self.window - 1, b - 1))] if start > a else []
                todo.append((start + 1, b))
        yield from sorted(set(out), key=lambda m: m[2:])


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST_COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, start, stop): the best notice at each place of each text.

    ``start`` and ``stop`` count words. Of notices that overlap the one of more matched words
    stays, the earlier template among equals.
    """
    known = [Template(name, text) for name, texts in templates.items() for text in texts]
    vocabulary = frozenset(w for t in known for w in t.counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if not text:
                    continue
                there = {raw.strip(EDGES) for raw in set(text.lower().split())} & vocabulary
                able = [t for t in known if sum(t.counts[w] for w in there) >= least * len(t.words)]
                if not able:
                    continue
                words = words_of(text)
                line = f" {' '.join(words)} "
                able = [t for t in able if all(f" {' '.join(name)} " in line for _, name in t.names)]
                found = [(m, len(t.words)) for t in able for m in t.matches(words, least)]
                taken: list[tuple[int, int]] = []
                for (name, coverage, a, b), n in sorted(found, key=lambda f: -f[0][1] * f[1]):
                    if all(b <= x or y <= a for x, y in taken):
                        taken.append((a, b))
                        rows.append((None if pd.isna(doc_id) else int(doc_id), name, coverage, a, b))
            yield pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "start", "stop"]).astype(
                {"doc_id": "Int64"}
            )

    schema = "doc_id long, license string, coverage double, start long, stop long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)
