"""License scans: winnowed fingerprints pick candidates, banded alignment reports what is matched.

Templates are cut into words; of every ``GRAMS``-word run hashed to a number, the smallest of each window of
``PICKS`` runs is kept in an inverted index (gram to template and place). All runs of a document are looked up
there, so any passage of GRAMS + PICKS - 1 words in common with a template is found. Hits near one diagonal of
a template form a candidate, which is aligned word by word within ``BAND`` of that diagonal; ``coverage`` is the
share of the template's words that the alignment matches. Matches of at least ``least`` coverage are reported; of
overlapping ones the one with more matched words wins.

Defined results: null and empty text has no match; repeated passages are reported each; spans are code point
offsets, end exclusive; null or repeated ids are rows like others; an empty table gives an empty result; other
columns are ignored. Templates without a word are ignored.

The index grows with the templates only, which are a parameter, and travels with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", re.A)
GRAMS = 3
PICKS = 3
BAND = 6
LEAST = 0.6

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
# Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD": _BSD,
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": _MIT,
    "MIT-line": "Released under the MIT License.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
}


def mixed(keys: np.ndarray) -> np.ndarray:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def winnow(hashes: np.ndarray, picks: int = PICKS) -> list[int]:
    """Places of the smallest hash of each window, the rightmost of equal ones."""
    n = len(hashes)
    if n <= picks:
        return [n - 1 - int(np.argmin(hashes[::-1]))] if n else []
    return sorted({s + picks - 1 - int(np.argmin(hashes[s : s + picks][::-1])) for s in range(n - picks + 1)})


class Index:
    """Words, texts and winnowed fingerprints of the templates."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        split = [TOKEN.findall(templates[n].lower()) for n in self.names]
        self.words = {w: i for i, w in enumerate(sorted({w for t in split for w in t}))}
        self.base = len(self.words) + 1
        self.texts = [np.array([self.words[w] for w in t], dtype=np.int64) for t in split]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for k, text in enumerate(self.texts):
            grams = self.grams(text)
            for place in winnow(mixed(grams)):
                self.places.setdefault(int(grams[place]), []).append((k, place))
        self.keys = np.array(sorted(self.places), dtype=np.int64)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """One number per run of GRAMS words (of all words where there are fewer), -1 with an unknown word."""
        width = min(GRAMS, len(ids))
        if not width:
            return np.zeros(0, dtype=np.int64)
        n = len(ids) - width + 1
        out, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for k in range(width):
            out = out * self.base + ids[k : k + n] + 1
            known &= ids[k : k + n] >= 0
        return np.where(known, out, -1)

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) pairs, hits within BAND of each other as one."""
        grams = self.grams(ids)
        hits = np.flatnonzero((grams >= 0) & np.isin(grams, self.keys)) if len(grams) else []
        found: dict[int, list[int]] = {}
        for at in hits:
            for k, place in self.places[int(grams[at])]:
                found.setdefault(k, []).append(int(at) - place)
        out = []
        for k, diagonals in found.items():
            last = None
            for d in sorted(diagonals):
                if last is None or d - last > BAND:
                    out.append((k, d))
                    last = d
        return out

    def align(self, ids: np.ndarray, k: int, diagonal: int) -> tuple[int, int, int] | None:
        """Matched template words and the first and last word of the document in the best banded alignment."""
        text = self.texts[k]
        width = 2 * BAND + 1
        none = (0, -1, -1)
        above = [none] * (width + 1)
        for i, word in enumerate(text.tolist()):
            row = []
            for b in range(width):
                j = i + diagonal - BAND + b
                best = above[b + 1]  # the template's word is missing
                if b and row[b - 1][0] > best[0]:
                    best = row[b - 1]  # the document's word is extra
                if 0 <= j < len(ids) and ids[j] == word:
                    score, first, _ = above[b]
                    if score + 1 > best[0]:
                        best = (score + 1, j if first < 0 else first, j)
                row.append(best)
            above = [*row, none]
        best = max(above, key=lambda x: x[0])
        return best if best[0] else None


def matches(text: str, index: Index, least: float = LEAST) -> list[tuple[int, int, str, float, int]]:
    """(start, end, template, coverage, matched words) of every reported match, in order."""
    lower = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    tokens = TOKEN.findall(lower)
    get = index.words.get
    ids = np.fromiter((get(t, -1) for t in tokens), dtype=np.int64, count=len(tokens))
    found = []
    for k, diagonal in index.candidates(ids):
        best = index.align(ids, k, diagonal)
        if best and best[0] >= least * len(index.texts[k]):
            found.append((best[0], best[0] / len(index.texts[k]), -best[1], best[2], index.names[k]))
    if not found:
        return []
    spans = [m.span() for m in TOKEN.finditer(lower)]
    taken, out = [], []
    for n, coverage, first, last, name in sorted(found, reverse=True):
        if all(last < a or b < -first for a, b in taken):
            taken.append((-first, last))
            out.append((spans[-first][0], spans[last][1], name, coverage, n))
    return sorted(out)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Per document: n_matches, the licenses found, the best coverage, and license:start:end spans."""
    index = Index({k: v for k, v in templates.items() if TOKEN.search(v.lower())})
    names = ["doc_id", "n_matches", "licenses", "coverage", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matches(t or "", index, least) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(m) for m in found], pa.int64()),
                    pa.array([",".join(sorted({x[2] for x in m})) for m in found], pa.string()),
                    pa.array([max((x[3] for x in m), default=0.0) for m in found], pa.float64()),
                    pa.array([",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in m) for m in found], pa.string()),
                ],
                names,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_matches bigint, licenses string, coverage double, spans string")
