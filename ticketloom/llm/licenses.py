"""License scan: winnowed template fingerprints, then banded alignment.

Templates are winnowed: of every ``GUARD`` consecutive k-grams of words the one with the smallest
hash is a fingerprint, kept in an inverted index (fingerprint -> templates and places).  Every
k-gram of every document is looked up; hits name candidate templates and diagonals.  Around each
diagonal a banded local alignment of the words finds how much of the template the document holds,
and where.  Words that tell licenses apart (names, variants, versions) must align, whatever the
coverage: none of the template's may be missing and none of the text's may stand between.  Template
lists are small and go to the tasks whole; documents are only scanned.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm.common import documents, narrow_input, prepare

GRAM, GUARD, BAND, COVERAGE = 3, 4, 8, 0.8

# Public license notices, by SPDX identifier where there is one.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-1.1-notice": "Licensed under the Apache License, Version 1.1.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                   "General Public License as published by the Free Software Foundation",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                   "General Public License as published by the Free Software Foundation",
    "LGPL-2.0-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                       "Library General Public License as published by the Free Software Foundation",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "BSD-header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
                       "License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
                       "License.",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "all-rights-reserved": "All rights reserved.",
}
# Words, or parts of hyphenated ones, that tell licenses apart.
TELLING = frozenset((
    "mit", "bsd", "isc", "apache", "mozilla", "gnu", "gpl", "lgpl", "agpl", "mpl", "cc", "by", "nc", "sa", "nd", "cc0",
    "lesser", "affero", "attribution", "noncommercial", "sharealike", "noderivatives", "noderivs"))
EDGE = b".,;:!?()[]{}<>\"'`*#$%&|~"
MARKS = frozenset(w.encode() for w in TELLING)
VERSION = re.compile(rb"(v?)(\d+)((?:\.\d+)*)")
FIRST = frozenset(bytes([c]) for c in b"v0123456789")


def words(data: bytes) -> list[bytes]:
    """Lower-case words without punctuation around them; one made of punctuation alone is empty
    but keeps its place.  Versions are written alike: ``v2``, ``version 2`` and ``2.0`` as ``2.0``."""
    out = [w.strip(EDGE) for w in data.lower().split()]
    for k in [k for k, w in enumerate(out) if w[:1] in FIRST and w]:
        number = VERSION.fullmatch(out[k])
        if number and (number[1] or number[3] or (k and out[k - 1] in (b"version", b"v"))):
            rest = re.sub(rb"(\.0)+$", b"", number[3])
            out[k] = number[2] + (rest or b".0")
    return out


def telling(line: list[bytes], first: int = 0, end: int | None = None) -> set[int]:
    """Places in ``[first, end)`` of words that tell licenses apart: names, variants and versions.  "by" does so
    only in a hyphenated word or after "cc", "library" only after "gnu"."""
    found = set()
    for k in range(first, len(line) if end is None else end):
        parts, before = line[k].split(b"-"), line[k - 1] if k else b""
        word = line[k]
        if word in (b"by", b"library"):
            if before == (b"cc" if word == b"by" else b"gnu"):
                found.add(k)
        elif any(p in MARKS for p in parts) or (VERSION.fullmatch(word) and b"." in word):
            found.add(k)
    return found


class Index:
    """Inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, guard: int = GUARD):
        self.gram, self.names = gram, sorted(templates)
        self.texts = [[w for w in words(templates[n].encode()) if w] for n in self.names]
        self.telling = [telling(t) for t in self.texts]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, text in enumerate(self.texts):
            grams = [b" ".join(text[k:k + gram]) for k in range(max(1, len(text) - gram + 1))]
            hashes = [(xxhash.xxh3_64_intdigest(g), k) for k, g in enumerate(grams)]
            chosen = {min(hashes[k:k + guard])[1] for k in range(max(1, len(hashes) - guard + 1))}
            for k in chosen:
                self.postings.setdefault(grams[k], []).append((t, k))
        self.openers = frozenset(g.split(b" ")[0] for g in self.postings)
        self.short = {g for g in self.postings if g.count(b" ") < gram - 1}      # templates under one gram

    def hits(self, text: list[bytes]) -> dict[int, list[int]]:
        """Template -> diagonals (place in the text less place in the template) of its hits."""
        found: dict[int, list[int]] = {}
        for place in [k for k, w in enumerate(text) if w in self.openers]:
            for size in {self.gram, *(g.count(b" ") + 1 for g in self.short)}:
                for t, at in self.postings.get(b" ".join(text[place:place + size]), ()):
                    found.setdefault(t, []).append(place - at)
        return found


def align(template: list[bytes], text: list[bytes], diagonal: int, band: int) -> tuple[int, int, int, list]:
    """Best local alignment within ``band`` of the diagonal: matched words, first and last+1 place, and the
    places ``(in the template, in the text)`` of the matched words."""
    best, last = (0, 0, 0, 0, None), {}
    for i, word in enumerate(template):
        row = {}
        for j in range(max(0, i + diagonal - band), min(len(text), i + diagonal + band + 1)):
            same = text[j] == word
            score, matched, start, trail = last.get(j - 1, (0, 0, j, None))
            if score <= 0:
                score, matched, start, trail = 0, 0, j, None
            cell = (score + 2, matched + 1, start, (i, j, trail)) if same else (score - 1, matched, start, trail)
            for other in (last.get(j), row.get(j - 1)):
                if other and other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, *other[1:])
            row[j] = cell
            if same and cell[:2] > best[:2]:
                best = (cell[0], cell[1], cell[2], j + 1, cell[3])
        last = row
    pairs, trail = [], best[4]
    while trail:
        pairs.append(trail[:2])
        trail = trail[2]
    return best[1], best[2], best[3], pairs[::-1]


def scan(index: Index, text: str, band: int = BAND, coverage: float = COVERAGE) -> list[tuple]:
    """``(license, matched, template_words, first, last + 1)`` in the order of the places; of
    matches that overlap by half or more the one with more matched words, then coverage, stays.
    A match that leaves a telling word of either side unaligned is none."""
    every = words(text.encode())
    places = [k for k, w in enumerate(every) if w]
    line = [every[k] for k in places]
    found = []
    for t, diagonals in index.hits(line).items():
        template, done = index.texts[t], None
        width = min(band, max(1, len(template) // 4))        # a short line's next occurrence may be near
        for d in sorted(set(diagonals)):
            if done is not None and d - done <= width and found and found[-1][5] == t and found[-1][4] > d:
                continue                                     # the same occurrence, seen on a near diagonal
            matched, a, b, pairs = align(template, line, d, width)
            done = d
            if (matched and matched / len(template) >= coverage and index.telling[t] <= {i for i, _ in pairs}
                    and telling(line, a, b) <= {j for _, j in pairs}):
                found.append((index.names[t], matched, len(template), a, b, t))
    kept = []
    for one in sorted(found, key=lambda m: (-m[1], -m[1] / m[2], m[3], m[0])):
        if all(min(one[4], o[4]) - max(one[3], o[3]) < 0.5 * min(one[4] - one[3], o[4] - o[3]) for o in kept):
            kept.append(one)
    return [(m[0], m[1], m[2], places[m[3]], places[m[4] - 1] + 1) for m in sorted(kept, key=lambda m: (m[3], m[0]))]


SPAN = re.compile(rb"[^\x20\x09-\x0D]+")


def _scanned(templates, gram, guard, band, coverage):
    def run(batches):
        index = Index(templates, gram, guard)
        for batch in batches:
            out = [[] for _ in range(8)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                matches = scan(index, text, band, coverage)
                if not matches:
                    continue
                data = text.encode()
                spans = [m.span() for m in SPAN.finditer(data)]
                for name, matched, size, a, b in matches:
                    start, stop = len(data[:spans[a][0]].decode()), len(data[:spans[b - 1][1]].decode())
                    for column, value in zip(out, (doc, name, matched, matched / size, a, b, start, stop)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 4))],
                ["doc_id", "license", "matched_words", "coverage", "first_word", "end_word", "start_char", "end_char"])
    return run


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 gram: int = GRAM, guard: int = GUARD, band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """One row per match: ``doc_id, license, matched_words, coverage, first_word, end_word,
    start_char, end_char``.

    ``coverage`` is the share of the template's words that the alignment matches, at least the
    given one; places are those of white-space separated words and of code points, the end
    excluded.  Null, empty and clean texts have no rows; repeated rows and ids have each their
    own.  Extra columns are left out."""
    prepare(docs.sparkSession)
    return narrow_input(docs, id_col, text_col).mapInArrow(
        _scanned(templates or TEMPLATES, gram, guard, band, coverage),
        "doc_id bigint, license string, matched_words bigint, coverage double, first_word bigint, end_word bigint, "
        "start_char bigint, end_char bigint")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
