"""License scans: winnowed fingerprints of templates pick candidates, banded alignment reports spans.

Templates are short public license notices. Every template's runs of `GRAM` words
are hashed and winnowed: of each window of `WINDOW` consecutive hashes the
smallest is kept, so any shared passage of `GRAM + WINDOW - 1` words shares a
fingerprint. The inverted index maps a fingerprint to (template, place); it is
made from the fixed list below and so has a fixed size. A document's own
winnowed fingerprints are looked up, hits are grouped by template and diagonal,
and every group is aligned: an edit alignment of words within `BAND` of the
diagonal, which tolerates changed, missing and added words.

A match is reported if it covers `COVERED` of the template's words. Of
overlapping matches the one with more matched words stays (ties: the earlier
one, then the template first in the list). Spans are code points, ends exclusive.

Words are compared in lower case without punctuation. Null texts count as empty
and have no match. Repeated rows get the same matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import mix, pieces, strings, texts

GRAM = 3
WINDOW = 2
BAND = 12
COVERED = 0.75
_WORD = regex.compile(r"[\p{L}\p{N}][\p{L}\p{N}.'-]*")

# Public license notices.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words(text: str) -> tuple[list[str], list[int], list[int]]:
    """Compared words of a text with their begins and ends."""
    out: tuple[list[str], list[int], list[int]] = ([], [], [])
    for m in _WORD.finditer(text):
        word = m[0].rstrip(".'-")
        out[0].append(word.lower())
        out[1].append(m.start())
        out[2].append(m.start() + len(word))
    return out


class Words:
    """Numbers of words: those of templates 1, 2, ..; any other word is 0."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = list(templates)
        self.number: dict[str, int] = {}
        self.rows = []
        for text in templates.values():
            own = words(text)[0]
            self.rows.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in own], np.int64))
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, row in enumerate(self.rows):
            for place, value in winnow(row):
                self.index[value].append((t, place))
        self.index = dict(self.index)


def grams(row: np.ndarray) -> np.ndarray:
    width = min(GRAM, len(row))
    total = np.full(max(len(row) - width + 1, 0), width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + row[i : len(row) - width + 1 + i].astype(np.uint64)
    return mix(total)


def winnow(row: np.ndarray) -> list[tuple[int, int]]:
    """Place and hash of the smallest gram of every window, the last of equal ones."""
    h = grams(row)
    if len(h) <= WINDOW:
        return [(int(i), int(h[i])) for i in ([len(h) - 1 - int(h[::-1].argmin())] if len(h) else [])]
    shifts = np.stack([h[WINDOW - 1 - i : len(h) - i] for i in range(WINDOW)])
    at = np.unique(np.arange(WINDOW - 1, len(h)) - shifts.argmin(axis=0))
    return list(zip(at.tolist(), h[at].tolist()))


def align(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """Matched words of template `a` in `b`, and their first and last place in `b`.

    A longest common sequence within `BAND` of the diagonal; of equal ones the shortest span.
    """
    width = 2 * BAND + 1
    score = [(0, 0)] * (width + 1)  # (matches, begin), by offset from the diagonal
    last = [(0, 0, 0)]
    for i, word in enumerate(a.tolist()):
        new = [(0, 0)] * (width + 1)
        for k in range(width):
            j = i + diagonal + k - BAND
            value = score[k + 1] if k + 1 < width else (0, 0)  # the template's word is missing
            if k and new[k - 1][0] > value[0] or (k and new[k - 1][0] == value[0] and new[k - 1][1] > value[1]):
                value = new[k - 1]  # an added word
            if 0 <= j < len(b) and word and b[j] == word:
                n, begin = score[k]
                hit = (n + 1, begin if n else j)
                if hit[0] > value[0] or (hit[0] == value[0] and hit[1] > value[1]):
                    value = hit
                    last.append((hit[0], hit[1], j))
            new[k] = value
        score = new
    return min(last, key=lambda x: (-x[0], x[2] - x[1], x[1]))


def matches(table: Words, text: str) -> list[tuple[str, float, int, int]]:
    """(template, coverage, start, end) of each match in a text, in order."""
    names, begins, ends = words(text)
    row = np.fromiter((table.number.get(w, 0) for w in names), np.int64, len(names))
    if not row.any():
        return []
    hits: dict[int, list[int]] = defaultdict(list)
    for at, value in winnow(row):
        for t, place in table.index.get(value, ()):
            hits[t].append(at - place)
    found = []
    for t, diagonals in hits.items():
        group: list[int] = []
        for d in sorted(diagonals) + [None]:
            if group and (d is None or d - group[0] > BAND):
                n, first, last = align(table.rows[t], row, (group[0] + group[-1]) // 2)
                if n >= COVERED * len(table.rows[t]):
                    found.append((n, first, last, t))
                group = []
            if d is not None:
                group.append(d)
    taken: list[tuple[int, int, int, int]] = []
    for m in sorted(set(found), key=lambda m: (-m[0], m[1], m[3])):
        if all(m[2] < o[1] or o[2] < m[1] for o in taken):
            taken.append(m)
    return [
        (table.names[t], n / len(table.rows[t]), begins[first], ends[last])
        for n, first, last, t in sorted(taken, key=lambda m: m[1])
    ]


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Words(receive(shared))
        for whole in batches:
            for batch in pieces(whole, "text"):
                found = [
                    [{"license": name, "coverage": share, "start": a, "end": b} for name, share, a, b in matches(table, text)]
                    for text in strings(batch.column("text"))
                ]
                kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "matches"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """`doc_id` and `matches` (license, coverage, start, end) of every document."""
    shared = send(docs.sparkSession, templates or TEMPLATES)
    return texts(docs).mapInArrow(
        _scan(shared), "doc_id long, matches array<struct<license:string,coverage:double,start:bigint,end:bigint>>"
    )


def scan_summary(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, `n_matches`, `licenses` in order, `spans` as license:start:end, `best_coverage`."""
    span = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return scan(docs).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
        F.array_join(span, ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("best_coverage"),
    )
