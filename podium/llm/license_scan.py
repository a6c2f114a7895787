"""License scans: winnowed template fingerprints, an inverted index, then banded alignment.

Every template (configuration, so of bounded size) is cut into ``K``-word
fingerprints, of which winnowing keeps the least of every ``WINDOW`` in a row;
the kept ones form an inverted index (fingerprint -> template, word).  A text's
words are hashed once, its fingerprints are looked up in that index, and the
hits of a template are chained into occurrences: hits that rise in text and
template and whose diagonals (place in the text less place in the template) lie
within the band of the one before.  Each chain is aligned: a longest common
subsequence of template and text inside a band around its diagonals.  A match
covers ``MIN_COVERAGE`` of the template's words at least.  The text left between
the matches is searched again until it gives none, where no chain gives one by
all hits of neighbouring diagonals together, in overlapping bands of two template
lengths (an occurrence that drifts by the template's length or less lies whole
in one); so of notices that repeat, however close, each is found.  A text's words
are first counted against the template's by a longest common subsequence of
bits; only what reaches the coverage is aligned.

Any ``K + WINDOW - 1`` words in a row taken over from a template share a kept
fingerprint with it.  Rows are scanned one by one where they are read: there is
no shuffle, and whole texts are scanned.

Defined results: words are compared by letters and digits, without case and
punctuation; null, empty and other texts without a match give no row; of
matches that overlap the one covering most of its template is reported (then
the one with more words, then the name); rows that repeat are reported
repeatedly; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import textkernel as tk
from podium.llm.common import mapped, table

K, WINDOW = 3, 2
#: words the alignment may leave the diagonals by
BAND = 6
MIN_COVERAGE = 0.75

#: Template texts by license; notices and the core of the full texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("all-rights-reserved", "All rights reserved."),
)


@dataclass
class Index:
    """Fingerprints (sorted) of all templates with the template and word each stands for, and the templates' words."""

    fingerprint: np.ndarray
    template: np.ndarray
    at: np.ndarray
    names: list[str]
    words: list[np.ndarray]
    masks: list[dict[int, int]]


def winnow(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places kept: the rightmost least of every ``window`` fingerprints in a row."""
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.empty(0, np.int64)
    v = np.lib.stride_tricks.sliding_window_view(h, window)
    return np.unique(np.arange(len(v)) + window - 1 - np.argmin(v[:, ::-1], axis=1))


def build_index(templates=TEMPLATES) -> Index:
    names, words, parts = [], [], []
    for i, (name, text) in enumerate(templates):
        (w,) = tk.words(pa.array([text]), plain=True)
        h, at = w.shingles(min(K, len(w.hash)))
        kept = winnow(h)
        names.append(name)
        words.append(w.hash)
        parts.append((h[kept], np.full(len(kept), i), at[kept]))
    f, t, at = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(f, kind="stable")
    return Index(f[order], t[order], at[order], names, words, [word_mask(x) for x in words])


def word_mask(words: np.ndarray) -> dict[int, int]:
    """Bits of the places where each word stands."""
    out: dict[int, int] = {}
    for i, x in enumerate(words.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


def in_common(mask: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence of the masked words and ``text``."""
    s = full = (1 << size) - 1
    for x in text:
        m = mask.get(x)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return size - s.bit_count()


def banded_lcs(a: np.ndarray, b: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Matched pairs (place in a, place in b) of a longest common subsequence with ``low <= j - i <= high``."""
    width = high - low + 1
    score = np.zeros((len(a) + 1, width + 1), np.int32)  # column j - i - low of row i; one more to the right stays 0
    for i in range(1, len(a) + 1):
        row, up = score[i], score[i - 1]
        for c in range(width):
            j = i + c + low
            if j < 1 or j > len(b):
                row[c] = row[c - 1] if c and j > len(b) else 0
                continue
            best = up[c + 1] if c + 1 < width else 0  # (i - 1, j)
            if c and row[c - 1] > best:  # (i, j - 1)
                best = row[c - 1]
            if a[i - 1] == b[j - 1] and up[c] + 1 > best:  # (i - 1, j - 1)
                best = up[c] + 1
            row[c] = best
    i = len(a)
    c = int(np.argmax(score[i, :width]))
    pairs = []
    while i > 0:
        j = i + c + low
        here = score[i, c]
        if here == 0:
            break
        if 1 <= j <= len(b) and a[i - 1] == b[j - 1] and score[i - 1, c] + 1 == here:
            pairs.append((i - 1, j - 1))
            i -= 1
        elif c and score[i, c - 1] == here:
            c -= 1
        else:
            i, c = i - 1, min(c + 1, width)
            if c == width:
                c = width - 1
    return pairs[::-1]


def chains(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Lowest and highest diagonal of each occurrence; ``places`` (in the text, in the template) are sorted.

    A hit follows the chain of the nearest diagonal (the later of two) that it rises from; a chain's
    hits rise in the template, so it is never longer than that, however many hits there are.
    """
    out: list[list[int]] = []  # place in the text and the template of the last hit, lowest and highest diagonal
    ends: dict[int, int] = {}  # diagonal of a chain's last hit -> latest such chain
    for at, where in places:
        d = at - where
        near = [
            (abs(e - d), -c, c)
            for e in range(d - BAND, d + BAND + 1)
            if (c := ends.get(e)) is not None and out[c][0] < at and out[c][1] < where
        ]
        if near:
            c = min(near)[2]
            last = out[c][0] - out[c][1]
            if last != d:
                del ends[last]
            out[c] = [at, where, min(out[c][2], d), max(out[c][3], d)]
        else:
            c = len(out)
            out.append([at, where, d, d])
        ends[d] = c
    return [(x[2], x[3]) for x in out]


def diagonals(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Lowest and highest diagonal of each group whose diagonals lie within the band of the one before."""
    out: list[tuple[int, int]] = []
    for d in sorted({at - where for at, where in places}):
        if out and d - out[-1][1] <= BAND:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def cut(bands: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """The bands, those wider than ``2 * size`` in pieces of that width that overlap by ``size``."""
    return [(x, min(high, x + 2 * size)) for low, high in bands for x in range(low, max(low + 1, high - size), size)]


def matches(words: np.ndarray, hits: list[tuple[int, int, int]], index: Index) -> list[tuple[float, int, int, int, int]]:
    """(coverage, words matched, template, first word, last word) of the aligned candidates of one text.

    ``hits``: (template, place in the text, place in the template).
    """
    found = []
    by_template: dict[int, list[tuple[int, int]]] = {}
    for t, at, where in hits:
        by_template.setdefault(t, []).append((at, where))
    for t, places in by_template.items():
        template = index.words[t]

        def align(begin: int, end: int, bands: Iterable[tuple[int, int]]) -> list[tuple[float, int, int, int, int]]:
            out = []
            for low, high in bands:
                first = max(begin, low - BAND)
                part = words[first : max(first, min(end, high + BAND + len(template)))]
                if in_common(index.masks[t], len(template), part.tolist()) < MIN_COVERAGE * len(template):
                    continue  # a band holds no longer a subsequence
                pairs = banded_lcs(template, part, low - BAND - first, high + BAND - first)
                if pairs and len(pairs) >= MIN_COVERAGE * len(template):
                    out.append((len(pairs) / len(template), len(pairs), t, first + pairs[0][1], first + pairs[-1][1]))
            return out

        rest = [(0, len(words), sorted(places))]
        while rest:
            begin, end, some = rest.pop()
            one_by_one = dict.fromkeys(chains(some))
            got = align(begin, end, one_by_one) or align(begin, end, [x for x in cut(diagonals(some), len(template)) if x not in one_by_one])
            if not got:
                continue
            found += got
            # the text between the matches that stand
            edge = 0
            for _, _, _, first, last in [*best_of(list(dict.fromkeys(got)), index), (0, 0, t, end, end)]:
                at = edge
                while at < len(some) and some[at][0] < first:
                    at += 1
                if at > edge:
                    rest.append((begin, first, some[edge:at]))
                begin, edge = last + 1, at
                while edge < len(some) and some[edge][0] < begin:
                    edge += 1
    return found


def best_of(found: list[tuple[float, int, int, int, int]], index: Index) -> list[tuple[float, int, int, int, int]]:
    """Of overlapping matches the one covering most of its template, then the one with more words."""
    out: list[tuple[float, int, int, int, int]] = []  # by place, as they do not overlap
    for x in sorted(found, key=lambda x: (-x[0], -x[1], index.names[x[2]], x[3])):
        i = bisect(out, x[3], key=lambda y: y[3])
        if (i == 0 or out[i - 1][4] < x[3]) and (i == len(out) or x[4] < out[i][3]):
            out.insert(i, x)
    return out


def scan(docs: DataFrame, templates=TEMPLATES, key: str = "doc_id") -> DataFrame:
    """doc_id, license, coverage, n_words and the span [start, end) in characters, one row per match."""
    index = build_index(templates)
    schema = "doc_id long, license string, coverage double, n_words long, start long, end long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            ids = b.column(0)
            for w in tk.words(b.column(1), plain=True):
                h, at = w.shingles(K)
                slot = np.searchsorted(index.fingerprint, h)
                hit = np.flatnonzero((slot < len(index.fingerprint)) & (index.fingerprint[np.minimum(slot, len(index.fingerprint) - 1)] == h))
                if not len(hit):
                    continue
                row = np.searchsorted(w.first, at[hit], "right") - 1
                by_row: dict[int, list[tuple[int, int, int]]] = {}
                for r, i in zip(row.tolist(), hit.tolist()):
                    s = int(slot[i])
                    while s < len(index.fingerprint) and index.fingerprint[s] == h[i]:
                        by_row.setdefault(r, []).append((int(index.template[s]), int(at[i] - w.first[r]), int(index.at[s])))
                        s += 1
                for r, hits in by_row.items():
                    text = w.hash[w.first[r] : w.first[r + 1]]
                    for cover, n, t, first, last in best_of(matches(text, hits, index), index):
                        a, z = int(w.start[w.first[r] + first]), int(w.end[w.first[r] + last])
                        begin = int(w.row_at[r])
                        # characters are counted by the bytes that begin one
                        start = int(((w.data[begin:a] & 0xC0) != 0x80).sum())
                        size = int(((w.data[a:z] & 0xC0) != 0x80).sum())
                        rows.append((ids[w.row0 + r].as_py(), index.names[t], cover, n, start, start + size))
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "license", "coverage", "n_words", "start", "end"])

    return mapped(docs.select(F.col(key).cast("long"), "text"), run, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
