"""10. Licence scans: MinHash bands over overlapping text windows.

Words are lower-cased runs of letters and digits (with inner ``. + -``).  A
template of n words has S = n - k + 1 shingles of k = min(5, n) words.  Each
text is cut into windows of S shingles or slightly more, a stride of at most
S / 8 apart; a window whose MinHash agrees with the template's in all rows of
some band retrieves the template.  The number of bands follows from the least
Jaccard similarity that a window over a passage of containment ``LEAST`` can
have, so that such a window collides with probability ``SURE`` or more.
Retrieved windows, widened by a stride at either end, are then verified: the
exact share of the template's shingles in them must be at least ``LEAST``.
Verified windows of a template that overlap are one match.

A text is scanned whole, in one pass without a shuffle; the templates are a
fixed list.  Cases: null, empty and word-free texts have no match; texts
shorter than a template can still contain it to ``LEAST``; repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import map_texts, mix64, shingle_hashes, table

SHINGLE = 5
LEAST = 0.8
SURE = 0.999
ROWS = 2

#: Public licence notices (id, text).
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
     "(at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_WORD = re.compile(r"[^\W_]+(?:[.+-]+[^\W_]+)*")


def words_of(text: str | None) -> list[bytes]:
    return [w.encode() for w in _WORD.findall((text or "").lower())]


def least_jaccard(shingles: int, stride: int, width: int) -> float:
    """Least similarity of the nearest window over a passage of containment ``LEAST``.

    A window of ``width`` shingles misses half a stride of the passage at most.
    """
    held = (math.ceil(LEAST * shingles) - stride // 2) / shingles
    return held / (1 + width / shingles - held)


def bands_for(jaccard: float, rows: int = ROWS, sure: float = SURE) -> int:
    """Bands of ``rows`` that collide with probability ``sure`` at a similarity."""
    return 1 if jaccard >= 1 else math.ceil(math.log(1 - sure) / math.log(1 - jaccard ** rows))


@dataclass
class Class:
    """Templates of one number of words: they share windows and bands."""

    k: int
    shingles: int
    stride: int
    width: int                           # of a window: a multiple of the stride
    bands: int
    odd: np.ndarray                      # multipliers, one a hash function
    names: list[str]
    sets: list[np.ndarray]               # sorted shingle hashes of each template
    keys: list[np.ndarray]               # band keys of each template


def _min_rows(h: np.ndarray, odd: np.ndarray, stride: int, blocks: int, windows: int) -> np.ndarray:
    """Least hash of each of ``windows`` runs of ``blocks`` strides, one row a hash function."""
    g = (h >> np.uint64(32)).astype(np.uint32)[None, :] * odd[:, None]
    need = (windows - 1 + blocks) * stride
    if need > g.shape[1]:
        g = np.pad(g, ((0, 0), (0, need - g.shape[1])), constant_values=np.iinfo(np.uint32).max)
    least = g[:, 0:need:stride]
    for k in range(1, stride):
        least = np.minimum(least, g[:, k:need:stride])
    done = 1
    while done < blocks:
        step = min(done, blocks - done)
        least = np.minimum(least[:, :-step], least[:, step:])
        done += step
    return least


def _band_keys(rows: np.ndarray) -> np.ndarray:
    """bands x windows; a key of the ROWS hash values of each band."""
    key = rows[0::ROWS].astype(np.uint64)
    for r in range(1, ROWS):
        key = (key << np.uint64(32 // (ROWS - 1))) ^ rows[r::ROWS]
    return key


def classes(templates: Sequence[tuple[str, str]] = TEMPLATES, size: int = SHINGLE) -> list[Class]:
    by: dict[int, list[tuple[str, list[bytes]]]] = {}
    for name, text in templates:
        words = words_of(text)
        by.setdefault(len(words), []).append((name, words))
    out = []
    for n, group in sorted(by.items()):
        k = min(size, n)
        shingles = n - k + 1
        stride = max(1, shingles // 8)
        width = -(-shingles // stride) * stride
        bands = bands_for(least_jaccard(shingles, stride, width))
        seeds = np.arange(1, bands * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        odd = (mix64(seeds) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        hashes = [shingle_hashes(w, k) for _, w in group]
        out.append(Class(k, shingles, stride, width, bands, odd, [g[0] for g in group], [np.unique(h) for h in hashes],
                         [_band_keys(_min_rows(h, odd, 1, len(h), 1))[:, 0] for h in hashes]))
    return out


def scan(text: str | None, kinds: list[Class]) -> list[tuple[str, int, int, float]]:
    """(template, first word, word after the last, containment) of each match."""
    words = words_of(text)
    out: list[tuple[str, int, int, float]] = []
    hashes: dict[int, np.ndarray] = {}
    for c in kinds:
        if c.k not in hashes:
            hashes[c.k] = shingle_hashes(words, c.k) if len(words) >= c.k else np.empty(0, np.uint64)
        h = hashes[c.k]
        if len(h) < max(1, math.ceil(LEAST * c.shingles)):
            continue
        count = -(-max(0, len(h) - c.shingles) // c.stride) + 1
        for first in range(0, count, 1 << 13):  # bounded scratch memory
            some = min(1 << 13, count - first)
            base = first * c.stride
            block = h[base:base + (some - 1) * c.stride + c.width]
            keys = _band_keys(_min_rows(block, c.odd, c.stride, c.width // c.stride, some))
            for name, own, key in zip(c.names, c.sets, c.keys):
                for at in np.flatnonzero((keys == key[:, None]).any(axis=0)).tolist():
                    start = base + at * c.stride
                    lo, hi = max(0, start - c.stride), min(len(h), start + c.width + c.stride)
                    inside = np.isin(h[lo:hi], own)
                    share = len(np.unique(h[lo:hi][inside])) / len(own)
                    if share >= LEAST:
                        at_ = np.flatnonzero(inside)
                        out.append((name, lo + int(at_[0]), lo + int(at_[-1]) + c.k, share))
    return _joined(out)


def _joined(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    out: list[tuple[str, int, int, float]] = []
    for name, s, e, share in sorted(found):
        if out and out[-1][0] == name and s < out[-1][2]:
            out[-1] = (name, out[-1][1], max(e, out[-1][2]), max(share, out[-1][3]))
        else:
            out.append((name, s, e, share))
    return out


def matches(docs: DataFrame, keep: list[str], templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Columns ``keep`` with an array of matches of each row."""
    templates = list(templates)

    def factory():
        kinds = classes(templates)

        def run(texts):
            return {"matches": [[{"template": n, "first_word": s, "end_word": e, "containment": c}
                                 for n, s, e, c in scan(t, kinds)] for t in texts]}
        return run

    return map_texts(docs, factory, [(
        "matches", "array<struct<template:string,first_word:bigint,end_word:bigint,containment:double>>")], keep)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its licences and matches."""
    out = matches(table(spark, sf_dir, "documents"), ["doc_id"])
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["template"], m["first_word"], m["end_word"]))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["template"])))
    return out.select("doc_id", F.size("matches").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
                      F.array_join(spans, ",").alias("spans"),
                      F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])),
                                 F.lit(0.0)).alias("containment"))
