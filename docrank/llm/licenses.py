"""License scan: MinHash bands over text windows retrieve templates, shingle containment decides.

Templates are license statements. Texts become words (A-Z as a-z, runs of letters and
digits); each template is a set of ``k``-word shingles (its words as
one if it has fewer). For each length class of templates, texts are cut into
overlapping windows of the class's length plus a quarter, moved by that quarter,
so a statement lies whole in some window. A window's MinHash signature is taken
in bands; a band that equals one of a template's retrieves the template. Bands
and rows per band are set from the least Jaccard similarity that a window with
``containment`` of a template can have: the chance to miss it is below ``miss``.
The retrieved pairs are verified exactly: the share of the template's shingles
in the window and its neighbours must reach ``containment``. Only windows that
could pass this are signed: every shingle is looked up among the templates', and
a window that, with its neighbours, holds fewer of them than any template of the
class needs is left out. This changes no result.

Templates are a parameter (a list, broadcast with the function); texts are read
in one narrow pass, whole, whatever they hold.

Defined cases: null texts, texts without words and texts of fewer words than a
shingle match nothing (or a template equal to them); templates without words
are ignored; equal templates are found together; all columns are kept, the new
one gets a free name.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from docrank.llm import arrays
from docrank.llm.tables import fresh

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names and opening words of common license statements.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOUND = ArrayType(StructType([StructField("license", StringType()), StructField("template", LongType()),
                              StructField("word", LongType()), StructField("containment", DoubleType())]))


def bands(similarity: float, miss: float, most_rows: int = 4) -> tuple[int, int]:
    """(bands, rows): as many rows as allow a chance of at most ``miss`` with up to 64 hashes, else one row."""
    for rows in range(most_rows, 0, -1):
        p = similarity**rows
        count = 1 if p >= 1 else math.ceil(math.log(miss) / math.log(1 - p))
        if rows == 1 or count * rows <= 64:
            return count, rows
    raise AssertionError


class Class:
    """Templates of similar length. ``length``: shingles of the longest; windows have ``length + step`` shingles."""

    def __init__(self, templates: list[tuple[int, np.ndarray]], containment: float, miss: float):
        self.templates = templates
        longest, least = max(len(s) for _, s in templates), min(len(s) for _, s in templates)
        self.step = max(1, longest // 4)
        self.length = longest + self.step
        shared = math.ceil(containment * least)
        self.known = np.unique(np.concatenate([s for _, s in templates]))
        #: With fewer of its shingles no template reaches ``containment`` (a band takes one at least).
        self.need = max(1, math.ceil(containment * least - 1e-6))
        self.bands, self.rows = bands(shared / (self.length + least - shared), miss)
        self.seeds = arrays.mix(np.arange(1, self.bands * self.rows + 1, dtype=np.uint64))
        sign = np.array([[int(arrays.mix(s ^ seed).min()) for seed in self.seeds] for _, s in templates], np.uint64)
        keys = self.band_keys([sign[:, i] for i in range(len(self.seeds))])
        self.keys = [(np.unique(k), {int(x): [t for t, y in enumerate(k) if y == x] for x in np.unique(k)}) for k in keys]

    def band_keys(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for b in range(self.bands):
            key = np.full(len(columns[0]), b + 1, np.uint64)
            for r in range(self.rows):
                key = arrays.mix(key * arrays.ODD + columns[b * self.rows + r])
            out.append(key)
        return out

    def candidates(self, columns: list[np.ndarray]) -> set[tuple[int, int]]:
        """(window, template) pairs that share a band. ``columns``: the windows' smallest hash for each seed."""
        found = set()
        for (known, of), key in zip(self.keys, self.band_keys(columns), strict=True):
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            for w in np.flatnonzero(known[place] == key):
                found.update((int(w), t) for t in of[int(key[w])])
        return found


def members(value: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where ``value`` is one of ``known`` (sorted)."""
    if not len(known):
        return np.zeros(0, np.int64)
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value)


def windows(c: Class, hits: np.ndarray, origin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, begin, begin and end with the neighbours) of the windows that could pass the verification.

    ``hits``: places of the class's shingles, ascending; text i has the places
    ``origin[i]`` to ``origin[i] + size[i]``."""
    def count(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return np.searchsorted(hits, hi) - np.searchsorted(hits, lo)

    some = np.flatnonzero((size > 0) & (count(origin, origin + size + c.length + c.step) >= c.need))
    many = -(-size[some] // c.step)
    text = np.repeat(some, many)
    low = arrays.ranges(np.zeros(len(some), np.int64), many) * c.step + origin[text]
    first, stop = np.maximum(low - c.step, origin[text]), low + c.length + c.step
    enough = count(first, stop) >= c.need
    return text[enough], low[enough], first[enough], stop[enough]


def smallest_hashes(shingle: np.ndarray, classes: list[Class], lows: list[np.ndarray]) -> list[list[np.ndarray]]:
    """For each class and seed, the smallest hash in each of its windows, which begin at ``lows``.

    The classes use the same seeds, so a shingle is hashed once for all of them, and the
    minima over 2, 4, 8, ... shingles are shared."""
    out: list[list[np.ndarray]] = [[] for _ in classes]
    for i, seed in enumerate(max((c.seeds for c in classes), key=len, default=())):
        h, width = arrays.mix(shingle ^ seed), 1
        for n, c in sorted(enumerate(classes), key=lambda x: x[1].length):
            if i >= len(c.seeds):
                continue
            while width * 2 <= c.length:
                h[: len(h) - width] = np.minimum(h[: len(h) - width], h[width:])
                width *= 2
            out[n].append(np.minimum(h[lows[n]], h[lows[n] + c.length - width]))
    return out


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, text_col: str = "text", k: int = 5,
                  containment: float = 0.8, miss: float = 1e-6) -> tuple[DataFrame, str]:
    """``docs`` with an array of struct(license, template, word, containment), by place; and its name.

    ``template``: number in the list; ``word``: number of the first word of the best window.
    """
    name = fresh(docs, "licenses")
    texts = pa.array([t for _, t in templates], pa.string())
    words = arrays.Words(*arrays.text_buffer(texts), WORD_BYTES)
    value, owner = arrays.shingles(words, k)
    sets = [np.unique(value[owner == i]) for i in range(len(templates))]
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, s in enumerate(sets):
        if len(s) and words.count[i] >= k:
            by_size.setdefault(len(s).bit_length(), []).append((i, s))
    classes = [Class(v, containment, miss) for v in by_size.values()]
    known = np.unique(np.concatenate([c.known for c in classes])) if classes else np.zeros(0, np.uint64)
    short = {int(s[0]): i for i, s in enumerate(sets) if len(s) and words.count[i] < k}
    licenses = [n for n, _ in templates]

    def find(batch: pa.RecordBatch) -> pa.Array:
        words = arrays.Words(*arrays.text_buffer(batch.column(text_col)), WORD_BYTES)
        value, owner = arrays.shingles(words, k)
        n = batch.num_rows
        begin = np.searchsorted(owner, np.arange(n + 1))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for i in np.flatnonzero((words.count > 0) & (words.count < k)) if short else ():
            if (t := short.get(int(value[begin[i]]))) is not None:
                best[int(i), t] = (1.0, 0)
        # Places of the texts' shingles, with room between texts, so that no window holds two texts' shingles.
        gap = max((c.length for c in classes), default=0)
        size, origin = np.diff(begin), begin[:-1] + np.arange(n) * gap
        hits = members(value, known)
        wanted = []
        for c in classes:
            own = hits[members(value[hits], c.known)]
            if len(own) >= c.need and len((found := windows(c, own + owner[own] * gap, origin, size))[0]):
                wanted.append((c, *found))
        if wanted:
            # The wanted windows' shingles with their neighbours', one stretch after the other.
            first, stop = (np.concatenate([w[i] for w in wanted]) for i in (3, 4))
            order = np.argsort(first, kind="stable")
            first, stop = first[order], np.maximum.accumulate(np.minimum(stop[order], len(value) + n * gap))
            new = np.append(True, first[1:] > stop[:-1])
            first, stop = first[new], stop[np.append(new[1:], True)]
            before = np.cumsum(stop - first) - (stop - first)
            place = arrays.ranges(first, stop - first)
            row = arrays.mix(place.astype(np.uint64) * arrays.ODD)
            text = np.searchsorted(origin, place, side="right") - 1
            place -= origin[text]
            inside = place < size[text]
            row[inside] = value[(begin[text] + place)[inside]]

            def moved(at: np.ndarray) -> np.ndarray:
                stretch = np.searchsorted(first, at, side="right") - 1
                return at - first[stretch] + before[stretch]

            signed = smallest_hashes(row, [w[0] for w in wanted], [moved(w[2]) for w in wanted])
            for (c, text, _, lo, hi), columns in zip(wanted, signed, strict=True):
                start = moved(lo)
                for w, t in c.candidates(columns):
                    number, want = c.templates[t]
                    near = row[start[w]: start[w] + hi[w] - lo[w]]
                    own = members(near, want)
                    share = len(np.unique(near[own])) / len(want)
                    if share >= containment:
                        at = (text[w], number)
                        hit = (share, -int(lo[w] + own[0] - origin[text[w]]))
                        best[at] = max(best.get(at, (0.0, 0)), hit)
        out: list[list[dict]] = [[] for _ in range(n)]
        for (i, t), (share, word) in sorted(best.items(), key=lambda x: (x[0][0], -x[1][1], x[0][1])):
            out[i].append({"license": licenses[t], "template": t, "word": -word, "containment": share})
        return pa.array(out, pa.list_(pa.struct([("license", pa.string()), ("template", pa.int64()), ("word", pa.int64()),
                                                 ("containment", pa.float64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, text_col):
                yield pa.RecordBatch.from_arrays([*batch.columns, find(batch)], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, FOUND)])), name
