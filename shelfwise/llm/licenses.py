"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

Words are runs of letters and digits in lower case; shingles are ``SHINGLE`` of them. A template
of m words stands where at most 2 m words in a row hold ``CONTAINED`` of its shingles: words may be
changed, left out or put in. It is looked for in windows of 2 m + s - 1 words placed every
s = max(1, m // 2) words (and one at the end), so some window holds every such stretch, wherever it
begins. (One shingle needs no more than its own words.) Of a window with at least
``CONTAINED`` of the template's shingles the similarity to the template is at least a known
number J; with one hash per band and as many bands as make (1 - J) ** bands at most ``MISS``,
such a window shares a band with its template all but certainly. Band hits are only
candidates: the fullest stretches, of those the shortest, are then found by exact counts.

Templates are a parameter, checked to be at most ``MOST`` texts of ``LONGEST`` words, which
bounds what is sent to the workers.

Defined cases: a NULL or wordless text holds nothing; templates below ``SHINGLE`` words are an
error; templates with one id count together; rows are independent and repeats get the same
answer; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import extended, map_arrow
from shelfwise.llm.decontaminate import words_of

SHINGLE, CONTAINED, MISS = 5, 0.8, 1e-4
MOST, LONGEST = 5_000, 10_000

#: Notices as their publishers word them, and a shortened one.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


class Template:
    def __init__(self, name: str, text: str):
        _, _, hashes = _hashed(pa.array([text]))
        if not SHINGLE <= len(hashes) <= LONGEST:
            raise ValueError(f"template {name} must have {SHINGLE} to {LONGEST} words")
        self.name, self.words = name, len(hashes)
        self.shingles = np.unique(A.window_hashes(hashes, SHINGLE))
        #: Most words of a stretch that counts as the template; a lone shingle cannot be stretched.
        self.longest = 2 * self.words if len(self.shingles) > 1 else SHINGLE
        self.step = max(1, self.words // 2) if len(self.shingles) > 1 else 1
        self.window = self.longest + self.step - 1
        self.least = math.ceil(CONTAINED * len(self.shingles) - 1e-9)
        union = len(self.shingles) + self.window - SHINGLE + 1 - self.least
        self.bands = math.ceil(math.log(MISS) / math.log(max(1e-12, 1 - self.least / union))) if self.least < union else 1


def _hashed(column: pa.Array):
    buf, offsets, start, end = words_of(column)
    return (buf, offsets), (start, end), A.word_hashes(buf, start, end)


def _band(shingles: np.ndarray, band: int) -> np.ndarray:
    return A.mix(shingles + np.uint64((band + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64)))


def _windows(first: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and document of every window of a shape (words, step)."""
    size, step = shape
    words = np.diff(first)
    count = np.where(words > size, -(-(words - size) // step) + 1, (words >= SHINGLE).astype(np.int64))
    doc = np.repeat(np.arange(len(words)), count)
    place = A.within(np.zeros(len(words), np.int64), count) * step
    place = np.minimum(place, np.maximum(words[doc] - size, 0))
    return first[doc] + place, np.minimum(words[doc], size), doc


def _stretches(at: np.ndarray, which: np.ndarray, t: Template) -> list[tuple[int, int]]:
    """First and last shingle of every stretch that holds the template: the fullest, then the shortest, none overlapping.

    ``at`` are the places of the template's shingles in order, ``which`` says which shingle stands there.
    """
    out, open_parts = [], [(0, len(at))]
    while open_parts:
        a, b = open_parts.pop()
        ends, seen = [], OrderedDict()
        for place, shingle in zip(at[a:b].tolist(), which[a:b].tolist()):
            # By last place, so the first entry is where the shortest stretch with as many shingles begins.
            seen.pop(shingle, None)
            seen[shingle] = place
            while place - (begin := next(iter(seen.values()))) > t.longest - SHINGLE:
                seen.popitem(last=False)
            if len(seen) >= t.least:
                ends.append((-len(seen), place - begin, begin, place))
        # All that do not meet a better one are taken; what lies between them is searched again.
        taken = np.zeros(b - a, dtype=bool)
        bounds = []
        for _, _, begin, end in sorted(ends):
            i, j = np.searchsorted(at[a:b], (begin, end))
            if not taken[i : j + 1].any():
                taken[i : j + 1] = True
                bounds.append((a + int(i), a + int(j) + 1))
                out.append((begin, end))
        if bounds:
            bounds.sort()
            edges = [a, *(e for pair in bounds for e in pair), b]
            open_parts += [(x, y) for x, y in zip(edges[::2], edges[1::2]) if y - x >= t.least]
    return out


def _find(templates: list[Template]):
    shapes: dict[tuple[int, int], list[int]] = {}
    for k, t in enumerate(templates):
        shapes.setdefault((t.window, t.step), []).append(k)

    def candidates(shingle: np.ndarray, first: np.ndarray) -> dict:
        """Per (document, template) the (first shingle, one past the last) of the windows that share a band with it."""
        placed = {}
        for shape, own in shapes.items():
            at, size, doc = _windows(first, shape)
            if len(at):
                many, width = size - SHINGLE + 1, shape[0] - SHINGLE + 1
                full, short = np.flatnonzero(many == width), np.flatnonzero(many != width)
                span = A.within(at[short], many[short])
                cuts = np.cumsum(many[short]) - many[short]
                placed[shape] = at, many, doc, full, short, span, cuts, np.zeros((len(at), len(own)), dtype=bool)
        for band in range(max((templates[k].bands for shape in placed for k in shapes[shape]), default=0)):
            value = _band(shingle, band)
            # Least of every 1, 2, 4, ... values: two of them cover any width, for all shapes alike.
            doubled = [value]
            for shape, (at, many, doc, full, short, span, cuts, hits) in placed.items():
                own = [(j, k) for j, k in enumerate(shapes[shape]) if band < templates[k].bands]
                if not own:
                    continue
                least = np.zeros(len(at), dtype=np.uint64)
                width = shape[0] - SHINGLE + 1
                # Whole windows by doubled minima, the few of short texts each on its own.
                if len(full):
                    level = width.bit_length() - 1
                    while len(doubled) <= level:
                        half = 1 << (len(doubled) - 1)
                        doubled.append(np.minimum(doubled[-1][:-half], doubled[-1][half:]))
                    begin = at[full]
                    least[full] = np.minimum(doubled[level][begin], doubled[level][begin + width - (1 << level)])
                if len(short):
                    least[short] = np.minimum.reduceat(value[span], cuts)
                for j, k in own:
                    hits[:, j] |= least == _band(templates[k].shingles, band).min()
        out: dict = {}
        for shape, (at, many, doc, *_, hits) in placed.items():
            for w, j in zip(*(v.tolist() for v in np.nonzero(hits))):
                out.setdefault((int(doc[w]), shapes[shape][j]), []).append((int(at[w]), int(at[w] + many[w])))
        return out

    def run(batches):
        for batch in A.chunks(batches):
            (buf, offsets), (start, end), hashes = _hashed(batch.column("text"))
            first = np.searchsorted(start, offsets)
            shingle = A.window_hashes(hashes, SHINGLE)
            points = A.code_points(buf)
            found: list[dict] = [{} for _ in range(batch.num_rows)]
            for (d, k), windows in candidates(shingle, first).items():
                t, base = templates[k], points[offsets[d]]
                for low, high in zip(*A.spans_union(*(np.array(v) for v in zip(*windows)))):
                    which = np.minimum(np.searchsorted(t.shingles, shingle[low:high]), len(t.shingles) - 1)
                    match = np.flatnonzero(t.shingles[which] == shingle[low:high])
                    for a, b in _stretches(low + match, which[match], t):
                        found[d].setdefault(t.name, []).append((int(points[start[a]] - base), int(points[end[b + SHINGLE - 1]] - base)))
            rows = []
            for own_found in found:
                spans = []
                for name, places in sorted(own_found.items()):
                    s, e = A.spans_union(*(np.array(v) for v in zip(*places)))
                    spans += [{"license": name, "start": int(x), "end": int(y)} for x, y in zip(s, e)]
                rows.append(sorted(spans, key=lambda v: (v["start"], v["license"])))
            kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(rows, kind)], names=[*keep, "found"])

    return run


def scan(documents: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """The rows without ``text`` and with ``found``: (license, start, end) spans in code points."""
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MOST:
        raise ValueError(f"at most {MOST} templates")
    schema = extended(documents, "found array<struct<license: string, start: long, end: long>>", ("text",))
    return map_arrow(documents, _find([Template(n, t) for n, t in templates]), schema)


def op3_licenses(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_spans, licenses (sorted, comma-joined), spans (license:start:end, comma-joined)."""
    found = scan(documents.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_spans"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda s: s["license"]))), ",").alias("licenses"),
        F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )
