"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates are cut into tokens (runs of letters and digits, lower case) and into grams of three tokens. Of every
three neighbouring grams the one with the least hash goes to an inverted index, so any five tokens in common
leave a common fingerprint. Where a text holds fingerprints of a template, the template is aligned with that
part of the text, along the diagonal of the hits and a band around it.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from venuemart.llm.common import packed, text_of, with_fields

# Wordings of public licenses and of the notices that name them.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
        do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "MIT notice": "Released under the MIT License.",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

GRAM, WINDOW = 3, 3
#: Share of a template's tokens that must match.
COVERAGE = 0.8
#: Templates of fewer tokens must match whole: each of their words decides.
SHORT = 12
#: Half the width of the band: tokens inserted or left out on the way, at least and as a share of the template.
BAND, BAND_SHARE = 2, 0.1

_tokens = re.compile(r"[A-Za-z0-9]+")


@dataclass
class Templates:
    names: list[str]
    tokens: list[list[int]]
    words: dict[str, int]
    index: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    keys: np.ndarray | None = None

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """A number for each gram; -1 for those with a word that no template holds."""
        if len(ids) < GRAM:
            return np.zeros(0, np.int64)
        views = [ids[k : len(ids) - GRAM + 1 + k] for k in range(GRAM)]
        out = np.zeros(len(views[0]), np.int64)
        for v in views:
            out = out * (len(self.words) + 1) + v
        return np.where(np.min(views, axis=0) < 0, -1, out)

    def ids(self, words: list[str]) -> np.ndarray:
        get = self.words.get
        return np.array([get(w, -1) for w in words], np.int64)


def winnow(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Positions of the least hash of each window, the last of equal ones."""
    out = []
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start : start + window]
        if part:
            at = start + max(k for k, h in enumerate(part) if h == min(part))
            if not out or out[-1] != at:
                out.append(at)
    return out


def prepare(templates: dict[str, str]) -> Templates:
    cut = [[w.lower() for w in _tokens.findall(t)] for t in templates.values()]
    words = {w: k for k, w in enumerate(sorted({w for t in cut for w in t}))}
    held = Templates(list(templates), [[words[w] for w in t] for t in cut], words)
    index = defaultdict(list)
    for k, tokens in enumerate(held.tokens):
        grams = held.grams(np.array(tokens, np.int64)).tolist()
        for at in winnow([zlib.crc32(g.to_bytes(8, "little")) for g in grams]):
            index[grams[at]].append((k, at))
    held.index = dict(index)
    held.keys = np.array(sorted(index), np.int64)
    return held


def align(template: list[int], text: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment within the band: matched tokens, first and one past the last token of the text.

    A match scores 1, any other step -1. text[j] faces template[i] on diagonal j - i; those more than `band`
    from the given one are not tried. Of equal scores the one with more matches and then the first counts.
    """
    width = 2 * band + 1
    nothing = (0, 0, 0)
    above: list[tuple[int, int, int]] = [nothing] * width
    best = (0, 0, 0, 0)
    for i, word in enumerate(template):
        row, left = [], nothing
        for k in range(width):
            j = i + diagonal - band + k
            if not 0 <= j < len(text):
                row.append(nothing)
                left = nothing
                continue
            score, matched, start = above[k]
            hit = text[j] == word
            here = (score + 1, matched + 1, start if score else j) if hit else (score - 1, matched, start)
            up = above[k + 1] if k + 1 < width else nothing
            here = max(here, (up[0] - 1, up[1], up[2]), (left[0] - 1, left[1], left[2]), key=lambda x: (x[0], x[1], -x[2]))
            if here[0] <= 0:
                here = nothing
            row.append(here)
            left = here
            if (here[0], here[1]) > (best[0], best[1]):
                best = (here[0], here[1], here[2], j + 1)
        above = row
    return best[1], best[2], best[3]


def scan(text: str, held: Templates, coverage: float = COVERAGE) -> list[tuple[str, float, int, int]]:
    """(template, share of its tokens matched, start, end in characters), by position.

    Of matches that overlap the one with more matched tokens is reported, then the higher share.
    """
    ids = held.ids([w.lower() for w in _tokens.findall(text)])
    grams = held.grams(ids)
    at = np.flatnonzero(np.isin(grams, held.keys)) if len(grams) else []
    if not len(at):
        return []
    hits = defaultdict(list)
    for j in at.tolist():
        for k, i in held.index[int(grams[j])]:
            hits[k].append((j - i, j))
    found = []
    for k, places in hits.items():
        size = len(held.tokens[k])
        band = max(BAND, int(BAND_SHARE * size))
        # Hits within half a band of each other's diagonal belong to one place of the text.
        places.sort()
        groups = [[places[0]]]
        for place in places[1:]:
            groups[-1].append(place) if place[0] - groups[-1][-1][0] <= band else groups.append([place])
        for group in groups:
            matched, start, end = align(held.tokens[k], ids, group[len(group) // 2][0], band)
            if matched >= (coverage * size if size >= SHORT else size):
                found.append((matched, matched / size, k, start, end))
    found.sort(key=lambda x: (-x[0], -x[1], x[3], x[2]))
    kept: list[tuple] = []
    for x in found:
        if all(x[4] <= y[3] or x[3] >= y[4] for y in kept):
            kept.append(x)
    if not kept:
        return []
    spans = [m.span() for m in _tokens.finditer(text)]
    return [(held.names[k], share, spans[a][0], spans[b - 1][1]) for _, share, k, a, b in sorted(kept, key=lambda x: x[3])]


MATCH = T.StructType([T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, text_col: str = "text") -> DataFrame:
    """Rows of docs as struct `row`, with `matches`, an array that is empty where no template is found.

    Null text counts as empty. Texts are read whole; every place of a text where a template occurs is reported.
    The templates, not the documents, are sent to every executor. Other columns pass through whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(prepare(TEMPLATES if templates is None else templates))
    base = packed(docs, text=text_of(text_col))

    def run(batches):
        held = sent.value
        for batch in batches:
            out = [[dict(zip(MATCH.names, m, strict=True)) for m in scan(t, held, coverage)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _ARROW)], ["row", "matches"])

    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), T.StructField("matches", T.ArrayType(MATCH))))
