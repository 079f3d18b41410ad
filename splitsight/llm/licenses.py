"""License scan: MinHash bands over overlapping windows find templates, shingle containment verifies them.

Windows of 8, 16, 32, ... words overlap by half. A template is cut into windows in the same way, of the
size class that fits it (at most twice its words). Both get ``BANDS`` MinHash values of one row each, so a
window that shares a part s of its shingles with a template meets it with probability 1 - (1 - s)^BANDS:
above 0.9999 for s >= 0.25, which a template contained to 0.8 reaches in any alignment. A template
found is verified on the words around the window: at least 0.8 of its five-word shingles must stand there.

Cases: a null or wordless text holds no license; templates of fewer than five words have no shingle and are
never found; equal templates are all reported; rows are read one by one, so repeated rows and null ids need
no care; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitsight.llm.words import WordHashes, mixed, shingles, tasks_over, utf8, word_array, words

SHINGLE = 5
BANDS = 32
CONTAINED = 0.8
SMALLEST = 8
MAX_TEMPLATE_WORDS = 1_000_000
# Shingles hashed at a time; whole windows of the smallest size.
PART = 16_384

# One-line notices and headers, then the whole texts in license_texts.
NOTICES = {
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
    "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
}
TEXTS = {f"{path.stem}-text": path.read_text() for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
TEMPLATES = NOTICES | TEXTS


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "name string, text string")


_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_NONE = ~np.uint64(0)


def window_signatures(grams: np.ndarray, classes: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per size class: words of a window, and its MinHash values, windows x bands.

    Window k of size w covers the shingles that begin in words k w/2 to (k + 2) w/2; sizes double, so the
    values of a class come from those of the class below.
    """
    half = SMALLEST // 2
    blocks = []
    for at in range(0, len(grams), PART):
        part = grams[at : at + PART, None] * _SEEDS[None, :]
        blocks.append(np.minimum.reduceat(part, np.arange(0, len(part), half), axis=0))
    blocks = np.vstack(blocks)
    for _ in range(classes):
        below = np.vstack((blocks, np.full((1, BANDS), _NONE)))
        yield 2 * half, np.minimum(below[:-1], below[1:])
        if len(blocks) % 2:
            blocks = below
        blocks = np.minimum(blocks[::2], blocks[1::2])
        half *= 2


def size_class(n_words: int) -> int:
    """The class whose windows hold the template: the least size that isn't below its words."""
    k = 0
    while SMALLEST << k < n_words:
        k += 1
    return k


class Templates:
    """Shingles of the templates and, per size class and band, their MinHash values."""

    def __init__(self, rows: list[tuple[str, str]]):
        hashes = WordHashes()
        self.names, self.grams, self.lengths, self.classes = [], [], [], []
        found: dict[int, dict[tuple[int, int], set[int]]] = defaultdict(lambda: defaultdict(set))
        for name, text in rows:
            own = words(text.encode() if text else None)
            if len(own) < SHINGLE:
                continue
            at, k = len(self.names), size_class(len(own))
            grams = shingles(hashes.of(own), SHINGLE)
            self.names.append(name)
            self.grams.append(np.unique(grams))
            self.lengths.append(len(grams))
            self.classes.append(k)
            for band, value in enumerate((grams[:, None] * _SEEDS[None, :]).min(axis=0).tolist()):
                found[k][band, value].add(at)
        self.keys = {}
        for k, by_value in found.items():
            keys = sorted(by_value)
            bands, values = (np.array(x, np.uint64) for x in zip(*keys, strict=True))
            mix = mixed(values + bands)
            order = np.argsort(mix)
            self.keys[k] = mix[order], [sorted(by_value[keys[i]]) for i in order]

    def found(self, grams: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(name, first word, word after the last, containment) of each place of a template, in order."""
        out: dict[int, dict[int, tuple[str, int, int, float]]] = defaultdict(dict)
        if not len(grams) or not self.keys:
            return []
        for k, (size, values) in enumerate(window_signatures(grams, max(self.keys) + 1)):
            if k not in self.keys:
                continue
            mix, owners = self.keys[k]
            probes = mixed(values + np.arange(BANDS, dtype=np.uint64)[None, :])
            at = np.minimum(np.searchsorted(mix, probes), len(mix) - 1)
            for window, band in zip(*np.nonzero(mix[at] == probes), strict=True):
                for t in owners[at[window, band]]:
                    low = max(0, window * size // 2 - size)
                    part = grams[low : window * size // 2 + 2 * size]
                    place = np.flatnonzero(np.isin(part, self.grams[t]))
                    # The run of matching shingles around the window's own first match.
                    inside = place[(place + low >= window * size // 2) & (place + low < window * size // 2 + size)]
                    if not len(inside):
                        continue
                    near = place[np.abs(place - inside[0]) <= self.lengths[t]]
                    share = len(np.unique(part[near])) / len(self.grams[t])
                    if share >= CONTAINED:
                        first = low + int(near[0])
                        out[t].setdefault(first, (self.names[t], first, low + int(near[-1]) + SHINGLE, share))
        return sorted((x for places in out.values() for x in apart(places.values())), key=lambda x: (x[1], x[0], x[2]))


def apart(places: Iterable[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of overlapping places of a template the fullest, then the shortest, then the first."""
    kept: list[tuple[str, int, int, float]] = []
    for x in sorted(places, key=lambda x: (-x[3], x[2] - x[1], x[1])):
        if all(x[2] <= y[1] or y[2] <= x[1] for y in kept):
            kept.append(x)
    return kept


def license_spans(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "name", template: str = "text") -> DataFrame:
    """Per row: id, ``licenses``: array of (name, first word, word after the last, containment).

    Templates are a small fixed table: it is broadcast after a check of its words.
    """
    # Shorter ones have no shingle.
    sized = known.select(F.col(name).alias("name"), F.col(template).alias("text"), F.size(word_array(template)).alias("n")).where(F.col("n") >= SHINGLE)
    total = sized.agg(F.sum("n")).first()[0] or 0
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {total} words, more than {MAX_TEMPLATE_WORDS}")
    rows = [(r["name"], r["text"]) for r in sized.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(Templates(rows))
    pairs = [("name", pa.string()), ("first", pa.int32()), ("end", pa.int32()), ("contained", pa.float64())]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in tasks_over(batches):
            found = []
            for t in utf8(batch.column(text)):
                own = words(t)
                grams = shingles(hashes.of(own), SHINGLE) if len(own) >= SHINGLE else np.zeros(0, np.uint64)
                found.append([dict(zip(("name", "first", "end", "contained"), x, strict=True)) for x in shared.value.found(grams)])
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(found, pa.list_(pa.struct(pairs)))], [doc_id, "licenses"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(scan, f"`{doc_id}` {kind}, licenses array<struct<name:string,first:int,end:int,contained:double>>")
