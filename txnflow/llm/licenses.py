"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

A template is found where a window of the text holds at least ``least`` per cent of its shingles (``width`` plain words,
without case and marks).  For every length of template the text is cut into overlapping windows, a quarter of the
template apart and as much longer than it, so each occurrence lies within one.  A window's MinHash is entered into
BANDS bands of ROWS minima; a band that equals a template's retrieves it, and the containment is then counted exactly.
:func:`collision_probability` gives the chance that a window with the least containment is retrieved; templates for
which it is under 0.99 are refused.  Windows that hold fewer shingles of templates than the least containment asks for
are not hashed.

Without ``templates`` the text is scanned for TEMPLATES and for ``license_texts.json``: whole licenses, their standard
headers, parts that are used alone, and one-line notices.  A license that contains another's text gives a row for each.

The templates are a parameter (``max_templates`` at most); nothing is shuffled.  A null or empty text has no matches;
a text of fewer words than a shingle is one shingle, and so is such a template.  Templates without words are refused.
Overlapping windows with the same template count as one match, the one with the highest containment.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import WordHashes, byte_texts, gram_hashes, members, mix, plain_words, slices

BANDS, ROWS = 64, 2
SALTS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))

#: Fixed texts: notices of common licenses.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "gpl": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation",
}


def registered() -> dict[str, str]:
    """All fixed texts: TEMPLATES and the data file."""
    return TEMPLATES | json.loads(Path(__file__).with_name("license_texts.json").read_text(encoding="utf-8"))


def collision_probability(similarity: float) -> float:
    return 1 - (1 - similarity**ROWS) ** BANDS


class Index:
    """The templates by window size, with their bands."""

    def __init__(self, templates: dict[str, str], width: int, least: int, max_templates: int):
        if len(templates) > max_templates:
            raise ValueError(f"more than {max_templates} templates")
        self.names, self.sets, self.width, self.least = list(templates), [], width, least
        self.classes: dict[tuple[int, int], dict[int, list[int]]] = {}
        self.fewest: dict[tuple[int, int], int] = {}  # shingles that the templates of a class need at least
        hashes = WordHashes()
        for number, text in enumerate(templates.values()):
            words = hashes.of(plain_words(text.encode()))
            if not len(words):
                raise ValueError("a template without words")
            own = np.unique(gram_hashes(words, min(width, len(words))))
            step = max(1, len(words) // 4)
            size = len(words) + step if len(words) >= 8 else len(words)  # a short one begins at every word
            needed = -(-len(own) * least // 100)
            similarity = needed / (max(1, size - width + 1) + len(own) - needed)
            if collision_probability(similarity) < 0.99:
                raise ValueError(f"{self.names[number]}: windows would be retrieved with less than 0.99")
            self.sets.append(own)
            kind = size, step if len(words) >= 8 else 1
            self.fewest[kind] = min(needed, self.fewest.get(kind, needed))
            table = self.classes.setdefault(kind, {})
            for key in bands(own):
                table.setdefault(key, []).append(number)
        self.known = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(template, first word, word after the last, containment)."""
        grams = gram_hashes(words, min(self.width, len(words))) if len(words) else words
        hit = np.flatnonzero(members(self.known, grams))
        found: dict[int, list] = {}
        for (size, step), table in self.classes.items() if len(hit) else ():
            span = max(1, size - self.width + 1)
            fewest = max(1, self.fewest[size, step])
            if len(hit) < fewest:
                continue
            starts = np.arange(max(0, -(-(hit[0] - span + 1) // step)), hit[-1] // step + 1) * step
            inside = np.searchsorted(hit, starts + span) - np.searchsorted(hit, starts)
            for start in starts[inside >= fewest].tolist():
                own = np.unique(grams[start : start + span])
                for number in {n for k in bands(own) for n in table.get(k, ())}:
                    template = self.sets[number]
                    common = int(members(own, template).sum())
                    if 100 * common >= self.least * len(template):
                        inside = start + np.flatnonzero(members(template, grams[start : start + span]))
                        end = min(len(words), int(inside[-1]) + self.width)
                        found.setdefault(number, []).append((int(inside[0]), end, common / len(template)))
        for number, places in found.items():
            best = None
            for place in sorted(places):
                if best is None or place[0] >= best[1]:
                    if best:
                        yield number, *best
                    best = place
                elif place[2] > best[2]:
                    best = place
            yield number, *best


def bands(grams: np.ndarray) -> list[int]:
    """The band keys of a set of shingles: BANDS numbers made of ROWS minima each."""
    low = mix(grams[:, None] ^ SALTS[None, :]).min(0).reshape(BANDS, ROWS)
    keys = low[:, 0]
    for row in range(1, ROWS):
        keys = mix(keys * np.uint64(3) + low[:, row])
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).tolist()


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    text: str = "text",
    key: str = "doc_id",
    width: int = 5,
    least: int = 80,
    max_templates: int = 10_000,
) -> DataFrame:
    """(key, license, start, end, containment) of every match; start and end count plain words, end exclusive."""
    index = Index(registered() if templates is None else templates, width, least, max_templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            rows, found = [], []
            for i, t in enumerate(byte_texts(batch.column("text"))):
                for match in index.matches(hashes.of(plain_words(t))):
                    rows.append(i)
                    found.append(match)
            columns = list(zip(*found, strict=True)) if found else [[]] * 4
            arrays = [
                batch.column("key").take(pa.array(rows, pa.int64())),
                pa.array([index.names[n] for n in columns[0]], pa.string()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "license", "start", "end", "containment"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, license string, start long, end long, containment double"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
