"""Licence notices in documents: a trained classifier of paragraphs, confirmed against templates.

A paragraph is a run of lines without an empty one between them. Each of its lines is judged, longer ones in overlapping
windows of ``WINDOW`` words; then, since notices may be wrapped, windows over the ends of those lines that were judged
``unknown``. A softmax
regression on word 1- and 2-grams (of templates and refusals, kept only if rare in the corpus) gives each paragraph a licence family or
``unknown``. It is trained here on varied copies of the templates below (words dropped, replaced, cut out of longer
text) and, for ``unknown``, on at most ``SAMPLE`` paragraphs of the corpus that look like no template, and on
sentences that speak of licences without granting one. Its temperature is fitted on a part kept from training, so
that probabilities are calibrated. A family counts only if its probability is at least ``LEAST`` and the paragraph
shares enough 2-grams with one of the family's templates.

Cases: null, empty or wordless texts have no paragraph and no licence; texts of any length are read whole; ties go to
the family first in order; repeated rows are each judged; an empty table gives an empty result (the classifier is
then trained without corpus paragraphs); other columns are not read.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.runtime import ship

# Sentences by which these public licences are commonly granted.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is released under the Apache License 2.0. SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Licensed under the BSD 3-Clause License. SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under the Creative Commons Attribution License CC BY 4.0 unless otherwise noted.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0; non-commercial use only.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Content is available under the Creative Commons Attribution-ShareAlike License CC BY-SA 3.0 unless otherwise noted.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3. SPDX-License-Identifier: AGPL-3.0-only",
        "GNU Affero General Public License",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3. SPDX-License-Identifier: LGPL-3.0-or-later",
        "GNU Lesser General Public License",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License. SPDX-License-Identifier: ISC",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "Released under the Unlicense. SPDX-License-Identifier: Unlicense",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v2. SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license. SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/. SPDX-License-Identifier: MPL-2.0",
    ),
}
OTHER = (
    "He lost his driving license and had to apply for a new one at the office.",
    "The software vendor refused to license the patent under any terms.",
    "A fishing license is required by law in this state, version of the form included.",
    "The general public is free to use the library during opening hours.",
    "MIT and other universities published the study in April.",
    "The Apache people lived on the plains; their history is told in version two of the book.",
    "Copyright law is a difficult subject and this article is not legal advice.",
    "All rights reserved.",
    "You may not use this form without permission of the editor.",
    "The committee on creative arts met in the common room.",
    "The author rejected the Apache License, Version 2.0 proposal.",
    "They decided against the MIT License and do not grant the rights of the GNU General Public License.",
    "This file is not licensed under the Apache License or any Creative Commons Attribution licence.",
    "The article compares the GNU Affero General Public License with the Mozilla Public License and the BSD licence.",
    "Nobody may redistribute this program; it is neither free software nor in the public domain.",
    "Distributed systems need careful design and this work is one of many.",
)
FAMILIES = ("unknown", *TEMPLATES)
SAMPLE = 4000
WINDOW, STRIDE = 64, 32
COPIES, EPOCHS = 80, 24
LEAST, SHARED = 0.8, 0.5
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def windows(words: list[str]) -> Iterator[list[str]]:
    """A line's words, in overlapping windows if they are many."""
    if len(words) <= WINDOW:
        if words:
            yield words
        return
    for i in range(0, len(words) - STRIDE, STRIDE):
        yield words[i : i + WINDOW]


def grants(text: str | None, judge: Callable[[list[str]], tuple[str, float, float]]) -> tuple[int, list[tuple]]:
    """How many lines or windows of lines a text has, and its notices: (number of the first line, *judgement).

    Words of lines without a notice wait until WINDOW of them are there, or the paragraph or the run of such lines ends;
    if they are of several lines, they are judged together. Without a notice, the latest STRIDE words wait on.
    """
    n, found = 0, []
    waiting: list[str] = []
    lines: list[int] = []

    def close(size: int, kept: int) -> None:
        if lines and lines[0] != lines[min(size, len(lines)) - 1]:
            got = judge(waiting[:size])
            if got[0] != "unknown":
                found.append((lines[0], *got))
                kept = 0
        drop = size - kept
        del waiting[:drop], lines[:drop]

    for at, line in enumerate((text or "").split("\n")):
        words = words_of(line)
        judged = [judge(part) for part in windows(words)]
        n += len(judged)
        here = [(at, *got) for got in judged if got[0] != "unknown"]
        if here or not words:
            close(len(waiting), 0)
            found += here
            continue
        waiting += words
        lines += [at] * len(words)
        while len(waiting) >= WINDOW:
            close(WINDOW, WINDOW - STRIDE)
    close(len(waiting), 0)
    return n, found


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def overlap(words: list[str], family: str) -> float:
    """The largest share of a template's 2-grams that a paragraph has, or of the paragraph's that a template has.

    The second needs four 2-grams at least, so that a common pair alone confirms nothing.
    """
    own, best = bigrams(words), 0.0
    for template in _template_grams()[family]:
        both = len(own & template)
        best = max(best, both / len(template), both / len(own) if len(own) >= 4 else 0.0)
    return best


@functools.cache
def _template_grams() -> dict[str, list[set]]:
    return {f: [bigrams(words_of(part)) for t in some for part in (t, *t.split(". ")) if len(words_of(part)) > 2] for f, some in TEMPLATES.items()}


class Model:
    def __init__(self, index: dict, w: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.index, self.w, self.bias, self.temperature = index, w, bias, temperature
        self.first = {k for k in index if isinstance(k, str)} | {k[0] for k in index if not isinstance(k, str)}

    def grams(self, words: list[str]) -> list[int]:
        if self.first.isdisjoint(words):
            return []
        get = self.index.get
        found = {i for i in map(get, words) if i is not None} | {i for i in map(get, zip(words, words[1:], strict=False)) if i is not None}
        return sorted(found)

    def logits(self, at: list[int]) -> np.ndarray:
        return self.bias + self.w[at].sum(0)

    def probabilities(self, at: list[int]) -> np.ndarray:
        a = self.logits(at) / self.temperature
        e = np.exp(a - a.max())
        return e / e.sum()

    def judge(self, words: list[str]) -> tuple[str, float, float]:
        """(family, probability, overlap with its templates); ``unknown`` where it is not confirmed."""
        at = self.grams(words)
        p = self.probabilities(at) if at else self.none
        best = int(p.argmax())
        if best == 0 or p[best] < LEAST:
            return "unknown", float(p[0]), 0.0
        shared = overlap(words, FAMILIES[best])
        return (FAMILIES[best], float(p[best]), shared) if shared >= SHARED else ("unknown", float(1 - p[best]), shared)

    @functools.cached_property
    def none(self) -> np.ndarray:
        return self.probabilities([])


def varied(words: list[str], others: list[list[str]], rng: np.random.Generator) -> list[str]:
    """A copy with some words dropped or replaced, perhaps cut short or set within other text."""
    out = [w for w in words if rng.random() > 0.08]
    if len(out) > 12 and rng.random() < 0.5:
        start = int(rng.integers(0, len(out) - 10))
        out = out[start : start + int(rng.integers(10, len(out) + 1))]
    for front in (True, False):
        if rng.random() < 0.25 and others:
            around = others[int(rng.integers(len(others)))][: int(rng.integers(1, STRIDE))]
            out = around + out if front else out + around
    return out


def fit(corpus: list[str], seed: int = 1) -> Model:
    rng = np.random.default_rng(seed)
    corpus_words = [w for t in corpus if (w := words_of(t)[:WINDOW]) and max(overlap(w, f) for f in TEMPLATES) < 0.3]
    rows, y = list(corpus_words), [0] * len(corpus_words)
    for text in OTHER:
        for _ in range(COPIES // 2):
            rows.append(varied(words_of(text), corpus_words, rng))
            y.append(0)
    for k, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            for _ in range(COPIES):
                rows.append(varied(words_of(template), corpus_words, rng))
                y.append(k)
    seen, common = Counter(), Counter()
    for i, words in enumerate(rows):
        (common if i < len(corpus_words) else seen).update({*words, *bigrams(words)})
    rare = max(1.0, 0.01 * len(corpus_words))
    index = {g: i for i, g in enumerate(sorted((g for g, n in seen.items() if n >= COPIES // 4 and common[g] <= rare), key=str))}
    model = Model(index, np.zeros((len(index), len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0)
    at, target = [model.grams(words) for words in rows], np.array(y)
    kept = rng.random(len(rows)) < 0.2  # for the temperature
    squares, bias_squares = np.full((len(index), 1), 1e-2), 1e-2
    for _ in range(EPOCHS):
        for i in rng.permutation(np.flatnonzero(~kept)):
            p = model.probabilities(at[i])
            p[target[i]] -= 1
            bias_squares += (p * p).sum()
            model.bias -= 0.3 * p / bias_squares**0.5
            if at[i]:
                squares[at[i]] += (p * p).sum()
                model.w[at[i]] -= 0.3 * p / np.sqrt(squares[at[i]]) + 1e-4 * model.w[at[i]]
    held = np.flatnonzero(kept)
    raw = np.array([model.logits(at[i]) for i in held])

    def loss(t: float) -> float:
        a = raw / t
        a = a - a.max(1, keepdims=True)
        return float((np.log(np.exp(a).sum(1)) - a[np.arange(len(held)), target[held]]).mean())

    model.temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))
    return model


def train(docs: DataFrame) -> bytes:
    """The pickled model. At most SAMPLE corpus paragraphs in expectation, chosen by hash from a hash-chosen set of documents."""
    n = docs.count()
    if not n:
        return pickle.dumps(fit([]))
    some = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, SAMPLE / n) * (1 << 20))
    lines = some.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).filter("line RLIKE '\\\\w'")
    sizes = lines.count()
    kept = lines.filter(F.pmod(F.xxhash64("doc_id", "at"), F.lit(1 << 20)) < min(1.0, SAMPLE / max(1, sizes)) * (1 << 20))
    return pickle.dumps(fit(sorted(r[0] for r in kept.select(F.substring("line", 1, 2000)).collect())))  # training rows only


@functools.lru_cache(2)
def _loaded(model: bytes) -> Model:
    return pickle.loads(model)


def notices(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, line, family, probability, overlap: every line, or window over several lines, that grants a licence."""
    ship(docs.sparkSession)

    def run(batches):
        judge = _loaded(model).judge
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out += [(doc_id, *notice) for notice in grants(text.as_py(), judge)[1]]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "line", "family", "probability", "overlap"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, line int, family string, probability double, overlap double")


def scan(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_paragraphs, n_notices, families (in order, by commas), licence (of the surest notice; else null), probability."""
    ship(docs.sparkSession)

    def run(batches):
        judge = _loaded(model).judge
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, notices_of = grants(text.as_py(), judge)
                found = [notice[1:] for notice in notices_of]
                best = min(found, key=lambda g: (-g[1], FAMILIES.index(g[0])), default=(None, 0.0))
                out.append((doc_id, n, len(found), ",".join(sorted({g[0] for g in found})), best[0], best[1]))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_paragraphs", "n_notices", "families", "licence", "probability"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_paragraphs long, n_notices long, families string, licence string, probability double")
