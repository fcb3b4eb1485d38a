"""Licence families of paragraphs, by logistic regression on word n-grams.

A paragraph is a line of a text.  Its features are the hashed runs of one to three
words; a multinomial logistic regression with few non-zero features gives the
probability of each licence family and of plain text.  The probabilities are
calibrated by one temperature on examples that were not learned from, and a
paragraph that looks like a licence but like no known family in particular is of
the class ``unknown``.

A predicted family counts only if a comparison with its templates confirms it:
enough of the paragraph's word pairs, or of a template's, are in the other.

The training paragraphs are the templates, cut and worded differently by rule,
and a bounded sample of the corpus' own paragraphs as plain text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import FOLDED, ODD, U, cut_words, fitted_to_sample, map_texts, mix, quoted, separators, text_slices

NONE, UNKNOWN = "none", "unknown"
ORDERS = (1, 2, 3)
#: paragraphs of the corpus that are learned as plain text, whole
SAMPLE = 1500
LEAST_PROBABILITY = 0.5
#: share of word pairs that a template must have in common with a paragraph
CONFIRMED = 0.6
#: words are letters and digits
NO_WORD = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

#: fixed values: how licences are named and what their notices say
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is distributed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "bsd": (
        "Distributed under the BSD license.",
        "Released under the 3-clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GPL version 2.",
        "This program is distributed under the GPLv3.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal",
    ),
    "public-domain": (
        "This work is in the public domain.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
    ),
}
#: fixed values: words of licences of no known family
OTHER_LICENCES = (
    "Licensed under the terms of the agreement between the parties.",
    "This work is licensed under the Open Data Commons Attribution License.",
    "Released under the Artistic License 2.0.",
    "Distributed under the Boost Software License, version 1.0.",
    "Licensed under the European Union Public Licence.",
    "This material is made available under the licence named in the header.",
    "Use is subject to the license terms of the vendor.",
    "Licensed under the Eclipse Public License.",
)
#: fixed values: openings by which notices are worded differently
OPENINGS = ("", "This document is", "The text is", "Copyright (c) 2019 the authors.", "Note:", "The code is")


def grams(words, h: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, hashes of the runs of words, and the first word of each run; runs stay in their paragraph."""
    owner = np.repeat(np.arange(len(words.first) - 1), words.counts())
    out = []
    for order in ORDERS:
        n = len(h) - order + 1
        if n <= 0:
            out.append((np.empty(0, U), np.empty(0, np.int64)))
            continue
        value = np.full(n, order, U)
        for i in range(order):
            value = mix(value * ODD + h[i : n + i])
        first = np.flatnonzero(owner[:n] == owner[order - 1 :])
        out.append((value[first], first))
    return out


def _paragraph_words(texts: list[str]):
    column = pa.array(texts, pa.string())
    for _, _, buf, offsets in text_slices(column, 1 << 62):
        return cut_words(buf, offsets, NO_WORD)
    return cut_words(np.empty(0, np.uint8), np.zeros(1, np.int64), NO_WORD)


def _features(texts: list[str]) -> list[np.ndarray]:
    """Distinct hashed n-grams of each text."""
    words = _paragraph_words(texts)
    found = [[] for _ in texts]
    owner = np.repeat(np.arange(len(texts)), words.counts())
    for values, first in grams(words, words.hashes(FOLDED)):
        of = owner[first]
        cuts = np.searchsorted(of, np.arange(len(texts) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            found[i].append(values[a:b])
    return [np.unique(np.concatenate(f)) for f in found]


def reworded(text: str, rng) -> list[str]:
    """The text itself, with openings, without some words, and parts of it."""
    words = text.split()
    out = [text, text.upper(), text.lower()]
    out += [f"{opening} {text[0].lower()}{text[1:]}" for opening in OPENINGS[1:]]
    for _ in range(6):
        keep = rng.random(len(words)) > 0.1
        out.append(" ".join(w for w, k in zip(words, keep) if k))
    for _ in range(6):
        if len(words) > 12:
            start = rng.integers(0, len(words) - 10)
            out.append(" ".join(words[start : start + rng.integers(10, 30)]))
    return out


@dataclass
class Model:
    classes: list[str]
    known: np.ndarray  # sorted hashes of the n-grams with weights
    weights: np.ndarray  # (n-grams + 1, classes); the last row is zero
    offset: np.ndarray
    temperature: float
    templates: list[list[np.ndarray]]  # word pairs of the templates of each class

    def _probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, words) -> list[tuple[int, str, float]]:
        """(paragraph, class, probability) of all paragraphs of a slice that are not plain text."""
        n = len(words.first) - 1
        owner = np.repeat(np.arange(n), words.counts())
        owners, places = [], []
        hashes = words.hashes(FOLDED)
        for values, first in grams(words, hashes):
            if len(values):
                at = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
                hit = np.flatnonzero(self.known[at] == values)
                owners.append(owner[first[hit]])
                places.append(at[hit])
        if not owners or not sum(map(len, owners)):
            return []
        of, at = np.concatenate(owners), np.concatenate(places)
        # an n-gram counts once for a paragraph
        both = np.unique(of.astype(np.int64) * len(self.known) + at)
        of, at = both // len(self.known), both % len(self.known)
        heads = np.flatnonzero(np.diff(of, prepend=-1))
        # most paragraphs have a few usual words only; an upper bound of all classes tells them
        best = self.weights[:-1].max(axis=1) - self.weights[:-1, 0]
        bound = np.add.reduceat(best[at], heads) + (self.offset.max() - self.offset[0])
        # all classes together have to reach the least probability against plain text
        likely = bound >= self.temperature * np.log(LEAST_PROBABILITY / (1 - LEAST_PROBABILITY) / (len(self.classes) - 1))
        out = []
        ends = np.append(heads[1:], len(of))
        for a, b in zip(heads[likely].tolist(), ends[likely].tolist()):
            logits = self.weights[at[a:b]].sum(axis=0) + self.offset
            p = self._probabilities(logits[None, :])[0]
            if 1 - p[0] < LEAST_PROBABILITY:
                continue
            paragraph = int(of[a])
            c = int(p[1:-1].argmax()) + 1
            if p[c] >= LEAST_PROBABILITY and self._confirmed(c, words, hashes, paragraph):
                out.append((paragraph, self.classes[c], float(p[c])))
            else:
                out.append((paragraph, UNKNOWN, float(1 - p[0])))
        return out

    def _confirmed(self, c: int, words, hashes: np.ndarray, paragraph: int) -> bool:
        """Whether a template of the class shares enough word pairs with the paragraph."""
        part = slice(words.first[paragraph], words.first[paragraph + 1])
        own = pairs_of(hashes[part])
        for template in self.templates[c]:
            common = len(np.intersect1d(own, template, assume_unique=True))
            if common >= CONFIRMED * max(1, min(len(own), len(template))):
                return True
        return False


def pairs_of(hashes: np.ndarray) -> np.ndarray:
    """Distinct pairs of neighbouring words."""
    return np.unique(mix(hashes[:-1] * ODD + hashes[1:])) if len(hashes) > 1 else np.unique(hashes)


def fit(plain: list[str]) -> Model:
    """Model of the templates against paragraphs of plain text."""
    rng = np.random.default_rng(7)
    classes = [NONE, *TEMPLATES, UNKNOWN]
    texts, labels, held = [], [], []
    for c, name in enumerate(classes):
        own = plain if name == NONE else OTHER_LICENCES if name == UNKNOWN else TEMPLATES[name]
        for text in own:
            made = [text] if name == NONE else reworded(text, rng)
            texts += made
            labels += [c] * len(made)
    labels = np.array(labels)
    held = np.arange(len(texts)) % 4 == 3
    found = _features(texts)
    licensed = [f for f, y in zip(found, labels) if y]
    known, often = np.unique(np.concatenate(licensed), return_counts=True)
    known = known[often >= 3]
    x = np.zeros((len(texts), len(known)), np.float32)
    for i, f in enumerate(found):
        at = np.minimum(np.searchsorted(known, f), len(known) - 1)
        x[i, at[known[at] == f]] = 1
    weights, offset = _fit_softmax(x[~held], labels[~held], len(classes))
    logits = x[held] @ weights + offset
    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: _loss(logits / t, labels[held]))
    templates = [[], *([pairs_of(_paragraph_words([t]).hashes(FOLDED)) for t in TEMPLATES[k]] for k in TEMPLATES), []]
    return Model(classes, known, np.vstack([weights, np.zeros((1, len(classes)))]), offset, temperature, templates)


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    z = logits - logits.max(axis=1, keepdims=True)
    return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())


def _fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 2e-4, rounds: int = 200):
    """Weights and offsets by gradient steps with momentum; all classes weigh the same, plain text more."""
    share = np.array([1.0 / max(1, (y == c).sum()) for c in range(classes)])
    share[0] *= 4
    share = share[y] / share[y].sum()
    goal = np.eye(classes, dtype=np.float32)[y]
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        z = x @ w + b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = ((z / z.sum(axis=1, keepdims=True) - goal) * share[:, None]).astype(np.float32)
        vw = 0.9 * vw - (x.T @ g + penalty * w)
        vb = 0.9 * vb - g.sum(axis=0)
        w, b = w + vw, b + vb
    return w, b


FIELDS = [
    ("n_paragraphs", "bigint"), ("license", "string"), ("score", "double"),
    ("licensed", "array<struct<paragraph: bigint, family: string, score: double>>"),
]


def line_offsets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all lines of a slice, and the first line of each text."""
    breaks = np.flatnonzero(buf == 0x0A) + 1
    lines = np.union1d(breaks, offsets)
    return lines, np.searchsorted(lines, offsets)


def _scan_job(held):
    def job():
        model = held.value
        kind = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("score", pa.float64())]))

        def work(texts: pa.Array):
            n = len(texts)
            found: list[list[dict]] = [[] for _ in range(n)]
            counts = np.zeros(n, np.int64)
            for _, _, buf, offsets in text_slices(texts, 1 << 62):
                lines, first = line_offsets(buf, offsets)
                words = cut_words(buf, lines, NO_WORD)
                filled = np.concatenate([[0], np.cumsum(words.counts() > 0)])
                counts = filled[first[1:]] - filled[first[:-1]]
                for line, family, score in model.predict(words):
                    doc = int(np.searchsorted(first, line, side="right")) - 1
                    found[doc].append({"paragraph": line - int(first[doc]), "family": family, "score": score})
            named = [sorted((-x["score"], x["family"]) for x in f if x["family"] != UNKNOWN) for f in found]
            best = [x[0][1] if x else UNKNOWN if f else NONE for x, f in zip(named, found)]
            score = [-x[0][0] if x else max((y["score"] for y in f), default=0.0) for x, f in zip(named, found)]
            return [pa.array(counts), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(found, kind)]

        return work

    return job


def fit_licenses(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Model with at most ``sample`` paragraphs of ``docs`` as plain text.

    Paragraphs that have words of licences are no plain text; they are left out of the sample.
    """
    lines = docs.select(F.split(F.col(quoted(text)), "\n").alias("lines")).where(F.size("lines") > 0)
    line = F.element_at("lines", (F.pmod(F.xxhash64("lines"), F.size("lines")) + 1).cast("int"))
    lines = lines.select(line.alias("line")).where(F.length("line") > 0)
    named = r"(?i)licen[cs]|copyright|public domain|rights reserved|creative commons|redistribut"

    def values(plain):
        m = fit(plain)
        return m.classes, m.known, m.weights, m.offset, m.temperature, m.templates

    return Model(*fitted_to_sample(lines.where(~F.col("line").rlike(named)), "line", sample, values))


def scan_licenses(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_paragraphs, license, score and the licensed paragraphs of each whole text.

    ``n_paragraphs`` counts lines with a word.  ``license`` is the family of the
    surest confirmed paragraph, by name where two are equally sure; ``unknown``
    if paragraphs look like a licence of no known family; else ``none`` with
    score 0, as for NULL and empty texts.  ``licensed`` lists all such paragraphs by
    their line number.
    """
    keep = docs.columns if keep is None else keep
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, keep, FIELDS, _scan_job(held))
