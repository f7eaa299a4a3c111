"""Licence families by a trained paragraph classifier.

A text's paragraphs (its lines with a word) are classified by multinomial
logistic regression over sparse word 1- to 3-grams of the licence notices. The
training set is made here: sentences of the notices, alone, joined, shortened
and set among words of the corpus, against paragraphs of a bounded sample of
``sample_texts`` texts (whole lines from all of each text, picked by content
hash, see `background`) and sentences that merely sound alike; held-out examples
then fit a temperature and the probability below which a paragraph counts as
unknown. A family found must be confirmed by comparison with its templates: at
least `MIN_COMMON` word pairs in common, and half of those of the shorter side.

All paragraphs of all texts are looked at; one with fewer than `MIN_COMMON` word
pairs of any notice cannot be confirmed and is unknown without being scored.

Edge cases: a null, empty or wordless text has no paragraphs and no licence; ties
between families go to the first by name; repeated rows are judged each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import (ALNUM_WORD, LOWER, arrow_map, gram_hashes, out_batch, out_schema, table,
                                   text_batches, word_hashes, word_spans)

MIN_COMMON = 2
UNKNOWN = "unknown"
#: Sentences of the usual notices of each family.
NOTICES = {
    "all-rights-reserved": ["All rights reserved.", "Copyright by the author. All rights reserved.",
                            "No part of this work may be reproduced without prior written permission."],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
               "compliance with the License.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
               "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Released under the BSD License.", "Use of this source code is governed by a BSD-style license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License.", "Licensed under CC BY-SA 4.0."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0 Universal.",
            "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "Released under the GNU General Public License, version 2 or later.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction",
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
            "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0."],
}
#: Sentences about licences and rights that grant none.
LOOKALIKES = [
    "The driver lost his license after the accident.", "She applied for a license to sell food in the market.",
    "Human rights must be protected under the law of every country.", "The work was released under a new name.",
    "The software is provided to all students of the school.", "You may not use this door in the evening.",
    "The general public was free to visit the foundation.", "A copy of the letter is at the office.",
    "Permission to land was granted to the crew.", "The version of the story in the paper is different.",
    "All seats are reserved for the guests.", "The terms of the treaty were published by the state.",
    "The Apache people lived in the south west.", "He studied at MIT and released his first work there.",
]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    starts, ends, rows = word_spans(data, offsets, ALNUM_WORD)
    return word_hashes(data, starts, ends), rows


def grams(h: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row) of the k-grams inside the rows."""
    g = h if k == 1 else gram_hashes(h, k)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:len(g)]
    inside = np.arange(len(g)) + k <= rows[1:][row] if len(g) else np.zeros(0, bool)
    return g[inside], row[inside]


@dataclass
class Model:
    families: list[str]
    vocab: np.ndarray  # grams, ascending
    weights: np.ndarray  # len(vocab) x (families, unknown)
    bias: np.ndarray
    temperature: float
    threshold: float
    pairs: np.ndarray  # word pairs of all notices, ascending
    templates: list[list[np.ndarray]]  # word pairs of each notice, by family

    def features(self, h, rows) -> tuple[np.ndarray, np.ndarray]:
        """(feature, row), each once."""
        found, where = [], []
        for k in (1, 2, 3):
            g, row = grams(h, rows, k)
            at = np.minimum(np.searchsorted(self.vocab, g), len(self.vocab) - 1)
            hit = self.vocab[at] == g
            found.append(at[hit])
            where.append(row[hit])
        both = np.unique(np.concatenate(where) * len(self.vocab) + np.concatenate(found))
        return both % len(self.vocab), both // len(self.vocab)

    def scores(self, h, rows) -> np.ndarray:
        feature, row = self.features(h, rows)
        z = np.zeros((len(rows) - 1, len(self.bias)))
        np.add.at(z, row, self.weights[feature])
        return z + self.bias

    def probabilities(self, h, rows) -> np.ndarray:
        return softmax(self.scores(h, rows) / self.temperature)

    def confirms(self, family: int, pairs: np.ndarray) -> bool:
        mine = np.unique(pairs)
        for t in self.templates[family]:
            common = len(np.intersect1d(mine, t, assume_unique=True))
            if common >= MIN_COMMON and 2 * common >= min(len(mine), len(t)):
                return True
        return False


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def examples(background: list[str], rng: np.random.Generator) -> tuple[list[str], list[int]]:
    """Training paragraphs with the number of their family (the last: unknown)."""
    families = sorted(NOTICES)
    spare = [w for p in background for w in p.split()] or ["text"]
    some = lambda: " ".join(spare[i] for i in rng.integers(0, len(spare), rng.integers(1, 12)))
    out, label = [], []
    for f, name in enumerate(families):
        for notice in NOTICES[name]:
            w = notice.split()
            for _ in range(12):
                cut = w[:max(3, int(len(w) * rng.uniform(0.6, 1.0)))]
                other = NOTICES[name][rng.integers(len(NOTICES[name]))]
                out += [notice, f"{some()} {notice}", f"{notice} {some()}", " ".join(cut), f"{notice} {other}"]
                label += [f] * 5
    for p in background:
        out.append(p)
        label.append(len(families))
    for p in LOOKALIKES:
        for _ in range(12):
            out += [p, f"{some()} {p}", f"{p} {some()}"]
            label += [len(families)] * 3
    return out, label


def train(background: list[str], rounds: int = 150, rate: float = 0.5, decay: float = 1e-4, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    families = sorted(NOTICES)
    texts, label = examples(background, rng)
    label = np.array(label)
    pairs_of = lambda t: np.unique(grams(*words_of([t]), 2)[0])
    templates = [[pairs_of(n) for n in NOTICES[f]] for f in families]
    all_h = words_of([n for f in families for n in NOTICES[f]])
    vocab = np.unique(np.concatenate([grams(*all_h, k)[0] for k in (1, 2, 3)]))
    k = len(families) + 1
    m = Model(families, vocab, np.zeros((len(vocab), k)), np.zeros(k), 1.0, 0.5,
              np.unique(np.concatenate([t for f in templates for t in f])), templates)
    h, rows = words_of(texts)
    feature, row = m.features(h, rows)
    x = np.zeros((len(texts), len(vocab)), np.float32)
    x[row, feature] = 1
    held = rng.random(len(texts)) < 1 / 3
    y = np.eye(k, dtype=np.float32)[label]
    share = (1 / np.maximum(1, np.bincount(label[~held], minlength=k)))[label[~held]]
    share = (share / share.sum()).astype(np.float32)[:, None]
    a, b = x[~held], y[~held]
    w, c = np.zeros((len(vocab), k), np.float32), np.zeros(k, np.float32)
    for _ in range(rounds):  # classes weigh the same
        d = (softmax(a @ w + c) - b) * share
        w -= rate * 10 * (a.T @ d + decay * w)
        c -= rate * 10 * d.sum(0)
    m.weights, m.bias = w.astype(float), c.astype(float)
    z, t = x[held] @ w + c, label[held]
    loss = lambda s: -np.log(np.maximum(softmax(z / s)[np.arange(len(t)), t], 1e-12)).mean()
    m.temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))
    p = softmax(z / m.temperature)[:, :-1].max(1)
    worst = p[t == k - 1]  # held-out paragraphs of no licence: at most one in 200 passes
    m.threshold = float(min(0.95, max(0.5, np.quantile(worst, 0.995)))) if len(worst) else 0.5
    return m


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of the lines, a text's end being a line's end as well."""
    return np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))


def scan(df: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_paragraphs, n_licensed, families, family and score of every row."""
    own = [("n_paragraphs", pa.int64()), ("n_licensed", pa.int64()), ("families", pa.list_(pa.string())),
           ("family", pa.string()), ("score", pa.float64())]
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        quick = np.zeros(1 << 16, bool)
        quick[(m.pairs & np.uint64(0xFFFF)).astype(np.int64)] = True
        for b in text_batches(batches, text_col):
            data = LOWER[b.data]
            lines = paragraphs(b.data, b.offsets)
            starts, ends, rows = word_spans(data, lines, ALNUM_WORD)
            h = word_hashes(data, starts, ends)
            line_doc = np.searchsorted(b.offsets, lines[:-1], "right") - 1
            count = np.bincount(line_doc[np.diff(rows) > 0], minlength=b.rows)
            g, row = grams(h, rows, 2)
            maybe = np.flatnonzero(quick[(g & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(m.pairs, g[maybe]), len(m.pairs) - 1)
            maybe = maybe[m.pairs[at] == g[maybe]]
            asked = np.flatnonzero(np.bincount(row[maybe], minlength=len(lines) - 1) >= MIN_COMMON)
            found: list[list[tuple]] = [[] for _ in range(b.rows)]
            if len(asked):
                size = np.diff(rows)[asked]
                sub = np.concatenate([[0], np.cumsum(size)])
                pick = np.arange(sub[-1]) - np.repeat(sub[:-1], size) + np.repeat(rows[asked], size)
                p = m.probabilities(h[pick], sub)
                for i, line in enumerate(asked):
                    f = int(p[i, :-1].argmax())
                    if p[i, f] >= m.threshold and p[i, f] > p[i, -1] and m.confirms(
                            f, gram_hashes(h[rows[line]:rows[line + 1]], 2)):
                        found[line_doc[line]].append((float(p[i, f]), m.families[f]))
            best = [min(x, key=lambda y: (-y[0], y[1])) if x else (None, None) for x in found]
            cols = {c: b.batch.column(c) for c in keep}
            yield out_batch(pa.schema([*((c, x.type) for c, x in cols.items()), *own]), **cols,
                            n_paragraphs=count, n_licensed=[len(x) for x in found],
                            families=[sorted({f for _, f in x}) for x in found],
                            family=[f for _, f in best], score=[s for s, _ in best])

    return arrow_map(df.select(*dict.fromkeys([*keep, text_col])), run, out_schema(
        df, keep, "n_paragraphs long, n_licensed long, families array<string>, family string, score double"))


def background(df: DataFrame, text_col: str = "text", sample_texts: int = 300, limit: int = 2000,
               most_bytes: int = 4 << 20) -> list[str]:
    """Paragraphs of no licence, from the distinct texts with the smallest content hashes (a bounded sample).

    Of the distinct lines of these whole texts those with the smallest content
    hashes are looked at, 4 * ``limit`` at most and until ``most_bytes`` are
    reached; a line is never cut. The first ``limit`` of them that resemble no
    notice are returned, so the bounds favour no script, place or spelling.
    """
    texts = df.select(F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h")).where(F.length("t") > 0)
    # hashes first: only texts of the sample leave their tasks
    last = texts.select("h").distinct().orderBy("h").limit(sample_texts).agg(F.max("h")).first()[0]
    texts = texts.where(F.col("h") <= F.lit(last))
    lines = texts.select(F.explode(F.split("t", "\n")).alias("line")).where(
        F.col("line").rlike(r"\S")).distinct().withColumn("h", F.xxhash64("line"))
    # at most 4 * limit rows, numbered in one task
    few = lines.orderBy("h", "line").limit(4 * limit)
    before = F.sum(F.octet_length("line")).over(Window.orderBy("h", "line").rowsBetween(Window.unboundedPreceding, -1))
    picked = few.withColumn("before", F.coalesce(before, F.lit(0))).where(
        F.col("before") < most_bytes).orderBy("h", "line").collect()
    known = np.unique(np.concatenate([grams(*words_of([n]), 2)[0] for v in NOTICES.values() for n in v]))
    clean = [r["line"] for r in picked
             if r["line"].strip() and np.isin(grams(*words_of([r["line"]]), 2)[0], known).sum() < MIN_COMMON]
    return clean[:limit]


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(background(docs)))
