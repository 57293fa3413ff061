"""Operator 5: licence paragraphs by a trained classifier, with only DataFrame functions over the corpus.

Paragraphs are what blank lines, or lines of comment signs alone, set apart; line breaks and comment signs within
are spaces, so a notice may be wrapped in any way. Long paragraphs are cut into overlapping spans of words.

A multinomial logistic regression over sparse word n-grams is trained on the driver from the fixed
texts below (cut, shortened and set among filler words), with an unknown class for paragraphs about
licences that name none of the families, and a temperature fitted on texts that were left out of training, so that
probabilities can be read as such. Its features are the n-grams that hold one of the key words: a span without any
has the bias alone, which is unknown, so such spans need no look. The weights are a table of bounded size.

Over the corpus, spans are n-grammed, joined with the weights and summed by class; the softmax, the choice
and the comparison with the family's templates, which confirms it, are columns.
"""

from __future__ import annotations

import random
import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, saved

# Public licence notices by family, and paragraphs that only sound like one.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "MIT License Copyright (c)",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Distributed under the GPL v2 license.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Distributed under the GNU LGPL 2.1 license.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Distributed under the AGPL v3 license.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "CC BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution NonCommercial license, no commercial use.",
    ],
    "CC BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution ShareAlike License.",
    ],
    "CC BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Except where otherwise noted, content is available under the Creative Commons Attribution license.",
        "Text available under CC BY 4.0.",
    ],
    "Public domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
        "Dedicated to the public domain under CC0 without copyright.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "All rights reserved": [
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced or distributed without prior written permission of the publisher.",
        "Copyright (c) by the author, all rights reserved worldwide.",
    ],
}
UNKNOWN = [
    "He lost his driving license in the spring.",
    "The fishing licence costs ten pounds a year.",
    "The warranty of the car covers two years.",
    "She asked for permission to leave the room.",
    "The licence fee pays for public television.",
    "Licensed doctors work in the hospital.",
    "The copyright office is in the capital.",
    "Under the law the general public may use the public road.",
    "The permit was licensed under the old rules.",
    "See the license for details.",
    "The house of commons met in the capital and granted the request.",
    "The helicopter is called Apache and the hills are reserved for it.",
    "The seats are reserved and rights of way are granted by the town.",
    "The attribution of the painting to the master is doubtful.",
    "Gnu herds cross the river when the eclipse is near.",
    "Das Haus mit dem Garten und der Hund mit der Katze.",
    "Redistribution of wealth is a question of politics.",
    "The public domain of the state includes roads and rivers.",
    "Permission is granted by the office to any person with a permit.",
    "All rights of the citizens are protected by law.",
    "",
]
#: Licences of no family here, with NAME for a name that means nothing: they are unknown as well.
OTHERS = [
    "Licensed under the NAME License.",
    "This work is licensed under the NAME Public License, version 3.",
    "Released under the NAME License 2.0.",
    "SPDX-License-Identifier: NAME-1.0",
    "You may use this file under the terms of the NAME license agreement.",
    "The NAME license applies to this program and its copies.",
]
#: Every feature of the model holds one of these words.
KEYS = tuple(
    "license licenses licensed licence licences licenced copyright copyrighted permission granted hereby redistribution redistributions redistribute redistributed spdx gpl lgpl agpl gnu mpl mozilla apache bsd "
    "unencumbered cc0 cc commons waived reserved epl eclipse isc attribution noncommercial sharealike affero domain".split()
)

#: Lines that set paragraphs apart, and what sets words apart (in lower case).
BLANK = r"\n[ \t\r\n#*/;%>-]*\n"
BETWEEN = "[^a-z0-9]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a span, and from one span's start to the next: any notice of STRIDE words lies in one span as a whole.
SPAN, STRIDE = 80, 40
#: A class is named at this probability or more; and confirmed at this share of a template's n-grams.
NAMED, CONFIRMED = 0.5, 0.6
CLASSES = ("unknown", *TEMPLATES)
FOLDS = 4


def grams(words: list[str]) -> set[str]:
    """Words, pairs and triples."""
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def split_words(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.translate(str.maketrans(CAPITALS, SMALL))) if w]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(seed: int) -> list[tuple[set[str], int, int]]:
    """(n-grams, class, fold) of texts and their variants; all variants of a text are in its fold."""
    rng = random.Random(seed)
    filler = sorted({w for t in UNKNOWN for w in split_words(t)} | {f"w{i}" for i in range(60)})
    rows = []
    for label, name in enumerate(CLASSES):
        for k, text in enumerate([*UNKNOWN, *OTHERS] if name == "unknown" else TEMPLATES[name]):
            for copy in range(10):
                words = split_words(text.replace("NAME", f"q{rng.randrange(10**6)} " * rng.randrange(1, 3)))
                if copy:
                    words = [w for w in words if rng.random() > 0.08]
                    if len(words) > 16 and rng.random() < 0.3:
                        cut = rng.randrange(len(words) // 4)
                        words = words[cut:] if rng.random() < 0.5 else words[: len(words) - cut]
                    before, after = ([rng.choice(filler) for _ in range(rng.randrange(8))] for _ in range(2))
                    words = before + words + after
                rows.append((grams(words), label, k % FOLDS))
    for k in range(200):  # filler, and single words of templates among filler, name no licence
        words = [rng.choice(filler) for _ in range(rng.randrange(3, 25))]
        words.insert(rng.randrange(len(words)), rng.choice(split_words(rng.choice(TEMPLATES[rng.choice(CLASSES[1:])]))))
        words.insert(rng.randrange(len(words)), rng.choice(KEYS))
        rows.append((grams(words), 0, k % FOLDS))
    return rows


def _fitted(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 6.0, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    weights, bias = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    bias[0] = 1.0  # nothing known of a span: unknown
    for _ in range(rounds):
        error = (_softmax(x @ weights + bias) - y) / len(x)
        weights -= rate * (x.T @ error + decay * weights)
        bias[1:] -= rate * error[:, 1:].sum(axis=0)
        bias[1:] = np.minimum(bias[1:], -1.0)
    return weights, bias


@cache
def model(seed: int = 7) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
    """Weights by n-gram, bias and temperature, trained from the fixed texts."""
    weights, bias, temperature, _ = calibrated(seed)
    return weights, bias, temperature


@cache
def calibrated(seed: int = 7) -> tuple[dict[str, np.ndarray], np.ndarray, float, list[tuple[float, bool]]]:
    """model(), and of every held-out variant the probability of its named class and whether that is right."""
    rows = _examples(seed)
    keys = set(KEYS)
    texts = [*UNKNOWN, *OTHERS, *sum(TEMPLATES.values(), [])]
    vocabulary = {g: i for i, g in enumerate(sorted({g for t in texts for g in grams(split_words(t)) if keys & set(g.split()) and "name" not in g.split()}))}
    x = np.zeros((len(rows), len(vocabulary)))
    for row, (own, _, _) in zip(x, rows, strict=True):
        row[[vocabulary[g] for g in own if g in vocabulary]] = 1
    label, fold = (np.array([r[k] for r in rows]) for k in (1, 2))
    y = np.eye(len(CLASSES))[label]
    held = np.zeros_like(y)  # what models say that have not seen the text in any variant
    for f in range(FOLDS):
        weights, bias = _fitted(x[fold != f], y[fold != f])
        held[fold == f] = x[fold == f] @ weights + bias
    loss = {t: -np.log(np.maximum((_softmax(held / t) * y).sum(axis=1), 1e-12)).mean() for t in np.geomspace(0.25, 8, 41)}
    temperature = float(min(loss, key=loss.get))
    p = _softmax(held / temperature)
    seen = list(zip(p.max(axis=1).tolist(), (p.argmax(axis=1) == label).tolist(), strict=True))
    weights, bias = _fitted(x, y)
    return {g: weights[i].round(6) for g, i in vocabulary.items()}, bias.round(6), temperature, seen


def _grams(words: Column) -> Column:
    """grams() of an array of words, distinct, as columns."""
    size = F.size(words)

    def runs_of(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, n)))

    return F.array_distinct(F.concat(words, runs_of(2), runs_of(3)))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, CAPITALS, SMALL), BETWEEN), lambda w: w != "")


def licence_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, spans): row, id and the spans of every document's paragraphs that hold a key word; and for each span its class.

    Spans have row, line (from 0, among the document's spans), text (its words), family (a class or
    'unknown'), probability, similarity (largest share of a template's n-grams found) and confirmed.
    """
    spark = docs.sparkSession
    weights, bias, temperature = model()
    text, keys = column(text_col), F.array(*[F.lit(k) for k in KEYS])
    spans = F.flatten(
        F.transform(
            F.transform(F.split(text, BLANK), _words),
            lambda w: F.transform(F.sequence(F.lit(1), F.lit(1) + F.ceil(F.greatest(F.size(w) - SPAN, F.lit(0)) / STRIDE).cast("int") * STRIDE, F.lit(STRIDE)), lambda i: F.slice(w, i, SPAN)),
        )
    )
    spans = F.filter(spans, lambda w: F.arrays_overlap(w, keys))
    found = saved(docs.select(F.monotonically_increasing_id().alias("row"), column(id_col).alias("id"), F.when(F.arrays_overlap(_words(text), keys), spans).alias("spans")), "spans")
    par = found.select("row", F.posexplode("spans").alias("line", "words")).select("row", "line", F.concat_ws(" ", "words").alias("text"), _grams(F.col("words")).alias("grams"))
    schema = "gram string, " + ", ".join(f"w{k} double" for k in range(len(CLASSES)))
    table = F.broadcast(spark.createDataFrame([(g, *map(float, w)) for g, w in weights.items()], schema))  # fixed size: the n-grams of the texts above
    sums = (
        par.select("row", "line", F.explode("grams").alias("gram")).join(table, "gram")
        .groupBy("row", "line").agg(*[F.sum(f"w{k}").alias(f"z{k}") for k in range(len(CLASSES))])
    )
    z = [(F.coalesce(F.col(f"z{k}"), F.lit(0.0)) + float(b)) / temperature for k, b in enumerate(bias)]
    scored = par.join(sums, ["row", "line"], "left").withColumn("z", F.array(*z))
    top = F.array_max("z")
    best = F.array_position("z", top).cast("int")
    scored = scored.withColumn("p", 1 / F.aggregate("z", F.lit(0.0), lambda acc, v: acc + F.exp(v - top))).withColumn("best", best)
    names = F.array(*[F.lit(c) for c in CLASSES])
    family = F.when(F.col("p") >= NAMED, F.element_at(names, F.col("best"))).otherwise(F.lit("unknown"))
    shares = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        own = [sorted(grams(split_words(t))) for t in texts]
        share = F.greatest(*[F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in t]))) / F.lit(float(len(t))) for t in own])
        shares = F.when(F.col("family") == name, share).otherwise(shares)
    out = scored.withColumn("family", family).withColumn("similarity", shares)
    return found, out.select("row", "line", "text", "family", F.col("p").alias("probability"), "similarity", ((F.col("family") != "unknown") & (F.col("similarity") >= CONFIRMED)).alias("confirmed"))


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What licences each document names.

    Returns a row per row of docs: id_col, n_paragraphs (spans of paragraphs with a key word), n_confirmed, licences
    (confirmed families, sorted, comma-joined; '' if none), unconfirmed (families that no template
    confirmed, likewise), probability (the largest of a confirmed paragraph, else null). Null and empty
    texts have none; long ones are read whole. Null ids and repeated rows give a row each. No rows: no rows. Other columns are not read.
    """
    found, paragraphs = licence_paragraphs(docs, id_col, text_col)
    by = paragraphs.groupBy("row").agg(
        F.sum(F.col("confirmed").cast("long")).alias("n_confirmed"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family"))))).alias("licences"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(~F.col("confirmed") & (F.col("family") != "unknown"), F.col("family"))))).alias("unconfirmed"),
        F.max(F.when(F.col("confirmed"), F.col("probability"))).alias("probability"),
    )
    return found.join(by, "row", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_paragraphs"),
        F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"),
        F.coalesce("licences", F.lit("")).alias("licences"),
        F.coalesce("unconfirmed", F.lit("")).alias("unconfirmed"),
        "probability",
    )
