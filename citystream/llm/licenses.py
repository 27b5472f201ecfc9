"""License scans (operator 9): a trained classifier of paragraphs' word spans, from DataFrame functions only.

A paragraph is a run of lines that hold a letter or digit; its lines are joined, so
comment marks and line breaks don't matter. Its spans are scored: those that are at most
WIDEST times as long as a template, so several notices of a paragraph are told apart. Their features are word n-grams, and a
multinomial logistic regression with sparse weights (an L1 step after each
gradient step) tells the licence families and the class `unknown` apart. It is
trained on the driver from the templates below, in bounded numbers of altered
copies, and on a bounded sample of the corpus' own lines as `unknown`. The
unknown class also has altered copies of notices of licences that are no family
here (OTHERS). It is calibrated on lines and altered copies that training does not
see: its intercept is raised until at most FALSE_SHARE of the held-out unknown
lines are taken for a licence, and a family needs a least probability that at most
FALSE_SHARE of the held-out notices of other licences reach.

A prediction counts only where the span names its family (holds an n-gram that only
that family's templates have), and a template of its family confirms it: the share of
the template's n-grams that the span holds must reach CONFIRM. The next CONTEXT words
count with the span as far as they are known from other licences' notices ("permitted for
research only"). So in Spark only spans
are scored that a template confirms, and only texts are cut that hold a key. Keys
follow from the templates and CONFIRM alone: what holds that share of a template's n-grams
holds one of its keys, so nothing is lost, however frequent a notice or its words are in
the corpus. The n-grams of the distinct spans are joined with the weights (bounded by the
templates' n-grams) and summed up. Of spans that overlap the one that holds
most n-grams counts, then the shortest, then the first.

Defined results: a null text has no lines; a null id is carried; rows that
repeat an id and text give equal results; of templates that fit equally well
the first by name counts, and of families likewise; an empty table gives an
empty result; other columns are ignored. Very long texts and lines are scanned
whole."""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.session import shared_root

UNKNOWN = "unknown"

#: Customary notices of each family.
TEMPLATES = {
    "AGPL": ["This program is licensed under the GNU Affero General Public License, version 3.", "Released under the GNU AGPL v3."],
    "Apache": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "Distributed under the Apache 2.0 license."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Use of this source code is governed by a BSD-style license.", "Released under the BSD 3-Clause License."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "This work is dedicated to the public domain under CC0 1.0."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.", "Released under the GNU GPL v2."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "Released under the GNU LGPL v3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSL": ["Distributed under the Boost Software License, Version 1.0.", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software."],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "Licensed under the Eclipse Public License."],
    "EUPL": ["Licensed under the European Union Public Licence, version 1.2.", "Licensed under the EUPL."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Released under the ISC License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Zlib": ["Released under the Zlib License.", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
}
TEMPLATES["Apache"].append("Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0.")

#: Identifiers of the families in the one-line form of the SPDX list.
SPDX = {"AGPL": ["AGPL-3.0"], "Apache": ["Apache-2.0"], "BSD": ["BSD-3-Clause"], "BSL": ["BSL-1.0"], "CC-BY": ["CC-BY-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC0": ["CC0-1.0"],
        "EPL": ["EPL-2.0"], "EUPL": ["EUPL-1.2"], "GPL": ["GPL-3.0"], "ISC": ["ISC"], "LGPL": ["LGPL-2.1"], "MIT": ["MIT"], "MPL": ["MPL-2.0"], "Unlicense": ["Unlicense"], "Zlib": ["Zlib"]}
for _family, _names in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {name}" for name in _names]

#: Customary notices of licences that are no family here. They are `unknown`.
OTHERS = [
    "Released under the Artistic License 2.0.", "Licensed under the Open Software License version 3.0.", "Released under the Open Software License.", "Licensed under the Academic Free License version 3.0.",
    "This file is licensed under the Microsoft Public License.", "Released under the Microsoft Reciprocal License.", "Licensed under the Common Development and Distribution License.",
    "Released under the PostgreSQL License.", "This Font Software is licensed under the SIL Open Font License, Version 1.1.", "Licensed under the Python Software Foundation License Version 2.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted for non-commercial research only.", "Redistribution and use are permitted for academic and non-commercial purposes only.",
    "Use of this source code is governed by a proprietary license.", "Use of this source code is governed by a commercial license agreement.", "Licensed under the Business Source License 1.1.",
    "Licensed under the Server Side Public License, version 1.", "Licensed under the Elastic License 2.0.", "Released under the WTFPL.", "Released under the terms of the Beerware license.",
    "Licensed under the terms of the commercial license agreement.", "This software is released under a proprietary license. All rights reserved.", "SPDX-License-Identifier: Proprietary",
    "This work is licensed under the Open Government Licence, version 3.0.", "Licensed under the Open Data Commons Open Database License.", "Released under the Ruby License.", "Licensed under the PHP License, version 3.01.",
    "Permission to copy this software is granted for evaluation only.", "This program is licensed under the Aladdin Free Public License.", "Licensed under the Sleepycat License.", "This library is licensed under the Qt Commercial License.",
]

GRAMS = (1, 2, 3)
#: Bounds of training: altered copies of each template, sampled lines of the corpus.
COPIES = 40
SAMPLE_LINES = 4096
EPOCHS = 60
L1 = 2e-4
FALSE_SHARE = 0.001
CONFIRM = 0.5
#: Least probability of a family, whatever calibration says.
LEAST = 0.5
#: Words behind a span that may tell that it is of another licence after all.
CONTEXT = 6
#: A notice's span has at most so many times its template's words.
WIDEST = 2
#: Words at which the spans of one row of work begin.
STARTS = 64


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in GRAMS for i in range(len(words) - n + 1)}


def word_grams(line: Column) -> Column:
    """The line's distinct word n-grams, as grams_of gives them."""
    words = F.regexp_extract_all(F.lower(line), F.lit("[a-z0-9]+"), F.lit(0))

    def runs(n: int) -> Column:
        own = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, own).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(runs, GRAMS)))


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]  # the last one is UNKNOWN
    weights: dict[str, tuple[float, ...]]  # of each n-gram, above those of unknown
    intercepts: tuple[float, ...]
    seen: dict[str, int]  # sampled lines that hold a word of the templates
    least: float = LEAST  # probability that a family needs


def naming(templates: dict[str, list[str]], others: list[str]) -> dict[str, str]:
    """N-grams that occur in one family's templates and in no other's, nor in other licences'
    notices, with that family."""
    held = {f: set().union(*(grams_of(words_of(t)) for t in texts)) for f, texts in templates.items()}
    strange = set().union(*(grams_of(words_of(t)) for t in others)) if others else set()
    return {g: f for f, grams in held.items() for g in grams - strange if sum(g in h for h in held.values()) == 1}


def needed(text: str) -> int:
    """N-grams of a template that CONFIRM asks for."""
    n = len(grams_of(words_of(text)))
    return next(k for k in range(1, n + 1) if k >= CONFIRM * n)


def keys(templates: dict[str, list[str]], seen: dict[str, int]) -> list[str]:
    """Words one of which everything has that holds CONFIRM of a template: the n-grams without
    any of them are too few. `seen` (uses in the corpus) only makes them rare ones."""
    chosen: set[str] = set()
    for text in sorted(t for texts in templates.values() for t in texts):
        grams = [set(g.split(" ")) for g in grams_of(words_of(text))]
        for word in sorted(set().union(*grams), key=lambda w: (seen.get(w, 0), w)):
            if sum(not g & chosen for g in grams) < needed(text):
                break
            chosen.add(word)
    return sorted(chosen)


def sample(docs: DataFrame, text_col: str, templates: dict[str, list[str]] = TEMPLATES) -> list[str]:
    """At most SAMPLE_LINES lines of the corpus, a repeatable choice by hash: of each
    of SAMPLE_LINES / 4 buckets of the texts' hash the text with the least one, and four of
    its lines, spread over it. A line that with its surroundings holds CONFIRM of a template is left out."""
    texts = docs.select(F.col(text_col).alias("t")).filter("t IS NOT NULL").withColumn("h", F.xxhash64("t"))
    chosen = texts.select("h").groupBy(F.pmod("h", F.lit(SAMPLE_LINES // 4)).alias("b")).agg(F.min("h").alias("h")).select("h")
    # SAMPLE_LINES / 4 rows at most, so they go to the texts
    lines = texts.join(F.broadcast(chosen), "h", "left_semi").select("h", F.filter(F.split("t", "\\R"), lambda x: F.length(F.trim(x)) > 0).alias("l"))
    at = F.explode(F.array_distinct(F.array(*[F.floor(F.size("l") * k / 8).cast("int") + 1 for k in (1, 3, 5, 7)])))
    own = lines.filter(F.size("l") > 0).select("h", "l", at.alias("i")).withColumn("line", F.element_at("l", F.col("i")))
    before = F.concat_ws(" ", F.slice("l", F.greatest(F.col("i") - 4, F.lit(1)), F.least(F.col("i") - 1, F.lit(4))))
    after = F.concat_ws(" ", F.substring("line", 2001, 400), F.slice("l", F.col("i") + 1, 4))
    rows = own.select("h", F.substring("line", 1, 2000).alias("line"), F.substring(before, -400, 400).alias("before"), F.substring(after, 1, 400).alias("after")).distinct().collect()
    known = [grams_of(words_of(t)) for texts in templates.values() for t in texts]
    left = {(r["h"], r["line"]) for r in rows if not holds(" ".join((r["before"], r["line"], r["after"])), known)}
    return [line for _, line in sorted(left)]


def holds(text: str, known: list[set[str]]) -> bool:
    own = grams_of(words_of(text))
    return any(len(own & t) >= CONFIRM * len(t) for t in known)


def train(lines: list[str], templates: dict[str, list[str]], seed: int = 11, others: list[str] = OTHERS) -> Classifier:
    rng = np.random.default_rng(seed)
    known = [grams_of(words_of(t)) for texts in templates.values() for t in texts]
    vocabulary = sorted(set().union(*known, *(grams_of(words_of(t)) for t in others)))
    seen = dict(Counter(w for line in lines if not holds(line, known) for w in set(words_of(line)).intersection(vocabulary)))
    column = {g: i for i, g in enumerate(vocabulary)}
    families = (*sorted(templates), UNKNOWN)
    examples: list[tuple[set[str], int]] = []
    for k, family in enumerate(families[:-1]):
        for text in templates[family]:
            words = words_of(text)
            examples.append((grams_of(words), k))
            for _ in range(COPIES):  # some words lost, others of the corpus before and behind
                kept = [w for w in words if rng.random() > 0.08] or words
                around = words_of(lines[int(rng.integers(len(lines)))])[:8] if lines else []
                cut = int(rng.integers(len(around) + 1))
                examples.append((grams_of(around[:cut] + kept + around[cut:]), k))
    strange = len(examples)
    # corpus lines are unknown, but for those that hold most of a template
    for line in lines:
        if not holds(line, known):
            examples.append((grams_of(words_of(line)), len(families) - 1))
    own_lines = slice(strange, len(examples))
    # notices of other licences, as altered as those of the families
    foreign = len(examples)
    for text in others:
        words = words_of(text)
        for _ in range(COPIES):
            kept = [w for w in words if rng.random() > 0.08] or words
            around = words_of(lines[int(rng.integers(len(lines)))])[:8] if lines else []
            cut = int(rng.integers(len(around) + 1))
            examples.append((grams_of(around[:cut] + kept + around[cut:]), len(families) - 1))
    foreign = slice(foreign, len(examples))
    # single words of licences, out of place, are unknown as well
    for word in sorted({w for texts in templates.values() for t in texts for w in words_of(t)}):
        examples.append((grams_of((words_of(lines[int(rng.integers(len(lines)))])[:8] if lines else []) + [word]), len(families) - 1))
    x = np.zeros((len(examples), len(vocabulary)), np.float32)
    for i, (grams, _) in enumerate(examples):
        x[i, [column[g] for g in grams if g in column]] = 1
    y = np.asarray([k for _, k in examples])
    held = rng.random(len(y)) < 0.25
    fit = np.flatnonzero(~held)
    share = (1 / np.maximum(np.bincount(y[fit], minlength=len(families)), 1))[y].astype(np.float32)
    w, b = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32)
    rate = 0.5
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for at in range(0, len(order), 256):
            rows = order[at:at + 256]
            s = x[rows] @ w + b
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (share[rows] / share[rows].sum())[:, None]
            w -= rate * (x[rows].T @ p)
            b -= rate * p.sum(axis=0)
            w = np.sign(w) * np.maximum(np.abs(w) - rate * L1, 0)
    margin, base = w[:, :-1] - w[:, -1:], b[:-1] - b[-1]
    # calibration: how much the best family may exceed unknown on held-out unknown lines
    over = (x[own_lines][held[own_lines]] @ margin + base).max(axis=1, initial=-np.inf)
    most = float(np.quantile(over, 1 - FALSE_SHARE)) if len(over) else 0.0
    base = base - max(0.0, most, float(base.max()) + 1e-3)
    # the least probability: held-out notices of other licences that name a family and hold enough
    # of a template of it would count, so nearly all of them must stay below it
    names = naming(templates, others)
    scores = x @ margin + base
    odds = np.exp(scores - np.maximum(scores.max(axis=1), 0)[:, None])
    share = odds / (odds.sum(axis=1) + np.exp(-np.maximum(scores.max(axis=1), 0)))[:, None]
    taken = []
    for i in [*np.flatnonzero(held[foreign]) + foreign.start, *np.flatnonzero(held[own_lines]) + own_lines.start]:
        best, grams = families[int(scores[i].argmax())], examples[i][0]
        enough = any(len(grams & grams_of(words_of(t))) >= needed(t) for t in templates[best])
        taken.append(float(share[i].max()) if enough and any(names.get(g) == best for g in grams) else 0.0)
    least = max(LEAST, float(np.quantile(taken, 1 - FALSE_SHARE)) if taken else 0.0)
    used = np.flatnonzero(np.abs(margin).max(axis=1) > 1e-4)
    return Classifier(families, {vocabulary[i]: tuple(float(round(v, 5)) for v in margin[i]) for i in used}, tuple(float(v) for v in base), seen, least)


def _table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from a literal."""
    names = [c.split(" ")[0] for c in schema.split(", ")]
    data = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(data), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))))


def chunks(docs: DataFrame, rare: list[str], templates: dict[str, list[str]], id_col: str, text_col: str) -> DataFrame:
    """doc_id, row, base, words (w, line): of every text with a key (`rare`) the runs of words that hold one. A
    span begins in the first STARTS words of one run and ends in it. A line without letter or digit is the word ''."""
    reach = STARTS + WIDEST * max(len(words_of(t)) for texts in templates.values() for t in texts)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(F.lower("text").rlike("(?<![a-z0-9])(?:" + "|".join(rare) + ")(?![a-z0-9])"))

    def words(said: Column, line: Column) -> Column:
        w = F.when(said.rlike("[\\p{L}\\p{N}]"), F.regexp_extract_all(F.lower(said), F.lit("[a-z0-9]+"), F.lit(0))).otherwise(F.array(F.lit("")))
        return F.transform(w, lambda x: F.struct(x.alias("w"), line.alias("line")))

    whole = own.select("doc_id", F.xxhash64("text").alias("row"), F.flatten(F.transform(F.split("text", "\\R"), words)).alias("all"))
    bases = F.sequence(F.lit(0), F.size("all") - 1, F.lit(STARTS))
    runs = F.transform(bases, lambda b: F.struct(b.alias("base"), F.slice("all", b + 1, reach).alias("words")))
    held = F.filter(runs, lambda r: F.exists(r["words"], lambda x: x["w"].isin(rare)))
    return whole.filter(F.size("all") > 0).select("doc_id", "row", F.inline(held)).distinct()


def spans(runs: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """doc_id, row, line, at, width, said, after, family, template, held, likeness: every span that holds
    CONFIRM of a template and ends with the first hold of one of its n-grams."""
    table = _table(runs.sparkSession, [
        (f, t, sorted(grams_of(words_of(t))), WIDEST * len(words_of(t)), needed(t))
        for f in sorted(templates) for t in templates[f]], "family string, template string, parts array<string>, widest int, need int")

    def grams(n: int) -> Column:
        ends = F.size("w") - n + 1
        own = F.transform(F.sequence(F.lit(1), F.greatest(ends, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " "))
        return F.when(ends > 0, own).otherwise(F.array().cast("array<string>"))

    own = runs.withColumn("w", F.col("words.w"))
    own = own.select("doc_id", "row", "base", "w", F.col("words.line").alias("lines"), *[grams(n).alias(f"g{n}") for n in GRAMS])
    every = sorted(set().union(*(grams_of(words_of(t)) for texts in templates.values() for t in texts)))
    own = own.withColumn("known", F.array_distinct(F.filter(F.concat(*[f"g{n}" for n in GRAMS]), lambda g: g.isin(every))))
    # a run that holds too few of a template's n-grams has no span of it
    own = own.filter(F.size("known") >= min(needed(t) for texts in templates.values() for t in texts))
    own = own.join(F.broadcast(table), F.size(F.array_intersect("known", "parts")) >= F.col("need"))
    # the number of each n-gram among the template's, 0 for others
    own = own.select("doc_id", "row", "base", "w", "lines", "family", "template", "widest", "need", F.size("parts").alias("n_parts"), *[F.transform(f"g{n}", lambda g: F.array_position("parts", g).cast("int")).alias(f"g{n}") for n in GRAMS])

    def firsts(i: Column) -> Column:
        """Sorted widths at which a span from word i comes to hold another n-gram of the template."""
        stop = F.array_position(F.slice("w", i, F.col("widest")), "").cast("int")  # a paragraph's end
        width = F.when(stop > 0, stop - 1).otherwise(F.col("widest"))

        def ends(n: int) -> Column:
            return F.transform(F.slice(f"g{n}", i, F.greatest(width - n + 1, F.lit(0))), lambda g, k: F.struct(g.alias("g"), (k + n).alias("width")))

        holds_at = F.sort_array(F.filter(F.concat(*map(ends, GRAMS)), lambda x: x["g"] > 0))
        return F.array_sort(F.transform(F.array_distinct(holds_at["g"]), lambda g: F.element_at(holds_at, F.array_position(holds_at["g"], g).cast("int"))["width"]))

    starts = F.filter(F.sequence(F.lit(1), F.least(F.size("w"), F.lit(STARTS))), lambda i: F.element_at("g1", i) > 0)
    found_at = F.filter(F.transform(starts, lambda i: F.struct(i.alias("i"), firsts(i).alias("widths"))), lambda x: F.size(x["widths"]) >= F.col("need"))
    own = own.withColumn("start", F.explode(found_at)).select("*", F.posexplode("start.widths").alias("k", "width")).withColumn("held", F.col("k") + 1)
    # of equal widths the last one has the count
    more = F.coalesce(F.get("start.widths", F.col("held")), F.lit(0)) != F.col("width")
    own = own.filter((F.col("held") >= F.col("need")) & more)
    i = F.col("start.i")
    # the paragraph's next words
    behind = F.slice("w", i + F.col("width"), CONTEXT)
    stop = F.array_position(behind, "").cast("int")
    after = F.array_join(F.when(stop > 0, F.slice(behind, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(behind), " ")
    return own.select("doc_id", "row", F.element_at("lines", i).alias("line"), (F.col("base") + i).alias("at"), "width", F.array_join(F.slice("w", i, F.col("width")), " ").alias("said"), after.alias("after"), "family", "template", "held", (F.col("held") / F.col("n_parts")).alias("likeness"))


def found(docs: DataFrame, model: Classifier, templates: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, line (where it begins), family, probability, template, likeness of every confirmed notice.
    `row` tells rows apart that share an id: a hash of the text."""
    spark = docs.sparkSession
    names = model.families[:-1]
    near = spans(chunks(docs, keys(templates, model.seen), templates, id_col, text_col), templates).checkpoint()
    # the words behind a span count as far as they are of other licences' notices
    grams = near.select("said", "after").distinct().withColumn("gram", F.explode(word_grams(F.concat_ws(" ", "said", "after"))))
    own = set().union(*(grams_of(words_of(t)) for texts in templates.values() for t in texts))
    named = naming(templates, OTHERS)
    weights = _table(spark, [(g, list(model.weights.get(g, [0.0] * len(names))), named.get(g, ""), g in own) for g in sorted({*model.weights, *named})], "gram string, w array<double>, names string, own boolean")
    inside = F.concat(F.lit(" "), "said", F.lit(" ")).contains(F.concat(F.lit(" "), "gram", F.lit(" ")))
    sums = [F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(len(names))]
    scored = grams.join(F.broadcast(weights), "gram").filter(inside | ~F.col("own")).groupBy("said", "after").agg(*sums, F.collect_set(F.when(inside, F.col("names"))).alias("named"))
    scores = F.array(*[F.struct((F.col(f"s{k}") + F.lit(model.intercepts[k])).alias("score"), F.lit(-k).alias("order"), F.lit(n).alias("family")) for k, n in enumerate(names)])
    best = scored.withColumn("scores", scores).withColumn("best", F.array_max("scores")).filter((F.col("best.score") > 0) & F.array_contains("named", F.col("best.family")))
    # softmax with unknown at score 0
    odds = F.aggregate(F.transform("scores", lambda s: F.exp(s["score"] - F.col("best.score"))), F.lit(0.0), lambda a, v: a + v) + F.exp(-F.col("best.score"))
    sure = best.select("said", "after", F.col("best.family").alias("family"), F.round(F.lit(1.0) / odds, 6).alias("probability")).filter(F.col("probability") >= model.least)
    met = near.join(sure, ["said", "after", "family"])
    ranked = met.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct((-F.col("held")).alias("order"), "width", "at", "family", "template", "line", "probability", "likeness"))).alias("ranked"))

    def apart(chosen: Column, x: Column) -> Column:
        meets = F.exists(chosen, lambda c: (c["at"] < x["at"] + x["width"]) & (x["at"] < c["at"] + c["width"]))
        return F.when(meets, chosen).otherwise(F.concat(chosen, F.array(x)))

    first = ranked.select("doc_id", "row", F.inline(F.aggregate("ranked", F.filter("ranked", lambda x: F.lit(False)), apart)))
    return first.select("doc_id", "row", "line", "family", "probability", "template", "likeness")


def fitted(docs: DataFrame, text_col: str = "text", templates: dict[str, list[str]] = TEMPLATES) -> Classifier:
    return train(sample(docs, text_col, templates), templates)


def scan(docs: DataFrame, model: Classifier | None = None, templates: dict[str, list[str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licences (families found, sorted, joined by a comma), n_lines (lines at which a confirmed
    notice begins), probability (the least one of them, 0 without any) of every row."""
    shared_root(docs.sparkSession)
    model = model or fitted(docs, text_col, templates)
    hits = found(docs, model, templates, id_col, text_col).groupBy("doc_id", "row").agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("licences"), F.count_distinct("line").alias("n_lines"), F.min("probability").alias("probability")).checkpoint()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row"))
    at = rows["doc_id"].eqNullSafe(hits["doc_id"]) & (rows["row"] == hits["row"])
    return rows.join(hits, at, "left").select(rows["doc_id"], F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
