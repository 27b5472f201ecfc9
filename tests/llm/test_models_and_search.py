"""Language ID and licences by held-out accuracy, top-k and sharding by brute force, the pipeline."""

import dataclasses
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_docs import ROWS

import corpus_pipeline
from citystream.llm import language_id, licenses, queries, sharding, topk

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network(spark):
    return language_id.fitted(spark.read.parquet(f"{SF}/documents.parquet"))


def test_language_id_on_held_out_documents(spark, network):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language_id.predictions(docs, network).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_never_learns_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text of {i} " * 3, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in range(200)] + [(None, "nobody", "zz"), (3000, "no label", None)], "doc_id long, text string, lang string")
    assert {lang for lang, _ in language_id.sample(docs)} == {"en"}


def test_language_id_of_odd_rows(docs, none, network):
    got = Counter((r["doc_id"], r["held_out"], r["lang_pred"] == "und") for r in language_id.predictions(docs, network).collect())
    assert got == Counter((i, i is not None and zlib.crc32(str(i).encode()) % 4 == 2, t is None or not any(c.isalpha() for c in t)) for i, t, _ in ROWS)
    kept = language_id.identified(docs, dataclasses.replace(network, limit=1.0))
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, _ in ROWS)
    assert language_id.identified(docs, None).count() == 0
    assert language_id.predictions(none, network).count() == 0 and language_id.fitted(none) is None
    assert {r["lang_pred"] for r in language_id.predictions(docs, None).collect()} == {"und"}


def test_junk_and_unlearnt_languages_are_rejected(spark, network):
    junk = ["x 12 34 #### 55 ++ 9981", "a", "|||| ==== q ----", "これは日本語の文章です。今日はいい天気ですね。", "Это русский текст о погоде и природе.", "Ελληνικό κείμενο για τον καιρό", "한국어 문장입니다", "z9 z8 q7 ====", "12 345 ..."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(junk)], "doc_id long, text string")
    assert language_id.identified(df, network).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text rlike '\\\\p{L}{2}'")
    assert language_id.identified(docs, network).count() >= 0.99 * docs.count()


def test_network_equals_plain_convolutions(network):
    """Each filter at each byte, one by one, and the windows' weighted mean."""
    rng = np.random.default_rng(4)
    for text in ("Le chat est sur la table.", "x", "word " * 200, "é" * 300, rng.bytes(700).decode("latin-1")):
        data = text.encode()
        step, width = language_id.WINDOW - 3, max(language_id.WIDTHS)
        starts = range(0, max(1, len(data) - width + 1), step)
        total, weights = np.zeros(len(network.languages) + 1), 0
        for at in starts:
            window = data[at:at + language_id.WINDOW]
            padded = window + bytes(language_id.WINDOW - len(window))
            pooled = np.full(network.filters.shape[1], -np.inf)
            for k in range(language_id.WINDOW - width + 1):
                z = sum(network.embed[padded[k + j]] @ network.filters[j * language_id.EMBED:(j + 1) * language_id.EMBED] for j in range(width))
                pooled = np.maximum(pooled, z)
            s = np.maximum(pooled + network.bias, 0) @ network.out + network.out_bias
            e = np.exp(s - s.max())
            total += e / e.sum() * len(window)
            weights += len(window)
        names, score, none = language_id.label(network, pa.array([text]))
        assert names[0] == network.languages[int(total[:-1].argmax())] or not any(c.isalpha() for c in text)
        assert abs(none[0] - total[-1] / weights) < 1e-4 and abs(score[0] - total[:-1].max() / weights) < 1e-4


def test_gradients_by_differences():
    rng = np.random.default_rng(2)
    p, used = language_id.started(("a", "b"), rng)
    p = {k: v.astype(np.float64) for k, v in p.items()}
    used = used.astype(np.float64)
    x, y, weight = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8), np.asarray([0, 1, 2, 1, 0]), np.asarray([1.0, 0.5, 2.0, 1.0, 1.5])

    def loss(q):
        share = language_id.Network(("a", "b"), **q).probabilities(x)
        return float(-(weight * np.log(share[np.arange(5), y])).sum() / 5)

    found = language_id.gradients(language_id.Network(("a", "b"), **p), x, y, weight, used)
    for name, grad in found.items():
        flat = p[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grad.reshape(-1)) > 1e-6), 6):
            old, h = flat[i], 1e-6
            flat[i] = old + h
            above = loss(p)
            flat[i] = old - h
            below = loss(p)
            flat[i] = old
            assert abs((above - below) / (2 * h) - grad.reshape(-1)[i]) < 1e-5, name


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 1000, 5000):
        start, size, _ = language_id.layout(np.zeros(n, np.uint8), np.asarray([0, n]))
        runs = {b for s, k in zip(start.tolist(), size.tolist()) for b in range(s, s + k - (max(language_id.WIDTHS) - 1))}
        assert runs >= set(range(max(0, n - max(language_id.WIDTHS) + 1)))


def test_licences_by_family(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.fitted(docs)
    plain = {"Licensed under the Apache License, Version 2.0.": "Apache", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    truth = {r["doc_id"]: ",".join(sorted({f for line, f in plain.items() if line in r["text"]})) for r in docs.collect()}
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(docs, model).collect()}
    assert any(truth.values()) and got == truth
    # altered notices that were not in training
    odd = spark.createDataFrame([(1, "Some text.\nthis file is LICENSED under the apache license version 2.0 ok"), (2, "the licence of the poet, the public and the general"), (3, "Copyright law and permission"), (4, "Files are released under the terms of MIT License.")], "doc_id long, text string")
    assert {r["doc_id"]: r["licences"] for r in licenses.scan(odd, model).collect()} == {1: "Apache", 2: "", 3: "", 4: "MIT"}


def test_frequent_notice_is_found(spark):
    """A third of the documents open with one notice: its words are no reason to drop it."""
    said = "Licensed under the Apache License, Version 2.0."
    rows = [(i, (said + "\n" if i % 3 == 0 else "") + f"plain words of document {i}\nand the second line {i * 7}\nwith {i} more") for i in range(300)]
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: "Apache" if i % 3 == 0 else "" for i in range(300)}


def test_wrapped_notices(spark):
    """A notice may break over lines and stand behind comment marks, but not go over a paragraph's end."""
    bsd = ["Redistribution and use in source and binary forms,", "with or without modification, are permitted provided", "that the following conditions are met:"]
    mit = ["Permission is hereby granted, free of charge, to any", "person obtaining a copy of this software and", "associated documentation files, to deal in the", "Software without restriction."]
    gpl = ["This program is free software: you can redistribute", "it and/or modify it under the terms of the GNU General", "Public License."]
    cc = ["This work is licensed under a Creative Commons", "Attribution-NonCommercial 4.0 International License."]
    long = "word " * 500
    rows = [(1, "\n".join(bsd)), (2, "/*\n" + "\r\n".join(" * " + x for x in mit) + "\n */"), (3, "code\n" + "\n".join("# " + x for x in gpl)), (4, long + "\n".join(cc) + "\n" + long),
            (5, "\n\n".join(bsd)), (6, "\n # \n".join(" # " + x for x in bsd)), (7, "\n".join(cc + bsd + gpl + mit)), (8, long * 3 + " ".join(gpl) + "\n \n" + "\n".join(mit))]
    model = licenses.train(["one plain line", "another plain line"], licenses.TEMPLATES)
    got = {r["doc_id"]: (r["licences"], r["n_lines"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: ("BSD", 1), 2: ("MIT", 1), 3: ("GPL", 1), 4: ("CC-BY-NC", 1), 5: ("", 0), 6: ("", 0), 7: ("BSD,CC-BY-NC,GPL,MIT", 4), 8: ("GPL,MIT", 2)}


def test_licences_of_odd_rows(spark, docs, none):
    model = licenses.train(["one plain line", "another plain line"], licenses.TEMPLATES)
    got = Counter(map(tuple, licenses.scan(docs, model).select("doc_id", "licences", "n_lines").collect()))
    assert got == Counter((i, "CC-BY-NC,MIT" if i == 13 else "", 2 if i == 13 else 0) for i, _, _ in ROWS)
    assert licenses.scan(none, model).count() == 0
    assert licenses.scan(none).count() == 0


def test_other_licences_are_unknown(spark):
    model = licenses.fitted(spark.read.parquet(f"{SF}/documents.parquet"))
    said = {"Released under the Zlib License.": "Zlib", "Released under the ISC License.": "ISC", "Licensed under the Eclipse Public License": "EPL", "European Union Public Licence, version 1.2": "EUPL",
            "This file is licensed under the Microsoft Public License": "", "Released under the Artistic License.": "", "Licensed under the Open Software License": "", "Released under the Foo License.": "",
            "Redistribution and use in source and binary forms, with or without modification, are permitted for non-commercial research only": "", "Redistribution is permitted for non-commercial research only": "",
            "Licensed under the Mulan Permissive Software License, Version 2": "", "released under the terms of the Nokia Open Source License": "", "You may use this under the W3C Software License": "",
            "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "", "SPDX-License-Identifier: LicenseRef-Own": "",
            "SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache", "SPDX-License-Identifier: GPL-2.0-or-later": "GPL", "Distributed under the Boost Software License, Version 1.0.": "BSL",
            "Licensed to the Apache Software Foundation (ASF) under one\n or more contributor license agreements.  See the NOTICE file\n distributed with this work for additional information\n regarding copyright ownership.": "Apache",
            "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish": "Unlicense",
            "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": "ISC"}
    rows = list(enumerate(said))
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {text: got[i] for i, text in rows} == said


def slow_scan(text, model, templates):
    """All spans of all paragraphs, scored one by one."""
    words = []
    for n, line in enumerate(re.split(r"\r\n|[\n\x0b\f\r\x85\u2028\u2029]", text)):
        words += [(w, n) for w in (licenses.words_of(line) if any(c.isalnum() for c in line) else [""])]
    known = [(f, t, licenses.grams_of(licenses.words_of(t)), licenses.WIDEST * len(licenses.words_of(t))) for f in templates for t in templates[f]]
    names, own = licenses.naming(templates, licenses.OTHERS), set().union(*(g for *_, g, _ in known))
    rated, found = {}, []
    for i in range(len(words)):
        for width in range(1, len(words) - i + 1):
            run = [w for w, _ in words[i:i + width]]
            if run[-1] == "":
                break
            grams, shorter = licenses.grams_of(run), licenses.grams_of(run[:-1])
            for family, template, parts, widest in known:
                held = len(grams & parts)
                if width <= widest and run[0] in parts and held >= licenses.needed(template) and held > len(shorter & parts):
                    behind = [w for w, _ in words[i + width:i + width + licenses.CONTEXT]]
                    behind = behind[:behind.index("")] if "" in behind else behind
                    key = (tuple(run), tuple(behind))
                    if key not in rated:
                        used = grams | {g for g in licenses.grams_of(run + behind) if g not in own}
                        scores = np.asarray(model.intercepts) + sum(np.asarray(model.weights[g]) for g in sorted(used) if g in model.weights)
                        best = int(scores.argmax())
                        top = max(scores[best], 0)
                        rated[key] = model.families[best], scores[best], float(np.exp(scores[best] - top) / (np.exp(scores - top).sum() + np.exp(-top)))
                    best, score, share = rated[key]
                    if best == family and score > 0 and share >= model.least and any(names.get(g) == family for g in grams):
                        found.append((-held, width, i, family, template, words[i][1]))
    chosen = []
    for f in sorted(found):
        if all(f[2] + f[1] <= c[2] or c[2] + c[1] <= f[2] for c in chosen):
            chosen.append(f)
    return ",".join(sorted({c[3] for c in chosen})), len({c[5] for c in chosen})


def test_scan_equals_the_slow_scorer(spark):
    rnd = random.Random(3)
    model = licenses.fitted(spark.read.parquet(f"{SF}/documents.parquet"))
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts] + licenses.OTHERS
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            words = rnd.choice(notices).split(" ")
            words = [w for w in words if rnd.random() > 0.1]
            for _ in range(rnd.randint(0, 2)):
                words.insert(rnd.randrange(len(words) + 1), rnd.choice(["\n", "for research only", "license", "word", "\n\n", "MIT"]))
            parts.append(" ".join(words))
        rows.append((i, rnd.choice([" ", "\n", "\n\n", " plain words between "]).join(parts)))
    got = {r["doc_id"]: (r["licences"], r["n_lines"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {i: slow_scan(t, model, licenses.TEMPLATES) for i, t in rows}
    assert sum(bool(f) for f, _ in got.values()) > 10


def brute_top(rows, every, k):
    out = []
    for qi, q in rows:
        if qi is not None and qi % every == 0:
            found = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(q, v)))), i) for i, v in rows if i is not None and i != qi and len(v) == len(q))
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return Counter(out)


@pytest.mark.parametrize("block,query_block", [(16, 2), (16, 4096), (4096, 4096)])
def test_top_k_of_odd_vectors(spark, monkeypatch, block, query_block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", query_block)
    rng = np.random.default_rng(2)
    whole = [(i, [int(x) for x in rng.integers(-3, 4, 5)]) for i in range(150)]
    whole += [(200 + i, [1, 1, 1, 1, 1]) for i in range(30)] + [(300, [1, 2]), (301, [3, 4]), (350, [2 ** 40, 1, 1, 1, 1]), (None, [1, 1, 1, 1, 1])]
    whole += [(199, [k, 0, 0, 0, 1]) for k in range(40)] + [(199, [5, 0, 0, 0, 1])] * 5  # one id, many rows
    rows = [(i, [x / 256 + 1e-9 for x in v]) for i, v in whole]
    bad = [(400, None), (401, []), (402, [1.0, None, 1.0, 1.0, 1.0]), (450, [float("nan")] * 5), (403, [float("inf")] * 5), (500, [1.7e308] * 5)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as dim", "'x' as v", "3 as vb", "4 as floor")
    got = Counter(map(tuple, topk.top_k(df, 256, 50, 5).collect()))
    assert got == brute_top(whole, 50, 5)
    assert topk.top_k(df.limit(0), 256, 50, 5).count() == 0


def test_top_k_of_huge_components(spark):
    """Products that no long holds: the nearest long, ties by id."""
    whole = [(i, [int(2.0 ** e) * 256, -3 * 256, int(2.0 ** (e // 2)) * 256]) for i, e in enumerate([5, 30, 60, 100, 300, 1000, 40, 60, 3, 70])] + [(50, [-int(2.0 ** 90) * 256, 256, 0])]
    df = spark.createDataFrame([(i, [float(c // 256) for c in v]) for i, v in whole], "vec_id long, embedding array<double>")
    assert Counter(map(tuple, topk.top_k(df, 256, 5, 4).collect())) == brute_top(whole, 5, 4)


def clusters(seed, many=8, size=300, apart=30):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(c, 0.5, (size, 4)) for c in rng.normal(0, apart, (many, 4))]).round()


@pytest.mark.parametrize("page", [4, 64])
def test_batched_search_equals_all_products(monkeypatch, page):
    monkeypatch.setattr(topk, "PAGE", page)
    for x in (clusters(4), np.random.default_rng(1).integers(-2, 3, (500, 6)).astype(float), np.ones((300, 3)), np.zeros((1, 2))):
        ids = np.arange(len(x)) * 3
        tree = topk.MTree(x, ids)
        q, q_ids = x[::25], ids[::25]
        plain = {int(i): sorted((-int(s), int(j)) for s, j in zip(x @ own, ids) if j != i)[:5] for i, own in zip(q_ids, q)}
        # a first limit that is reached, and none
        for floor in (np.full(len(q), -np.inf), np.asarray([-plain[int(i)][-1][0] if plain[int(i)] else -np.inf for i in q_ids])):
            got = topk.tree_best(tree, q, q_ids, floor, 5)
            assert {i: [(-s, j) for o, j, s in got if o == i] for i in plain} == plain


def test_m_tree_leaves_products_out():
    x = clusters(4)
    search = topk.Search(topk.MTree(x, np.arange(len(x))), x[::100], np.arange(len(x))[::100], 5, np.full(len(x[::100]), -np.inf))
    search.run()
    assert search.scored < len(x) * len(x[::100]) / 3


def test_a_tree_is_built_once_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 500)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    count = spark.sparkContext.accumulator(0)
    real = topk.built

    def counted(table):
        count.add(1)
        return real(table)

    monkeypatch.setattr(topk, "built", counted)
    assert topk.top_k(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), 256, 50, 5).count() == 200
    assert count.value == 4


def test_sharding_of_the_corpus(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_sharding(spark, SF).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    load, places = Counter(), defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) < 0.002 * sum(load.values()) / 8
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_of_odd_rows(docs, none, spark, tmp_path):
    rows = sharding.shard(docs, 3, path=str(tmp_path / "map")).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 1) for i, t, _ in ROWS)
    assert sorted(r["slot"] for r in rows if r["shard"] == 0) == list(range(sum(r["shard"] == 0 for r in rows)))
    assert sharding.shard(none, 3).count() == 0
    # all versions stay readable, and rebalancing moves only what it must
    first, second = (dict(map(tuple, sharding.stored(spark, str(tmp_path / "map"), v).collect())) for v in (0, 1))
    assert len(first) == len(second) == sharding.SLOTS and sum(first[s] != second[s] for s in first) <= len(ROWS)


def test_rebalancing_evens_the_shards():
    weight = [((s * 7919) % 1000) ** 2 for s in range(sharding.SLOTS)]
    new = sharding.rebalanced(sharding.first_map(8), weight, 8)
    load = Counter()
    for s, shard in enumerate(new):
        load[shard] += weight[s]
    assert max(load.values()) - min(load.values()) < 1000


def test_pipeline_keeps_what_it_must(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.schema.names == docs.schema.names
        assert after.count() <= docs.count()
        if name == "language_id":
            assert after.count() >= 0.98 * docs.count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
