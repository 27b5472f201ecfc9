"""Exact, near and substring dedup against brute force and the reference SQL."""

import hashlib
import random
import re
import sys
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from edge_docs import ROWS
from oracle_util import compare, duck
from pyspark.sql import functions as F

from citystream.llm import components, exact_dedup, queries, simhash, substring_dedup

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_exact_top_k", "op6_exact_dedup", "op8_substring_dedup"])
def test_equals_the_reference_sql(spark, name):
    problems, n, _ = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert not problems and n


def test_exact_dedup_of_odd_rows(docs, none):
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    got = sorted(map(str, exact_dedup.verdicts(docs).select("doc_id", "keep_id", "group_size", "text_sha256").collect()))
    expected = []
    for norm, rows in groups.items():
        for r in rows:
            expected.append((r[3], min(rows)[3], len(rows), hashlib.sha256(norm.encode()).hexdigest()))
    assert got == sorted(f"Row(doc_id={i}, keep_id={k}, group_size={n}, text_sha256='{h}')" for i, k, n, h in expected)
    kept = exact_dedup.verdicts(docs).filter("kept").count()
    rest = exact_dedup.deduplicated(docs)
    assert kept == rest.count() == len(groups) and rest.columns == docs.columns
    assert exact_dedup.verdicts(none).count() == 0 and exact_dedup.deduplicated(none).count() == 0


def test_exact_dedup_ranks_extreme_ids(spark):
    rows = spark.createDataFrame([(2 ** 63 - 1, "q"), (-2 ** 63, "q "), (0, "q "), (None, "r  "), (5, "r")], "doc_id long, text string")
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.verdicts(rows).collect()}
    assert got == {2 ** 63 - 1: -2 ** 63, -2 ** 63: -2 ** 63, 0: -2 ** 63, None: None, 5: None}


def brute_fingerprint(text, shingle):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """Class number of each fingerprint."""
    codes, label = np.asarray(prints, np.uint64), list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for k, c in enumerate(codes):
            near = np.flatnonzero(np.bitwise_count(codes ^ c) <= distance).tolist()
            least = min(label[j] for j in near)
            for j in near:
                if label[j] != least:
                    label[j], changed = least, True
    return label


def test_simhash_of_the_corpus(spark, corpus):
    _, rows = corpus
    prints = [brute_fingerprint(t, 4) for _, t in rows]
    label = brute_components(prints, 4)
    least = defaultdict(lambda: sys.maxsize)
    for (i, _), k in zip(rows, label):
        least[k] = min(least[k], i)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op10_simhash_near_dedup(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[k]) for (i, _), p, k in zip(rows, prints, label)}
    kept = {r["doc_id"] for r in simhash.first_of_groups(corpus[0], 4, 4).collect()}
    assert kept == set(least.values())


def test_simhash_of_odd_rows(docs, none):
    prints = [brute_fingerprint(t, 4) for _, t, _ in ROWS]
    label = brute_components(prints, 4)
    ids = defaultdict(list)
    for (i, _, _), k in zip(ROWS, label):
        ids[k].append(i)
    least = {k: min((i for i in own if i is not None), default=None) for k, own in ids.items()}
    got = sorted(map(str, simhash.near_duplicates(docs, 4, 4).collect()))
    assert got == sorted(f"Row(doc_id={i}, fingerprint='{p:016x}', component_id={least[k]})" for (i, _, _), p, k in zip(ROWS, prints, label))
    first = simhash.first_of_groups(docs, 4, 4)
    assert first.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in first.select("doc_id", "text").collect()}
    for k, own in ids.items():  # one document of each group
        assert len({(i, t) for (i, t, _), other in zip(ROWS, label) if other == k} & texts) == 1
    assert simhash.near_duplicates(none, 4, 4).count() == 0 and simhash.first_of_groups(none, 4, 4).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 4, 7])
def test_gray_index_finds_every_link(distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    near = base[rng.integers(0, 40, 300)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    codes = np.unique(np.concatenate((base, near)))
    cells = rng.integers(0, 3, len(codes))
    order = np.lexsort((simhash.gray_rank(codes), cells))
    codes, cells = codes[order], cells[order]
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    a, b = simhash.GrayIndex(codes, starts).links(np.arange(len(codes)), distance)
    expected = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if cells[i] == cells[j] and int(codes[i] ^ codes[j]).bit_count() <= distance}
    assert set(zip(a.tolist(), b.tolist())) == expected
    u, v = simhash.spanning(codes, starts, distance)
    assert len(u) <= len(codes)


def test_gray_rank_orders_neighbours():
    codes = np.arange(16, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(ordered, ordered[1:]))


def test_hot_pages_are_parted(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAGE", 8)
    rng = np.random.default_rng(1)
    codes = np.unique(np.uint64(12345) ^ (rng.integers(0, 2 ** 12, 200, dtype=np.uint64)))
    label = brute_components(codes.tolist(), 2)
    prints = spark.createDataFrame([(int(k), int(c)) for k, c in enumerate(codes)], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.classes(prints, 2).collect()}
    least = {}
    for k, own in enumerate(label):
        least.setdefault(own, k)
    sizes = defaultdict(int)
    for own in label:
        sizes[own] += 1
    assert got == {int(c): least[own] for c, own in zip(codes, label) if sizes[own] > 1}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(5, 3), (3, 5), (9, 7), (7, 3), (20, 21), (22, 21)]])
def test_components(spark, edges):
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: r for n, r in root.items() if n != r}


def brute_removal(rows, width):
    """(words, removed, kept) of each row; rows are (rank, text)."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (rank, _), words in zip(rows, split):
        for k in range(len(words) - width + 1):
            w = tuple(words[k:k + width])
            least[w] = min(least.get(w, rank), rank)
    out = []
    for (rank, _), words in zip(rows, split):
        gone = {j for k in range(len(words) - width + 1) if least[tuple(words[k:k + width])] < rank for j in range(k, k + width)}
        out.append((len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return out


def texts_rank(spark, texts):
    """Rank of rows without id, by their text."""
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", substring_dedup.rank(F.lit(None), F.col("text")).alias("r"))
    return {r["text"]: r["r"] for r in rows.collect()}


@pytest.mark.parametrize("scale", [None, (7, 7, 2), (3, 21, 8), (4, 64, 0)])
def test_substring_dedup_of_odd_rows(spark, docs, none, monkeypatch, scale):
    if scale is not None:
        monkeypatch.setattr(substring_dedup, "scale", lambda *_: substring_dedup.Scale(*scale))
    without = texts_rank(spark, [t for i, t, _ in ROWS if i is None])
    assert min(without.values()) >= substring_dedup.NO_ID
    expected = brute_removal([(without[t] if i is None else i, t) for i, t, _ in ROWS], 13)
    assert any(n for _, n, _ in expected)
    got = sorted(map(str, substring_dedup.removals(docs, 13).collect()))
    assert got == sorted(f"Row(doc_id={i}, n_words={n}, n_removed={r}, kept_sha256='{hashlib.sha256(k.encode()).hexdigest()}')" for (i, _, _), (n, r, k) in zip(ROWS, expected))
    clean = substring_dedup.deduplicated(docs, 13, length_col="n_chars")
    assert clean.columns == docs.columns
    texts = sorted(str((r["doc_id"], r["text"], r["n_chars"])) for r in clean.select("doc_id", "text", "n_chars").collect())
    new = [(i, k if r else t, len(k) if r else None if t is None else len(t)) for (i, t, _), (_, r, k) in zip(ROWS, expected)]
    assert texts == sorted(map(str, new))
    assert substring_dedup.removals(none, 13).count() == 0 and substring_dedup.deduplicated(none, 13).count() == 0


def test_substring_dedup_of_many_rows_without_id(spark):
    """A third of the rows has no id, and another third of them one text: no list holds other rows' windows."""
    rnd = random.Random(4)
    passages = [" ".join(f"{c}{rnd.randint(0, 99)}" for _ in range(15)) for c in "abcdef"]
    same = "x " + passages[0] + " y " + passages[1]
    texts = [same if i % 9 == 0 else f"w{i} {rnd.choice(passages)} {i} {rnd.choice(passages)} end{i}" for i in range(300)]
    rows = [(None if i % 3 == 0 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    without = texts_rank(spark, {t for i, t in rows if i is None})
    expected = brute_removal([(without[t] if i is None else i, t) for i, t in rows], 13)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.removals(df, 13).collect())
    assert got == sorted((str(i), n, r, hashlib.sha256(k.encode()).hexdigest()) for (i, _), (n, r, k) in zip(rows, expected))
    lists = substring_dedup.answered(df, 13, substring_dedup.scale(df, "text"), "doc_id", "text", "found").selectExpr("max(size(found)) as n").first()["n"]
    assert lists <= 2 * 15


@pytest.mark.parametrize("corpus,most", [(10 ** 9, 9), (10 ** 12, 12), (8 * 10 ** 12, 12), (10 ** 14, 14)])
def test_bytes_of_a_window_at_any_size(corpus, most):
    """Cells of one full batch (about a thousand documents) of a corpus of so many bytes; 8 * 10 ** 12 is a
    million buckets. What still grows is the second hash, by a byte for each factor of sixteen."""
    rng = np.random.default_rng(1)
    at = substring_dedup.scale_of(corpus)
    assert at.ranges <= substring_dedup.RANGES and at.buckets % at.ranges == 0 and corpus / at.buckets <= substring_dedup.BUCKET_BYTES
    n = substring_dedup.BATCH_WINDOWS
    second = rng.integers(0, 1 << 8 * at.extra, n, np.uint64) if at.extra else np.zeros(n, np.uint8)
    batch = substring_dedup.batch_cells(rng.integers(0, 2 ** 64 - 1, n, np.uint64), second, np.repeat(10 ** 9 + np.arange(n // 1024), 1024), at.ranges)
    size = sum(len(x) for c in ("hash", "second", "rank") for x in batch.column(batch.schema.get_field_index(c)).to_pylist())
    assert size / n < most
    # behind the exchange: the buckets of one range hold what the range held, and none of another
    one = batch.slice(5, 1)
    parts = list(substring_dedup.split([one], at))
    opened = list(substring_dedup.opened(parts, at))
    before = next(substring_dedup.opened([one], at))
    assert sum(len(c[2]) for c in opened) == len(before[2]) and {c[0] * at.ranges // at.buckets for c in opened} == {before[0]}


def test_packed_numbers():
    n = np.asarray([0, 1, 2 ** 64 - 1, 77, 2 ** 40], np.uint64)
    assert (substring_dedup.unpacked(substring_dedup.packed(n), len(n)) == n).all()
