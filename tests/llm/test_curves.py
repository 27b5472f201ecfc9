"""Nearest neighbours on Hilbert curves: the curve, recall against brute force, exactness where windows reach all."""

from collections import defaultdict

import numpy as np
import pytest

from citystream.llm import curves, queries

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("axes,bits", [(1, 5), (2, 4), (3, 3), (4, 3)])
def test_curve_visits_each_cell_by_single_steps(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    key = curves.hilbert(grid, bits)
    assert sorted(key.tolist()) == list(range(1 << axes * bits))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, every, k):
    """(query_id, rank, vec_id) -> distance; every row is a list of (id, vector)."""
    seen = sorted({(i, tuple(map(float, v))) for i, v in rows})
    sound = [(i, np.asarray(v)) for i, v in seen if i is not None and len(v) and np.isfinite(v).all() and any(v)]
    out = []
    for i, q in sound:
        if i % every == 0:
            others = sorted((float(np.sqrt(((q - x) ** 2).sum())), j) for j, x in sound if len(x) == len(q) and (j != i or (x != q).any()))
            out += [(i, r + 1, j, round(d, 9)) for r, (d, j) in enumerate(others[:k])]
    return sorted(out)


def test_recall_on_the_corpus(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.asarray([r["embedding"] for r in rows], np.float64)
    ids = np.asarray([r["vec_id"] for r in rows])
    got = defaultdict(dict)
    for r in curves.neighbours(spark.read.parquet(f"{SF}/embeddings.parquet"), 20, 10).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        own = x[ids == q][0]
        far = np.sqrt(((x - own) ** 2).sum(axis=1))
        order = [i for _, i in sorted(zip(far.tolist(), ids.tolist())) if i != q][:10]
        assert sorted(found) == list(range(1, 11))
        assert [s for _, s in sorted(found.values(), key=lambda f: f[1])] == [found[r][1] for r in range(1, 11)]
        assert all(abs(s - far[ids == i][0]) < 1e-12 for i, s in found.values())
        hits += len({i for i, _ in found.values()} & set(order))
    assert hits >= 0.9 * 10 * len(got)


def test_windows_leave_most_of_a_structured_table_out(spark):
    """Clustered vectors: the measured window is narrow, and recall holds."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(200, 16))
    x = centers[rng.integers(200, size=6000)] + rng.normal(0, 0.05, (6000, 16))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    own = curves.rows_of(df, "vec_id", "embedding").cache()
    ranks = curves.ranked(own, curves.fitted(own, 6000)).cache()
    assert ranks.count() == 6000 * curves.CURVES
    assert [r["rank"] for r in ranks.filter("curve = 1").orderBy("rank").collect()] == list(range(6000))
    assert curves.window(own, ranks, 6000, 5) < 600


@pytest.mark.parametrize("block", [8, 4096])
def test_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(curves, "BLOCK", block)
    monkeypatch.setattr(curves, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-3, 4, 5).tolist()) for i in range(150)]
    rows += [(200 + i, [1, 1, 1, 1, 1]) for i in range(60)] + [(300, [1, 2]), (301, [3, 4]), (350, [2 ** 40, 1, 1, 1, 1]), (7, [9, 9, 9, 9, 9]), (50, [0, 0, 0, 0, 1]), (50, [0, 0, 0, 0, 1])]
    bad = [(None, [1.0] * 5), (400, None), (401, []), (402, [1.0, None, 1.0, 1.0, 1.0]), (450, [float("nan")] * 5), (403, [float("inf")] * 5), (500, [0.0] * 5)]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows] + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as dim", "'x' as v", "3 as rank", "4 as h").repartition(5)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in curves.neighbours(df, 50, 5, width=10 ** 6).collect())
    assert got == brute(rows, 50, 5)
    narrow = curves.neighbours(df, 50, 5).collect()
    assert {r["query_id"] for r in narrow} == {q for q, *_ in got} and len(narrow) == len(got)
    assert curves.neighbours(df.limit(0), 50, 5).count() == 0
    assert curves.neighbours(df.filter("vec_id = 300"), 50, 5).count() == 0


def test_query_on_the_smallest_table(spark):
    rows = queries.op12_nearest_neighbours(spark, "/root/testdata/sf0.001").collect()
    ids = {r["vec_id"] for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id").collect()}
    assert {r["query_id"] for r in rows} == {i for i in ids if i % 100 == 0}
