"""Approximate nearest neighbours (operator 12) on shifted space-filling curves.

Vectors are projected onto a few random orthonormal directions, several times
over with other directions and another shift, and each time laid out along a
Hilbert curve. Rows are range-partitioned and sorted by their key on the curve, so
each has a rank on each curve. A query is compared with the blocks of ranks that a
window around its own rank touches, on every curve; the curves' findings are
merged and ranked by the exact distance.

Equal vectors are one class with one place on each curve. Of a class only the
first k + 1 ids can be among k results, as ties go to the smaller id, so a
vector that a third of all rows share costs no more than another one; queries of
equal vectors are searched once.

The width of the window isn't fixed. A bounded sample of CALIBRATE vectors is
compared with all rows (in batches; linear in their number), and the window is
made so wide that RECALL of the sample's true neighbours lie inside it on one
curve at least. On vectors with structure that is a narrow window; on vectors that
are random in many dimensions it takes in much of the table, and the work
grows with the square of it (as for any method). Blocks bound what a task holds:
where windows are so wide that a block meets more queries than QUERY_BLOCK, they are
dealt over several tasks.

What moves: vectors once to form classes and once for each curve; else keys and ranks.

Only the projections' value ranges are fitted on a sample (SAMPLE vectors at most
on average); every row is indexed.

Defined results: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part, neither do rows without id; vectors meet
only vectors of the same dimension; rows that repeat id and vector count once; rows
of one id with other vectors are rows of their own, candidates and queries; ties go to the smaller id; fewer candidates than k are all
returned (if the windows reach them: up to a block of classes always); an empty table
gives an empty result; other columns are ignored. Equal vectors are told by a 64-bit hash."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A
from citystream.session import shared_root

CURVES = 3
AXES = 8  # directions of one projection
#: Vectors of a block of ranks, and queries that meet it in one task.
BLOCK = 4096
QUERY_BLOCK = 4096
#: Bounds of the samples: vectors that the value ranges are fitted on, and those that the window is.
SAMPLE = 4096
CALIBRATE = 256
RECALL = 0.94


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole coordinates below 2^bits: level by
    level the part of the cube is found, and reflected or turned to the curve's basic form."""
    x = cells.astype(np.int64)
    axes = x.shape[1]
    if axes == 1:
        return x[:, 0]
    first = x[:, 0].copy()
    rest = [x[:, a].copy() for a in range(1, axes)]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        first ^= -(first >> level & 1) & low
        for c in rest:
            upper = -(c >> level & 1)
            swap = (first ^ c) & low & ~upper
            first ^= swap | (upper & low)
            c ^= swap
    # Gray code of the turned coordinates, across axes and then down the levels
    gray = [first]
    for c in rest:
        gray.append(c ^ gray[-1])
    flip, last = np.zeros(len(x), np.int64), gray[-1]
    for level in range(bits - 1, 0, -1):
        flip ^= -(last >> level & 1) & ((1 << level) - 1)
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for c in gray:
            key = key << 1 | ((c ^ flip) >> level & 1)
    return key


@lru_cache(maxsize=64)
def projection(dim: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (as columns) and the shift of each, for one curve."""
    rng = np.random.default_rng([dim, curve])
    axes = min(dim, AXES)
    return np.linalg.qr(rng.normal(size=(dim, axes)))[0], rng.random(axes)


def bits_of(axes: int) -> int:
    return min(16, 62 // axes)


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def keys(x: np.ndarray, ranges: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Curve keys of vectors of one dimension. ranges holds the sorted projected sample values
    (values x axes) of each curve; a dimension without a sample is laid out by angle."""
    dim, out = x.shape[1], []
    for curve in range(CURVES):
        directions, shift = projection(dim, curve)
        y = x @ directions
        known = ranges.get(dim)
        if known is not None:
            share = np.linspace(0, 1, len(known[curve]))
            place = np.stack([np.interp(y[:, a], known[curve][:, a], share) for a in range(y.shape[1])], axis=1)
        else:
            place = 0.5 + 0.5 * np.tanh(y * np.sqrt(dim) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300))
        bits = bits_of(y.shape[1])
        cells = np.minimum((place + shift) / 2 * (1 << bits), (1 << bits) - 1)
        out.append(hilbert(cells, bits))
    return out


def nearest(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k rows nearest to each query; ties by `first`. Products
    find the candidates, with a slack for rounding; distances are then worked out exactly."""
    rows, found, far = [], [], []
    norms = (x * x).sum(axis=1)
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        own = (part * part).sum(axis=1)
        d = own[:, None] + norms - 2 * (part @ x.T)
        if len(x) > k:
            slack = 1e-12 * (own + norms.max()) * x.shape[1]
            near = d <= (np.partition(d, k - 1, axis=1)[:, k - 1] + slack)[:, None]
            i, j = np.nonzero(near)
        else:
            i, j = (z.ravel() for z in np.indices(d.shape))
        exact = np.sqrt(((part[i] - x[j]) ** 2).sum(axis=1))
        order = np.lexsort((first[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        rows.append(i[keep] + at)
        found.append(j[keep])
        far.append(exact[keep])
    none = np.zeros(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(found or [none]), np.concatenate(far or [none.astype(float)])


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0)


def rows_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, dim, h (hash of the vector), v of every vector that takes part."""
    kind = vectors.schema[vector_col].dataType.elementType.typeName()
    v = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    own = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    return own.select("id", F.size("v").alias("dim"), F.xxhash64("v").alias("h"), "v")


def classes_of(own: DataFrame, every: int) -> DataFrame:
    """dim, h, first (least id), asked (some id is a query's), v: one row per distinct vector."""
    return own.groupBy("dim", "h").agg(F.min("id").alias("first"), F.max(F.col("id") % every == 0).alias("asked"), F.any_value("v").alias("v"))


def _sampled(own: DataFrame, classes: int, most: int, salt: int) -> DataFrame:
    share = max(1, -(-classes // most))
    chosen = own.filter(F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(share)) == 0)
    return chosen.groupBy("dim", "h").agg(F.any_value("v").alias("v"))


def fitted(own: DataFrame, classes: int) -> dict[int, list[np.ndarray]]:
    """Sorted projected values of a sample of SAMPLE classes on average, by dimension and curve."""
    by_dim: dict[int, list] = {}
    for r in _sampled(own, classes, SAMPLE, 1).collect():
        by_dim.setdefault(r["dim"], []).append(r["v"])
    return {dim: [np.sort(np.asarray(v, np.float64) @ projection(dim, c)[0], axis=0) for c in range(CURVES)] for dim, v in by_dim.items() if len(v) >= 32}


def ranked(own: DataFrame, ranges: dict[int, list[np.ndarray]]) -> DataFrame:
    """dim, h, curve, rank of every class, from 0 on each curve. Keys and hashes are sorted by
    range and checkpointed, so a rank is a row's place in its partition plus the rows before."""

    def keyed(batches):
        for batch in batches:
            dims = np.asarray(A.column(batch, "dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                for curve, key in enumerate(keys(matrix(A.column(part, "v")), ranges)):
                    yield pa.RecordBatch.from_arrays([A.column(part, "dim"), A.column(part, "h"), pa.array(np.full(part.num_rows, curve), pa.int32()), pa.array(key, pa.int64())], names=["dim", "h", "curve", "key"])

    flat = own.select("dim", "h", "v").mapInArrow(keyed, "dim int, h long, curve int, key long").distinct()
    laid = flat.repartitionByRange("dim", "curve", "key", "h").sortWithinPartitions("dim", "curve", "key", "h").checkpoint()
    rows = laid.select("dim", "h", "curve", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    counts = rows.groupBy("dim", "curve", "part").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    before = Window.partitionBy("dim", "curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(counts, ["dim", "curve", "part"]).select("dim", "h", "curve", (F.col("at") - F.col("start") + F.col("base")).alias("rank"))


def true_neighbours(own: DataFrame, sample: list, k: int) -> DataFrame:
    """q, dim, h: the k classes nearest to each sampled one (dim, h, v), by comparing it with all rows."""
    asked = {dim: ([r["h"] for r in sample if r["dim"] == dim], np.asarray([r["v"] for r in sample if r["dim"] == dim], np.float64)) for dim in {r["dim"] for r in sample}}

    def compare(batches):
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for batch in batches:
            dims = np.asarray(A.column(batch, "dim"))
            for dim in np.unique(dims).tolist():
                if dim not in asked:
                    continue
                part = batch.filter(pa.array(dims == dim))
                h, at = np.unique(np.asarray(A.column(part, "h")), return_index=True)
                names, q = asked[dim]
                for i, j, d in zip(*(z.tolist() for z in nearest(q, matrix(A.column(part, "v"))[at], h, k + 1))):
                    if h[j] != names[i]:
                        best.setdefault((dim, names[i]), []).append((d, int(h[j])))
            best = {key: sorted(set(found))[:k] for key, found in best.items()}
        out = [(q, dim, h, d) for (dim, q), found in best.items() for d, h in found]
        columns = zip(*out) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))], names=["q", "dim", "h", "d"])

    met = own.select("dim", "h", "v").mapInArrow(compare, "q long, dim int, h long, d double").distinct()
    order = Window.partitionBy("dim", "q").orderBy("d", "h")
    return met.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k).select("q", "dim", "h")


def window(own: DataFrame, ranks: DataFrame, classes: int, k: int) -> int:
    """Ranks to each side in which RECALL of a sample's true neighbours lie on one curve at least."""
    sample = _sampled(own, classes, CALIBRATE, 2).collect()
    truth = true_neighbours(own, sample, k)
    there = ranks.select("dim", "h", "curve", "rank")
    pairs = truth.join(there, ["dim", "h"]).join(there.select("dim", F.col("h").alias("q"), "curve", F.col("rank").alias("own")), ["dim", "q", "curve"])
    apart = sorted(r["d"] for r in pairs.groupBy("dim", "q", "h").agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("d")).collect())
    return max(k, apart[int(np.ceil(RECALL * len(apart))) - 1] if apart else 0)


def block_best(table: pa.Table, k: int) -> pa.Table:
    """The k classes of a block nearest to each query that meets it."""
    is_query = np.asarray(table.column("query").combine_chunks().cast(pa.int8())) > 0
    asked, held = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
    if not asked.num_rows or not held.num_rows:
        return pa.table({"dim": pa.array([], pa.int32()), "q": pa.array([], pa.int64()), "h": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    first, h = np.asarray(held.column("first")), np.asarray(held.column("h"))
    i, j, d = nearest(matrix(asked.column("v")), matrix(held.column("v")), first, k)
    return pa.table({"dim": pa.array(np.asarray(asked.column("dim"))[i], pa.int32()), "q": pa.array(np.asarray(asked.column("h"))[i], pa.int64()), "h": pa.array(h[j], pa.int64()),
                     "first": pa.array(first[j], pa.int64()), "score": pa.array(d, pa.float64())})


def neighbours(vectors: DataFrame, every: int, k: int, id_col: str = "vec_id", vector_col: str = "embedding", width: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector whose id is divisible
    by `every`; `width` sets the window instead of measuring it."""
    shared_root(vectors.sparkSession)
    own = rows_of(vectors, id_col, vector_col)
    members = own.select("dim", "h", "id").distinct()
    classes, queries = members.groupBy("dim", "h").agg(F.max(F.col("id") % every == 0).alias("asked")).agg(F.count("*"), F.count_if("asked")).first()
    ranks = ranked(own, fitted(own, classes)).checkpoint()
    width = width if width is not None else window(own, ranks, classes, k)
    # queries that meet a block: their share of the classes in reach of it
    meet = queries * min(1.0, (2 * width + BLOCK) / max(classes, 1))
    deals = max(1, int(np.ceil(meet / QUERY_BLOCK)))
    last = F.lit(max(0, classes - 1) // BLOCK)

    def to(block: Column, deal: Column, query: bool) -> Column:
        return F.struct(block.cast("long").alias("block"), deal.cast("long").alias("deal"), F.lit(query).alias("query"))

    low, high = F.greatest(F.floor((F.col("rank") - width) / BLOCK), F.lit(0)), F.least(F.floor((F.col("rank") + width) / BLOCK), last)
    home = F.transform(F.sequence(F.lit(0), F.lit(deals - 1)), lambda d: to(F.floor(F.col("rank") / BLOCK), d, False))
    around = F.transform(F.sequence(low, high), lambda b: to(b, F.pmod(F.xxhash64("h"), F.lit(deals)), True))
    placed = classes_of(own, every).join(ranks, ["dim", "h"])
    dealt = placed.select("dim", "curve", "h", "first", "v", F.inline(F.when(F.col("asked"), F.concat(home, around)).otherwise(home)))
    found = dealt.groupBy("dim", "curve", "block", "deal").applyInArrow(lambda t: block_best(t, k + 1), "dim int, q long, h long, first long, score double")

    merged = found.groupBy("dim", "q", "h").agg(F.min("first").alias("first"), F.min("score").alias("score"))
    near = merged.withColumn("rn", F.row_number().over(Window.partitionBy("dim", "q").orderBy("score", "first"))).filter(F.col("rn") <= k + 1)
    kept = members.withColumn("rn", F.row_number().over(Window.partitionBy("dim", "h").orderBy("id"))).filter(F.col("rn") <= k + 1)
    listed = near.select("dim", "q", "h", "score", (F.col("h") == F.col("q")).alias("same")).join(kept.select("dim", "h", F.col("id").alias("vec_id")), ["dim", "h"])
    best = listed.withColumn("rn", F.row_number().over(Window.partitionBy("dim", "q").orderBy("score", "vec_id"))).filter(F.col("rn") <= k + 1)
    asked = members.filter(F.col("id") % every == 0).select("dim", F.col("h").alias("q"), F.col("id").alias("query_id"))
    answers = asked.join(best.select("dim", "q", "vec_id", "score", "same"), ["dim", "q"]).filter("NOT (same AND vec_id = query_id)")
    order = Window.partitionBy("query_id", "dim", "q").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
