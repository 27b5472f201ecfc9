"""Exact top-k search (operator 2): M-tree best-first search.

Inner product is no metric, so vectors are lifted: with R the largest squared
norm, x becomes (x, sqrt(R - |x|^2)) and a query (q, 0). Then the squared
distance of a query and a vector is |q|^2 + R - 2 q.x, and the nearest vectors
are those of the largest inner product.

Vectors are dealt into blocks, and over each block one paged M-tree is built, once,
and checkpointed: every entry of a node has its object, its distance to the
node's own object, and (in inner nodes) a covering radius. Queries are dealt into
blocks too. A pair of a tree and a query block is one task's group, so no task
holds more than a block of either.

All queries of a block search a tree together. The distance to a node's object is
known when the node is opened; by the triangle inequality its difference to an
entry's stored parent distance bounds the entry's distance from below, so entries
beyond a query's k-th best are left out without computing their distance, and
covering radii bound whole pages. Each query then visits its pages best first, in
rounds of one, two, four, ... pages; a round multiplies each page with the queries that
still want it, and tightens their limits. First a query searches one tree; the k-th
score found there goes with it to all other trees as its first limit.

Bounds are compared with a slack for rounding, and equal scores are never left
out, so results are exact. Queries that are a fixed share of all rows make the
work grow with the square of the table; pruning and blocks don't change that.

Defined results: vectors that are null, empty, hold a null or non-finite
component, or one that isn't finite when scaled take no part, neither do rows
without id; vectors meet only vectors of the same dimension; rows that repeat an
id are candidates each (and a query's own id is never its candidate), and queries of
one id share one list of results; ties go to the smaller id; fewer
candidates than k are all returned; an empty table gives an empty result; other
columns are ignored. Products that a double can't hold exactly are worked out in whole
numbers of any size; scores beyond a long are given as the nearest long, and tie there."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citystream.session import shared_root

#: Vectors of a block, and queries of a block.
BLOCK = 4096
QUERY_BLOCK = 2048
#: Entries of an M-tree node.
PAGE = 64
EXACT = 2.0 ** 52
LONGEST = 2 ** 63 - 1


class MTree:
    """A paged M-tree over lifted vectors, loaded in bulk.

    nodes[i] is (objects' rows, parent distances, radii or None, children or None)."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        norms = (vectors * vectors).sum(axis=1)
        self.most = float(norms.max())
        self.points = np.column_stack((vectors, np.sqrt(np.maximum(self.most - norms, 0))))
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray | None, list[int] | None]] = []
        if self.most < EXACT:
            self.root = self._load(np.arange(len(vectors)), None)[0]

    def _distances(self, rows: np.ndarray, center: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[center]) ** 2).sum(axis=1))

    def _load(self, rows: np.ndarray, center: int | None) -> tuple[int, float]:
        """Node over these rows below the object `center`, and its covering radius."""
        to_center = np.zeros(len(rows)) if center is None else self._distances(rows, center)
        if len(rows) <= PAGE:
            self.nodes.append((rows, to_center, None, None))
            return len(self.nodes) - 1, float(to_center.max(initial=0))
        # spread centers: each next one is the row farthest from those chosen
        many = min(PAGE, -(-len(rows) // (PAGE // 2)))
        chosen, near, owner = [int(rows[0])], self._distances(rows, int(rows[0])), np.zeros(len(rows), np.int64)
        while len(chosen) < many and near.max() > 0:
            chosen.append(int(rows[int(near.argmax())]))
            d = self._distances(rows, chosen[-1])
            closer = d < near
            near, owner = np.where(closer, d, near), np.where(closer, len(chosen) - 1, owner)
        if len(chosen) == 1:  # all rows are equal: pages of equal vectors
            chosen = [int(r) for r in rows[::PAGE]]
            owner = np.arange(len(rows)) // PAGE
            if len(chosen) > PAGE:
                owner, chosen = owner // -(-len(chosen) // PAGE), chosen[::-(-len(chosen) // PAGE)]
        children, radii, objects, parents = [], [], [], []
        for k, c in enumerate(chosen):
            own = rows[owner == k]
            if len(own):
                child, radius = self._load(own, c)
                children.append(child)
                radii.append(radius)
                objects.append(c)
                parents.append(0.0 if center is None else float(self._distances(np.asarray([c]), center)[0]))
        self.nodes.append((np.asarray(objects), np.asarray(parents), np.asarray(radii), children))
        return len(self.nodes) - 1, float(to_center.max(initial=0))


class Search:
    """The k best vectors of one tree for each of some queries. `floor` holds a score that each
    query's results must reach (-inf if nothing is known)."""

    def __init__(self, tree: MTree, queries: np.ndarray, query_ids: np.ndarray, k: int, floor: np.ndarray):
        self.tree, self.q, self.ids, self.k = tree, queries, query_ids, k
        self.reach = (queries * queries).sum(axis=1) + tree.most
        self.slack = 1e-6 * np.sqrt(1 + self.reach)
        self.floor = floor.astype(float)
        self.scored = 0
        self.best: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # query, score, id

    def limit(self, who: np.ndarray) -> np.ndarray:
        """Largest distance at which a vector can still count, with the slack."""
        return np.sqrt(np.maximum(self.reach[who] - 2 * self.floor[who], 0)) + self.slack[who]

    def pages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(page, query, least distance, distance to its object) of all pages a query may need."""
        out = []
        left: list[tuple[int, np.ndarray, np.ndarray | None]] = [(self.tree.root, np.arange(len(self.q)), None)]
        while left:
            at, who, to_center = left.pop()
            rows, parents, radii, children = self.tree.nodes[at]
            if children is None:
                out.append((np.full(len(who), at), who, np.zeros(len(who)), np.full(len(who), np.nan) if to_center is None else to_center))
                continue
            limit = self.limit(who)
            wanted = np.ones((len(who), len(rows)), bool)
            if to_center is not None:
                wanted = np.abs(to_center[:, None] - parents) - radii <= limit[:, None]
            entries = np.flatnonzero(wanted.any(axis=0))
            product = self.q[who] @ self.tree.points[rows[entries], :-1].T
            norms = (self.tree.points[rows[entries]] ** 2).sum(axis=1)
            d = np.sqrt(np.maximum((self.q[who] ** 2).sum(axis=1)[:, None] + norms - 2 * product, 0))
            for n, j in enumerate(entries.tolist()):
                near = np.maximum(d[:, n] - radii[j], 0)
                stays = wanted[:, j] & (near <= limit)
                if not stays.any():
                    continue
                child = children[j]
                if self.tree.nodes[child][3] is None:
                    out.append((np.full(int(stays.sum()), child), who[stays], near[stays], d[stays, n]))
                else:
                    left.append((child, who[stays], d[stays, n]))
        return tuple(np.concatenate(c) for c in zip(*out))

    def keep(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        who, score, ids = (np.concatenate(c) for c in zip(self.best, *found))
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        stays = place < self.k
        self.best = who[stays], score[stays], ids[stays]
        worst = place == self.k - 1
        self.floor[who[worst]] = np.maximum(self.floor[who[worst]], score[worst])

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        page, who, least, to_object = self.pages()
        order = np.lexsort((least, who))
        page, who, least, to_object = page[order], who[order], least[order], to_object[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        step, done = 1, 0
        while done <= (place.max() if len(place) else -1):
            now = np.flatnonzero((place >= done) & (place < done + step))
            now = now[least[now] <= self.limit(who[now])]
            now = now[np.argsort(page[now], kind="stable")]
            found = []
            for some in np.split(now, np.flatnonzero(np.diff(page[now])) + 1) if len(now) else []:
                rows, parents, *_ = self.tree.nodes[int(page[some[0]])]
                own = who[some]
                # stored parent distances leave rows out before anything is computed
                d = to_object[some][:, None]
                wanted = ~(np.abs(d - parents) > self.limit(own)[:, None])
                used = np.flatnonzero(wanted.any(axis=0))
                self.scored += int(wanted.sum())
                score = self.q[own] @ self.tree.vectors[rows[used]].T
                i, j = np.nonzero(wanted[:, used] & (score >= self.floor[own][:, None]) & (self.tree.ids[rows[used]] != self.ids[own][:, None]))
                found.append((own[i], score[i, j], self.tree.ids[rows[used]][j]))
            if found:
                self.keep(found)
            done, step = done + step, step * 2
        return self.best


def whole_number_best(tree: MTree, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) by products of whole numbers of any size: every row is scored."""
    whole = lambda m: np.asarray([[int(c) for c in row] for row in m.tolist()], object).reshape(m.shape)
    held, out = whole(tree.vectors), []
    for own, q in zip(query_ids.tolist(), whole(queries)):
        scores = (max(-LONGEST - 1, min(LONGEST, s)) for s in (held @ q).tolist())
        best = sorted((-s, i) for s, i in zip(scores, tree.ids.tolist()) if i != own)[:k]
        out += [(own, i, -s) for s, i in best]
    return out


def tree_best(tree: MTree, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    if float(np.abs(tree.vectors).max()) * float(np.abs(queries).max()) * queries.shape[1] >= EXACT or tree.most >= EXACT:
        return whole_number_best(tree, queries, query_ids, k)
    who, score, ids = Search(tree, queries, query_ids, k, floor).run()
    return list(zip(query_ids[who].tolist(), ids.tolist(), score.astype(np.int64).tolist()))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(len(column), -1)


def built(vectors: pa.Table) -> pa.Table:
    """One row: the M-tree over a block of vectors."""
    with np.errstate(over="ignore", invalid="ignore"):
        tree = MTree(_matrix(vectors.column("v")), np.asarray(vectors.column("id")))
    return pa.table({"dim": vectors.column("dim")[:1], "vb": vectors.column("vb")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})


def searched(queries: pa.Table, trees: pa.Table, k: int) -> pa.Table:
    """The k best vectors of one tree for the queries of one block."""
    out: list[tuple[int, int, int]] = []
    if queries.num_rows and trees.num_rows:
        floor = np.asarray([-np.inf if f is None else f for f in queries.column("floor").to_pylist()])
        out = tree_best(pickle.loads(trees.column("tree")[0].as_py()), _matrix(queries.column("v")), np.asarray(queries.column("id")), floor, k)
    columns = zip(*out) if out else ([], [], [])
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})


def top_k(vectors: DataFrame, scale: int, every: int, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of the highest inner product of
    floor(scale * x), for each vector whose id is divisible by `every`."""
    shared_root(vectors.sparkSession)

    def whole(x):  # doubles from 2^52 on are whole; floor() gives a long, which they need not fit in
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0 ** 52, F.floor(scaled).cast("double")).otherwise(scaled)

    v = F.transform(F.col(vector_col), whole)
    fit = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.col(id_col).isNotNull() & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(fit, v).alias("v")).filter("v IS NOT NULL").withColumn("dim", F.size("v"))
    n, n_queries = own.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    # by the row, not by its id alone, so rows of one id don't share a block
    dealt = own.withColumn("vb", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    trees = dealt.groupBy("dim", "vb").applyInArrow(built, "dim int, vb int, tree binary").checkpoint()
    asked = own.filter(F.col("id") % every == 0).select("id", "v", "dim").distinct()
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks)).cast("int")).withColumn("home", F.pmod(F.hash("id", "v"), F.lit(blocks)).cast("int"))

    def answers(queries: DataFrame, held: DataFrame) -> DataFrame:
        return queries.groupBy("dim", "qb", "vb").cogroup(held.groupBy("dim", "qb", "vb")).applyInArrow(lambda a, b: searched(a, b, k), "query_id long, vec_id long, score long")

    # every query block meets every tree
    held = trees.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    first = answers(asked.select("id", "v", "dim", "qb", F.col("home").alias("vb"), F.lit(None).cast("long").alias("floor")), held).checkpoint()
    least = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).filter(F.col("n") == k).select(F.col("query_id").alias("id"), "floor")
    rest = asked.withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).filter("vb != home").join(least, "id", "left")
    found = first.unionByName(answers(rest.select("id", "v", "dim", "qb", "vb", "floor"), held))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
