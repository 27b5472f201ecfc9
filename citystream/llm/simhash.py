"""SimHash near-dedup (operator 10): a Gray-order hierarchical index.

Fingerprints: bit b is 1 if it is set in over half the shingles' XXH64.

Linking is done over distinct fingerprints (copies collapse into one node).
Fingerprints at most `distance` bits apart agree wholly in two blocks at least,
if 64 bits are cut into distance + 2 blocks. So the index' uppermost nodes are
the (block pair, shared bits) pages that hold two fingerprints or more; they
are spread over the cluster. Within a page the fingerprints are sorted by Gray
rank, which puts those that differ in few bits next to each other. Consecutive
ones form a node, nodes form larger nodes; each node holds the bits all its
members share, less those that the node above it holds. A search goes from the
top, adds up differences in shared bits, and leaves out a whole group once the
sum exceeds `distance`. At a leaf the sum is the Hamming distance, so the
result is exact.

A page of more than PAGE fingerprints is cut into parts by hash, and each pair
of parts is a task's cell: work on a hot page is spread, and no cell holds more
than about two parts. A cell returns a spanning set of its links (each member
with the least member it reaches), never all its pairs.

Defined results: a null text has no words, so fingerprint zero, which links
like any other; a null id is never the component's id unless no member has an
id (then null); repeated rows share their component; an empty table gives an
empty result; other columns are ignored by `near_duplicates` and carried by
`first_of_groups`. Very long texts are hashed whole, in chunks of bounded size."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A
from citystream.llm.components import components
from citystream.session import shared_root

BITS = 64
SEED = 42
CHUNK = 1 << 16  # shingles whose bits are counted at once
PAGE = 4096  # fingerprints of one page part
FAN = 8  # children of an index node
FRONTIER = 1 << 20  # (query, node) pairs searched at once
ROWS = 1 << 16  # fingerprints indexed at once, if cells allow


def fingerprint(text: str, shingle: int) -> int:
    """The text's fingerprint as an unsigned number."""
    words = text.encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED) if words else 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:len(words) - shingle + 1].tolist(), (ends - 1)[shingle - 1:].tolist()
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        digest, seed = xxhash.xxh64_intdigest, SEED
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], np.uint64)
        total += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(total * 2 > len(starts)).tolist()))


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy (a hash of the text), fp (the fingerprint's 64 bits as a long) of every row."""

    def hashed(batches):
        for batch in batches:
            for part, texts in A.slices(batch):
                fp = np.fromiter((fingerprint(t, shingle) for t in texts.to_numpy(zero_copy_only=False)), np.uint64, len(texts))
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), A.column(part, "copy"), pa.array(fp.view(np.int64), pa.int64())], names=["doc_id", "copy", "fp"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("copy"))
    return own.mapInArrow(hashed, "doc_id long, copy long, fp long")


def blocks(distance: int) -> list[int]:
    """Masks of distance + 2 blocks that part the 64 bits."""
    edges = [BITS * k // (distance + 2) for k in range(distance + 3)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def pages(nodes: DataFrame, distance: int) -> DataFrame:
    """fp, page, key, cell: every fingerprint in each cell of each page that holds two or more."""
    signed = lambda mask: mask - (1 << BITS) if mask >> (BITS - 1) else mask
    masks = [signed(a | b) for a, b in combinations(blocks(distance), 2)]
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("page", "key"))
    crowds = keyed.groupBy("page", "key").agg(F.count("*").alias("n")).filter("n > 1").checkpoint()
    parts = F.ceil(F.col("n") / PAGE).cast("int")
    held = keyed.join(crowds, ["page", "key"]).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.least("part", other) * F.col("parts") + F.greatest("part", other))
    return held.select("fp", "page", "key", F.explode(cells).alias("cell"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Index over several cells at once: codes sorted by (cell, Gray rank).

    levels[0] are the codes, levels[k + 1] groups of up to FAN neighbours of
    levels[k] in one cell; the last level has one node for each cell."""

    def __init__(self, codes: np.ndarray, cell_starts: np.ndarray):
        self.codes = codes
        n = len(codes)
        first, count = np.arange(n), np.ones(n, np.int64)
        cells = np.append(cell_starts, n)
        # of each level: shared ones, shared zeros, first child, number of children, last code below
        self.levels = [(codes.copy(), ~codes, first, count, np.arange(n))]
        while len(self.levels[-1][0]) > len(cell_starts):
            ones, zeros, _, _, last = self.levels[-1]
            place = np.arange(len(ones)) - np.repeat(cells[:-1], np.diff(cells))
            heads = np.flatnonzero(place % FAN == 0)
            size = np.diff(np.append(heads, len(ones)))
            self.levels.append((np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads), heads, size, last[heads + size - 1]))
            cells = np.concatenate((np.searchsorted(heads, cells[:-1]), [len(heads)]))
        # a node keeps the shared bits that the node above it does not hold already
        for k in range(len(self.levels) - 1):
            ones, zeros, first, size, last = self.levels[k]
            above = np.repeat(self.levels[k + 1][0] | self.levels[k + 1][1], self.levels[k + 1][3])
            self.levels[k] = (ones & ~above, zeros & ~above, first, size, last)
        self.root = np.repeat(np.arange(len(cell_starts)), np.diff(np.append(cell_starts, n)))

    def links(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later code of its cell) at most `distance` bits apart."""
        query, node, far = queries, self.root[queries], np.zeros(len(queries), np.uint8)
        for k in range(len(self.levels) - 1, -1, -1):
            ones, zeros, _, _, last = self.levels[k]
            code = self.codes[query]
            far = far + np.bitwise_count((~code & ones[node]) | (code & zeros[node]))
            near = (far <= distance) & (last[node] > query)
            query, node, far = query[near], node[near], far[near]
            if k:
                _, _, first, size, _ = self.levels[k]
                many = size[node]
                query, far, node = np.repeat(query, many), np.repeat(far, many), A.ragged(first[node], many)
        return query, node


def spanning(codes: np.ndarray, cell_starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, root code) for each code that links to another one of its cell."""
    index = GrayIndex(codes, cell_starts)
    n, widest = len(codes), int(np.diff(np.append(cell_starts, len(codes))).max())
    root = np.arange(n)
    step = max(1, FRONTIER // widest)
    for at in range(0, n, step):
        a, b = index.links(np.arange(at, min(n, at + step)), distance)
        while len(a):  # join the pairs' trees until each pair is in one
            ra, rb = root[a], root[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = low != high
            a, b = a[open_], b[open_]
            np.minimum.at(root, high[open_], low[open_])
            while (root[root] != root).any():
                root = root[root]
    tied = np.flatnonzero(root != np.arange(n))
    return codes[tied], codes[root[tied]]


def cell_links(batches, distance: int):
    """Over rows sorted by cell: whole cells are indexed together, about ROWS codes at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def run(cells: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), cells))
        cells, codes = cells[order], codes[order]
        starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        a, b = spanning(codes, starts, distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64), pa.int64()), pa.array(b.view(np.int64), pa.int64())], names=["u", "v"])

    offset, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(A.column(batch, c).cast(pa.int64())) for c in ("page", "key", "cell")])
        change = np.any(key[:, 1:] != key[:, :-1], axis=0)
        new = np.append(last is not None and bool((key[:, 0] != last).any()), change)
        cells = offset + np.cumsum(new)
        offset, last = int(cells[-1]), key[:, -1]
        held.append((cells, np.asarray(A.column(batch, "fp")).view(np.uint64)))
        if sum(len(c) for c, _ in held) >= ROWS:
            cells, codes = (np.concatenate(x) for x in zip(*held))
            whole = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            held = [(cells[whole:], codes[whole:])]
            if whole:
                yield run(cells[:whole], codes[:whole])
    if held:
        yield run(*(np.concatenate(x) for x in zip(*held)))


def classes(prints: DataFrame, distance: int) -> DataFrame:
    """fp, root, component_id of every fingerprint that several rows or a link share."""
    shared_root(prints.sparkSession)
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).checkpoint()
    held = pages(nodes.select("fp"), distance)
    by_cell = held.repartition("page", "key", "cell").sortWithinPartitions("page", "key", "cell")
    links = by_cell.mapInArrow(lambda batches: cell_links(batches, distance), "u long, v long")
    grouped = nodes.join(components(links).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    whole = grouped.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("rows")).filter("rows > 1").checkpoint()
    return grouped.select("fp", "root").join(whole, "root").select("fp", "root", "component_id").checkpoint()


def near_duplicates(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id (the least id that its links reach) of every row."""
    shared_root(docs.sparkSession)
    prints = fingerprints(docs, shingle, id_col, text_col).checkpoint()
    out = prints.join(classes(prints, distance), "fp", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def first_of_groups(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the least id, with all columns
    of docs. Rows that share an id are told apart by their texts; rows equal in
    both are one document and stay or go together."""
    shared_root(docs.sparkSession)
    prints = fingerprints(docs, shingle, id_col, text_col).checkpoint()
    tied = prints.join(classes(prints, distance), "fp").withColumn("first", F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = tied.filter("first").groupBy("root").agg(F.min("copy").alias("stays")).checkpoint()
    gone = tied.join(chosen, "root").filter(~(F.col("first") & (F.col("copy") == F.col("stays")))).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_row_id"), F.xxhash64(F.col(text_col)).alias("_row_copy"))
    return rows.join(gone, rows["_row_id"].eqNullSafe(gone["_id"]) & (rows["_row_copy"] == gone["_copy"]), "left_anti").select("_row.*")
