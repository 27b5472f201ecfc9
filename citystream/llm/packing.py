"""Best-fit packing (operator 1): vector best-fit over three capacities.

Every piece of a document needs a vector (tokens, one document, attention cost
length^2); a sequence offers (tokens, documents, attention cost). Pieces go in
falling length to the open sequence that scores best among those that hold them
under all three capacities: by weighted dot-product of need and residual (most
first), or by weighted norm of what would be left (least first); a new sequence
opens when none holds the piece.

A need depends on the length alone, and lengths are at most the capacity. So
the whole choice is made over a histogram of lengths (one count per length,
however many documents there are): equal sequences are kept as one class with a
count and a step moves as many of them at once as the counts allow. The steps
form a plan of bounded size (at most one step per class and length) that says
which rank of which length goes to which sequence and place. Ranks among pieces
of equal length come from counts per (length, bucket of documents), so that a
length that a third of all pieces share is numbered in many tasks.

Defined results: a null text counts as empty; every document ends with the id
`end`, so an empty one is one piece of one token; a document longer than the
capacity is cut into full pieces behind a first piece that may be shorter;
repeated rows and null ids are packed like any other row; ties go by id, piece
and checksum; an empty table gives an empty result; other columns are ignored.
Very long texts are encoded whole."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citystream.session import shared_root
from citystream.llm import arrowtext as A
from citystream.llm import bytebpe

#: Buckets of documents within which pieces of equal length are numbered.
RANK_BUCKETS = 1024


@dataclass(frozen=True)
class Capacity:
    tokens: int
    documents: int
    attention: int  # sum of squared piece lengths


@dataclass(frozen=True)
class Rule:
    score: str  # "dot" or "norm"
    weights: tuple[float, float, float]  # of tokens, documents, attention, each in parts of its capacity


#: Rules tried on the histogram; the one that opens the fewest sequences is used.
RULES = (Rule("norm", (1.0, 0.0, 0.0)), Rule("norm", (1.0, 0.1, 0.1)), Rule("norm", (1.0, 0.0, 1.0)), Rule("dot", (1.0, 0.1, 0.1)))


@dataclass(frozen=True)
class Plan:
    """Step k puts the pieces of length[k] with ranks rank[k] .. rank[k] + count[k] - 1
    into sequences sequence[k] .. at place offset[k]."""
    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(histogram: dict[int, int], capacity: Capacity, rule: Rule) -> Plan:
    """Vector best-fit, largest first, over counts of equal pieces."""
    weights = np.asarray(rule.weights)
    whole = np.asarray([capacity.tokens, capacity.documents, capacity.attention], float)
    left = np.zeros((64, 3), np.int64)  # residual vector of each class of equal sequences
    many = np.zeros(64, np.int64)
    ids: list[list[tuple[int, int]]] = []  # of each class its sequences, as (first, count)
    steps: list[tuple[int, int, int, int, int]] = []
    where: dict[tuple[int, int, int], int] = {}
    opened = 0

    def add(residual: tuple[int, int, int], runs: list[tuple[int, int]]) -> None:
        nonlocal left, many
        if min(residual) < 1:
            return  # holds nothing more
        if residual not in where:
            if len(ids) == len(many):
                left, many = np.vstack((left, np.zeros_like(left))), np.concatenate((many, np.zeros_like(many)))
            where[residual] = len(ids)
            left[len(ids)] = residual
            ids.append([])
        at = where[residual]
        ids[at] += runs
        many[at] += sum(n for _, n in runs)

    for length in sorted(histogram, reverse=True):
        need = np.asarray([length, 1, length * length], np.int64)
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence of {capacity}")
        todo, rank = histogram[length], 0
        while todo:
            fits = np.flatnonzero((many[:len(ids)] > 0) & (left[:len(ids)] >= need).all(axis=1))
            if len(fits):
                rest = left[fits]
                if rule.score == "dot":
                    score = -((rest / whole) * (need / whole) * weights).sum(axis=1)
                else:
                    score = (((rest - need) / whole) ** 2 * weights).sum(axis=1)
                at = int(fits[np.lexsort((rest[:, 2], rest[:, 1], rest[:, 0], score))[0]])
                take, runs, residual = min(todo, int(many[at])), [], tuple((left[at] - need).tolist())
                offset, rest_to_take = capacity.tokens - int(left[at, 0]), take
                while rest_to_take:
                    first, n = ids[at].pop()
                    used = min(n, rest_to_take)
                    runs.append((first, used))
                    if used < n:
                        ids[at].append((first + used, n - used))
                    rest_to_take -= used
                many[at] -= take
            else:
                # as many new sequences as hold the rest, filled with this length alone for now
                each = int((whole // need).min())
                take = -(-todo // each)
                runs, offset, residual = [(opened, take)], 0, tuple((whole.astype(np.int64) - need).tolist())
                opened += take
            for first, n in runs:
                steps.append((length, rank, n, first, offset))
                rank += n
            add(residual, runs)
            todo -= take
    table = np.asarray(sorted(steps), np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences=opened)


def best_plan(histogram: dict[int, int], capacity: Capacity, rules: tuple[Rule, ...] = RULES) -> Plan:
    return min((plan(histogram, capacity, rule) for rule in rules), key=lambda p: p.sequences)


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `total` ids: full ones behind a first one that may be shorter."""
    first = total % most or most
    return [(0, first)] + [(at, most) for at in range(first, total, most)]


def pieces(docs: DataFrame, tokenizer_path: str, most: int, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def encode(batches):
        encoder = bytebpe.Encoder(tokenizer_path)
        for batch in batches:
            for part, texts in A.slices(batch):
                ids, ends = encoder.ids(texts)
                own, rows = A.column(part, "doc_id").to_pylist(), []
                for i, doc in enumerate(own):
                    doc_ids = np.append(ids[ends[i]:ends[i + 1]], np.uint32(end)).astype("<u4")
                    rows += [(doc, k, at, n, zlib.crc32(doc_ids[at:at + n].tobytes())) for k, (at, n) in enumerate(cut(len(doc_ids), most))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def ranked(items: DataFrame) -> DataFrame:
    """items with `rank`: 0, 1, ... among those of equal length, numbered in buckets."""
    hashed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_BUCKETS)))
    counts = hashed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (hashed.withColumn("inside", F.row_number().over(inside) - 1)
            .join(base, ["length", "bucket"])
            .withColumn("rank", F.col("base") + F.col("inside")).drop("bucket", "inside", "base"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: Capacity, end: int = 0, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    shared_root(spark)
    # encoded once: the histogram and the placing both read this table (a few numbers per piece)
    items = pieces(docs, tokenizer_path, capacity.tokens, end, id_col, text_col).checkpoint()
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length at most
    best = best_plan(histogram, capacity, rules)
    shipped = spark.sparkContext.broadcast(best)  # steps: bounded by lengths and classes, not by documents

    def place(batches):
        steps = shipped.value
        # steps are sorted by (length, rank): a piece belongs to the last step at or before its own
        first = {int(n): int(i) for n, i in zip(*np.unique(steps.length, return_index=True))}
        widest = int(max((steps.rank + steps.count).max(), 1)) if len(steps.rank) else 1
        order = {n: i for i, n in enumerate(first)}
        keys = np.asarray([order[int(n)] for n in steps.length], np.int64) * widest + steps.rank
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (np.asarray(A.column(batch, c)) for c in ("length", "rank"))
            at = np.searchsorted(keys, np.asarray([order[n] for n in length.tolist()], np.int64) * widest + rank, side="right") - 1
            kept = [A.column(batch, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(steps.sequence[at] + rank - steps.rank[at], pa.int64()), pa.array(steps.offset[at], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(items).mapInArrow(place, schema)
