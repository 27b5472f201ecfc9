"""Substring dedup (operator 8): Rabin-Karp hashes of every window of words.

Each window of `width` consecutive words of one document has a Rabin-Karp hash:
a polynomial in its words' hashes, modulo 2^64, found for all windows at once.
A second polynomial adds bytes to the hash as the corpus grows, so that the
expected number of chance matches stays below 2^-7 at any size.

Spark brings equal hashes together and finds the least document that each
starts in. A word is removed if it is covered by a window that also starts in
a document with a smaller id; the windows of a document that do are merged
into maximal intervals.

Every window counts, so what is shuffled is kept small: a task sorts the hashes
of a batch, keeps one row per distinct hash with its least document (a very
common window leaves one row per batch; its other documents' windows are known
to repeat at once), and sends each range of the hash space its hashes as
differences, packed in one binary. There are at most RANGES ranges, however large the
corpus, so a batch's cells stay large. Behind the exchange a range is split into
buckets that fit in memory, which Spark sorts (and spills) within the task, and the
buckets are worked off one after the other. Answers go back as (document,
hashes), and meet the text in one join on the id.

Defined results: a null text has no words; a row without id counts as an id of 2^62 or
more that follows from its text, so it is behind all usual ids and rows without id
are many documents; rows of equal id never remove each other's windows (all rows
of one id get one list of windows, so an id should not stand for very many rows); texts of fewer words than a window keep all;
repeated rows get equal results; an empty table gives an empty result; other
columns are ignored by `removals` and carried by `deduplicated`. Very long
texts are hashed whole."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A

#: Text that one bucket of the hash space stands for, on average.
BUCKET_BYTES = 8 << 20
#: Windows whose hashes a task sorts at once.
BATCH_WINDOWS = 1 << 20
#: Most ranges of the hash space that a batch is dealt over.
RANGES = 4096

BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd multipliers of the two polynomials
NO_ID = 2 ** 62  # least rank of a row without id


@dataclass(frozen=True)
class Scale:
    ranges: int
    buckets: int
    extra: int  # bytes of the second hash that count


def scale(docs: DataFrame, text_col: str) -> Scale:
    """Buckets and hash width for a corpus of this many bytes."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return scale_of(total)


def scale_of(total: int) -> Scale:
    bits, buckets = 2 * math.log2(max(total / 4, 2)) + 8, max(16, -(-total // BUCKET_BYTES))
    ranges = min(RANGES, buckets)
    # each range is a whole number of buckets
    return Scale(ranges, -(-buckets // ranges) * ranges, min(8, max(0, math.ceil((bits - 64) / 8))))


def rank(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID))


def window_hashes(words: pa.Array, offsets: np.ndarray, width: int, extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of texts with these words: first and second hash, its first word, its text."""
    many = np.maximum(np.diff(offsets) - width + 1, 0)
    first = A.ragged(offsets[:-1], many)
    text = np.repeat(np.arange(len(many)), many)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), first, text
    coded = words.dictionary_encode()
    keys = coded.dictionary.to_numpy(zero_copy_only=False)
    index = np.asarray(coded.indices)
    out = []
    for seed, base in enumerate(BASES):
        if seed and not extra:
            out.append(np.zeros(len(first), np.uint8))  # no second hash: as little memory as can be
            continue
        each = np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in keys), np.uint64, len(keys))[index]
        run = each[:len(each) - width + 1].copy()
        for k in range(1, width):
            run *= np.uint64(base)
            run += each[k:len(each) - width + 1 + k]
        out.append(run[first] >> np.uint64(64 - 8 * extra) if seed else run[first])
    return out[0], out[1], first, text


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as byte planes: the zero planes of small ones cost next to nothing."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").reshape(n).astype(np.uint64)


#: A cell: n hashes of one batch that fall in one range or bucket, each with the least rank
#: that holds it (known = false), or windows known to repeat, with their ranks.
CELL = "bucket long, known boolean, n long, hash binary, second binary, base long, rank binary"
CELL_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]


def _cell_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CELL_TYPES)], names=["bucket", "known", "n", "hash", "second", "base", "rank"])


def cells(hashes: np.ndarray, second: np.ndarray, ranks: np.ndarray, buckets: np.ndarray, known: bool) -> list[tuple]:
    """Cells of hashes that are sorted by (bucket, hash); bucket may be a range."""
    cuts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else []
    out = []
    for a, b in zip(cuts, np.append(cuts[1:], len(buckets))):
        base = int(ranks[a:b].min())
        steps = np.diff(hashes[a:b], prepend=np.uint64(0))
        out.append((int(buckets[a]), known, int(b - a), packed(steps), packed(second[a:b]), base, packed((ranks[a:b] - base).astype(np.uint64))))
    return out


def bucket_of(hashes: np.ndarray, many: int) -> np.ndarray:
    """Equal ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(many) >> np.uint64(32)).astype(np.int64)


def batch_cells(hashes: np.ndarray, second: np.ndarray, ranks: np.ndarray, many: int) -> pa.RecordBatch:
    order = np.lexsort((ranks, second, hashes)) if second.any() else np.lexsort((ranks, hashes))
    hashes, second, ranks = hashes[order], second[order], ranks[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (second[1:] != second[:-1]))
    least = np.repeat(ranks[new], np.diff(np.append(np.flatnonzero(new), len(ranks))))
    rows = cells(hashes[new], second[new], ranks[new], bucket_of(hashes[new], many), False)
    again = ranks > least
    # windows known to repeat are dealt by document, so a common one isn't one bucket's load
    home = bucket_of((ranks[again].astype(np.uint64) + np.uint64(1)) * np.uint64(BASES[0]), many)
    order = np.lexsort((hashes[again], home))
    rows += cells(hashes[again][order], second[again][order], ranks[again][order], home[order], True)
    return _cell_batch(rows)


def repeated(docs: DataFrame, width: int, at: Scale, id_col: str, text_col: str) -> DataFrame:
    """rank, hash, second: windows of a document that also start in one of smaller rank."""

    def hashed(batches):
        held, n = [], 0
        for batch in batches:
            for part, texts in A.slices(batch):
                h, second, _, text = window_hashes(*A.words(texts), width, at.extra)
                held.append((h, second, np.asarray(A.column(part, "rank"))[text]))
                n += len(h)
                if n >= BATCH_WINDOWS:
                    yield batch_cells(*(np.concatenate(x) for x in zip(*held)), at.ranges)
                    held, n = [], 0
        if n:
            yield batch_cells(*(np.concatenate(x) for x in zip(*held)), at.ranges)

    own = docs.select(rank(F.col(id_col), F.col(text_col)).alias("rank"), F.col(text_col).alias("text"))
    laid = own.mapInArrow(hashed, CELL).repartition("bucket").sortWithinPartitions("bucket")
    if at.buckets > at.ranges:
        laid = laid.mapInArrow(lambda batches: split(batches, at), CELL).sortWithinPartitions("bucket")
    return laid.mapInArrow(lambda batches: met(batches, at), "rank long, hash long, second long")


def opened(batches, at: Scale):
    """(bucket, known, hashes, second hashes, ranks) of each cell."""
    for batch in batches:
        for bucket, known, n, h, second, base, r in zip(*(A.column(batch, c).to_pylist() for c in ("bucket", "known", "n", "hash", "second", "base", "rank"))):
            yield (bucket, known, np.cumsum(unpacked(h, n), dtype=np.uint64), unpacked(second, n).astype(np.uint64 if at.extra else np.uint8), unpacked(r, n).astype(np.int64) + base)


def split(batches, at: Scale):
    """Cells of ranges, sorted by range, as cells of buckets; several of a range at once."""
    held, n, now = [], 0, None

    def dealt(known: bool) -> list[tuple]:
        some = [c[2:] for c in held if c[1] == known]
        if not some:
            return []
        h, second, r = (np.concatenate(x) for x in zip(*some))
        order = np.argsort(h, kind="stable")
        # known windows needn't meet others: they stay with the range's first bucket
        buckets = bucket_of(h[order], at.buckets) if not known else np.full(len(h), now * (at.buckets // at.ranges))
        return cells(h[order], second[order], r[order], buckets, known)

    def flush() -> pa.RecordBatch:
        return _cell_batch(dealt(False) + dealt(True))

    for cell in opened(batches, at):
        if held and (cell[0] != now or n >= BATCH_WINDOWS):
            yield flush()
            held, n = [], 0
        now = cell[0]
        held.append(cell)
        n += len(cell[2])
    if held:
        yield flush()


def met(batches, at: Scale):
    """Windows of cells, sorted by bucket, that also start in a document of smaller rank."""
    def table(h: np.ndarray, second: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(h.view(np.int64), pa.int64()), pa.array(second.astype(np.uint64).view(np.int64), pa.int64())], names=["rank", "hash", "second"])

    def again(own: list[tuple]) -> pa.RecordBatch:
        h, second, r = (np.concatenate(x) for x in zip(*own))
        order = np.lexsort((r, second, h)) if second.any() else np.lexsort((r, h))
        h, second, r = h[order], second[order], r[order]
        new = np.append(True, (h[1:] != h[:-1]) | (second[1:] != second[:-1]))
        later = r > np.repeat(r[new], np.diff(np.append(np.flatnonzero(new), len(r))))
        return table(h[later], second[later], r[later])

    held, now = [], None
    for bucket, known, *windows in opened(batches, at):
        if bucket != now and held:
            yield again(held)
            held = []
        now = bucket
        if known:
            yield table(*windows)
        else:
            held.append(windows)
    if held:
        yield again(held)


def covered(words: pa.Array, offsets: np.ndarray, found: pa.ListArray, width: int, extra: int) -> np.ndarray:
    """Whether each word is in a window whose hash is among those found for its text."""
    gone = np.zeros(len(words) + 1, np.int64)
    some = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(found), 0))) if len(found) else []
    if not len(some):
        return gone[:-1] > 0
    h, second, first, text = window_hashes(words, offsets, width, extra)
    ends = np.searchsorted(text, np.arange(len(found) + 1))
    for i in some:
        a, b = ends[i], ends[i + 1]
        own = found[int(i)].values
        known = [np.asarray(own.field(k)).view(np.uint64) for k in (0, 1)]
        if extra:
            pairs = set(zip(*(k.tolist() for k in known)))
            hit = np.fromiter((p in pairs for p in zip(h[a:b].tolist(), second[a:b].tolist())), bool, b - a)
        else:
            hit = np.isin(h[a:b], known[0])
        gone[first[a:b][hit]] += 1
        np.subtract.at(gone, first[a:b][hit] + width, 1)
    return np.cumsum(gone)[:-1] > 0


def answered(docs: DataFrame, width: int, at: Scale, id_col: str, text_col: str, name: str) -> DataFrame:
    """docs with the column `name`: the hashes found for each row, or null."""
    # a set: repeated rows without id share a rank and their windows
    found = repeated(docs, width, at, id_col, text_col).groupBy("rank").agg(F.collect_set(F.struct("hash", "second")).alias("hashes"))
    rows = docs.select(F.struct("*").alias("row"), rank(F.col(id_col), F.col(text_col)).alias("rank"))
    return rows.join(found, "rank", "left").select("row.*", F.col("hashes").alias(name))


def kept_texts(texts: pa.Array, found: pa.ListArray, width: int, extra: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Kept words joined by one space, words, and removed words of each text."""
    words, offsets = A.words(texts)
    gone = covered(words, offsets, found, width, extra)
    sums = np.concatenate(([0], np.cumsum(gone)))
    removed = sums[offsets[1:]] - sums[offsets[:-1]]
    kept = words.filter(pa.array(~gone))
    lists = pa.ListArray.from_arrays(pa.array(offsets - sums[offsets], pa.int32()), kept)
    return pc.binary_join(lists, " "), np.diff(offsets), removed


def removals(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    at = scale(own, "text")

    def judge(batches):
        for batch in batches:
            for part, texts in A.slices(batch):
                kept, words, removed = kept_texts(texts, A.column(part, "found"), width, at.extra)
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in kept.to_pylist()]
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return answered(own, width, at, "doc_id", "text", "found").mapInArrow(judge, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with repeated windows' words taken out of the text: the kept words of
    such a text are joined by one space, other texts stay as they are.
    length_col, if given, is set to the new text's code points."""
    at = scale(docs, text_col)
    name = "found"
    while name in docs.columns:
        name += "_"

    def clean(batches):
        for batch in batches:
            for part, texts in A.slices(batch, text_col):
                kept, _, removed = kept_texts(texts, A.column(part, name), width, at.extra)
                changed = pa.array(removed > 0)
                new = {text_col: kept}
                if length_col:
                    new[length_col] = pc.utf8_length(kept)
                columns = [pc.if_else(changed, new[c].cast(part.schema.field(c).type), A.column(part, c)) if c in new else A.column(part, c) for c in docs_columns]
                yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return answered(docs, width, at, id_col, text_col, name).mapInArrow(clean, docs.schema)
