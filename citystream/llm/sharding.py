"""Sharding (operator 3) by fixed virtual slots, from DataFrame functions only.

A record's id is hashed into one of SLOTS slots; the number of slots never
changes. A versioned map says which shard holds each slot. Version 0 deals the
slots out in turn. To rebalance, bytes are summed per slot (a partial aggregate
with SLOTS rows at most) and a new version is made by editing the last one:
slots move from the fullest to the emptiest shard while that lessens the
difference, so as few slots move as need to. All versions are stored as one
table, partitioned by version, and records find their shard by a join on the
slot (the map has SLOTS rows at any size of the data).

The law that holds is `bytes`: sizes near equal. A record's place in its shard
is its slot's offset in the shard plus its place in the slot, so numbering is
spread over SLOTS windows and no shard is one task's work.

Defined results: a null text has no bytes (size 1) and the checksum of the
empty text; a row without id is hashed by its text; repeated rows fall in one
slot and each get a place; ties within a slot go by id, size and checksum; an
empty table gives an empty result; other columns are ignored. Texts are only
measured, so long ones don't matter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citystream.session import scratch_path

SLOTS = 4096


def slots_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, vslot of every row."""
    doc_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    key = F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    return docs.select(doc_id.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.pmod(key, F.lit(SLOTS)).cast("int").alias("vslot"))


def first_map(shards: int) -> list[int]:
    """Version 0: of each slot its shard, dealt out in turn."""
    return [slot % shards for slot in range(SLOTS)]


def rebalanced(slot_map: list[int], weight: list[int], shards: int) -> list[int]:
    """The map edited until no move of a slot from the fullest to the emptiest
    shard, nor an exchange of two of their slots, brings the two nearer."""
    new = list(slot_map)
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(new):
        held[shard].append(slot)
    load = [sum(weight[s] for s in slots) for slots in held]
    while True:
        full, bare = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[bare]
        # a move of weight w leaves a gap of |gap - 2 w|: the best w is gap / 2
        moves = [(abs(gap - 2 * weight[s]), s, None) for s in held[full] if 0 < weight[s] < gap]
        if not moves or min(moves)[0] * 50 > gap:
            mine, theirs = (sorted(held[x], key=lambda s: weight[s]) for x in (full, bare))
            at = 0
            for s in mine:  # of each slot the exchange whose difference is nearest gap / 2
                while at + 1 < len(theirs) and abs(gap - 2 * (weight[s] - weight[theirs[at + 1]])) <= abs(gap - 2 * (weight[s] - weight[theirs[at]])):
                    at += 1
                if theirs and 0 < weight[s] - weight[theirs[at]] < gap:
                    moves.append((abs(gap - 2 * (weight[s] - weight[theirs[at]])), s, theirs[at]))
        if not moves:
            return new
        _, out, back = min(moves, key=lambda m: (m[0], m[2] is not None, m[1]))
        for slot, a, b in ((out, full, bare), *(((back, bare, full),) if back is not None else ())):
            new[slot] = b
            held[a].remove(slot)
            held[b].append(slot)
            load[a] -= weight[slot]
            load[b] += weight[slot]


def store(spark: SparkSession, path: str, version: int, slot_map: list[int]) -> None:
    """Writes a version of the map."""
    shards = F.split(F.lit(",".join(map(str, slot_map))), ",").cast("array<int>")
    spark.range(1, numPartitions=1).select(F.posexplode(shards).alias("vslot", "shard")).write.mode("overwrite").parquet(f"{path}/version={version}")


def stored(spark: SparkSession, path: str, version: int) -> DataFrame:
    """vslot, shard of a stored version."""
    return spark.read.parquet(path).filter(F.col("version") == version).select("vslot", "shard")


def weights(rows: DataFrame) -> list[int]:
    """Bytes of each slot."""
    out = [0] * SLOTS
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect():  # SLOTS rows at most
        out[r["vslot"]] = r["bytes"]
    return out


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot, map_version of every row."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "slot-map")
    rows = slots_of(docs, id_col, text_col)
    dealt = first_map(shards)
    store(spark, path, 0, dealt)
    store(spark, path, 1, rebalanced(dealt, weights(rows), shards))
    where = stored(spark, path, 1)
    counts = rows.groupBy("vslot").agg(F.count("*").alias("n")).join(where, "vslot")
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("vslot", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    placed = rows.withColumn("inside", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "vslot")  # SLOTS rows
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("inside")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"), F.lit(1).alias("map_version"))
