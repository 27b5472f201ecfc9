"""Exact dedup (operator 6), built from DataFrame functions only.

Texts are equal when identical after deleting ASCII white space. Of equal texts
the row with the most code points in its original text stays, then the one with
the smallest id. Equal texts are combined in three stages, each of which groups
by the digest and the full normalised content:

1. locally: the partial aggregate of a task leaves one row per content and task;
2. salted: those rows meet by (digest, content, salt), the salt being the task
   they come from, so a group that a third of all rows share is merged in SALTS
   places;
3. globally: at most SALTS winners of each content are combined.

The verdict goes back to the documents by an outer join with the groups of two
and more. That join ships no text: it is keyed by SHA-256, a second hash and
the length. The groups are checkpointed first, so both join inputs are plain
shuffles and AQE splits a hot group.

Defined results: a null text counts as empty; all empty texts are one group; a
null id loses ties to every other id, and its group is found all the same; of
rows that share both id and normalised text (repeated rows) exactly one is
kept; an empty table gives an empty result; other columns are ignored by
`verdicts` and carried through by `deduplicated` whatever their names. Very
long texts are compared whole."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.session import scratch_path, shared_root

#: Places in which one group of equal texts is merged before the last combine.
SALTS = 64

#: Ids are ranked as NO_ID_BELOW - id, from 1 to 2^64; a row without id has 0.
NO_ID_BELOW = 2 ** 63
STEP = 2 ** 65  # above every rank


def normalised(text: Column) -> Column:
    """The text without \\x20 and \\x09-\\x0D; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in " \t\n\x0b\f\r":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _merit(length: Column, doc_id: Column) -> Column:
    """One number that is larger for more code points, then for a smaller id. A
    decimal is of fixed width, so the aggregate stays a hash aggregate."""
    rank = F.coalesce(F.lit(Decimal(NO_ID_BELOW)).cast("decimal(20,0)") - doc_id.cast("decimal(19,0)"), F.lit(0).cast("decimal(21,0)"))
    return (length.cast("decimal(10,0)") * F.lit(Decimal(STEP)).cast("decimal(20,0)") + rank).cast("decimal(38,0)")


def _winner(merit: Column) -> tuple[Column, Column]:
    """(length, id) of a merit."""
    step = F.lit(Decimal(STEP)).cast("decimal(20,0)")
    rank = (merit % step).cast("decimal(20,0)")
    return F.floor((merit - rank) / step).cast("long"), F.when(rank > 0, (F.lit(Decimal(NO_ID_BELOW)).cast("decimal(20,0)") - rank).cast("long"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _len (code points of the original), _norm, _sha, and the second hash."""
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.length(text_col), F.lit(0)).alias("_len"), normalised(F.col(text_col)).alias("_norm"))
    return own.select("*", F.unhex(F.sha2("_norm", 256)).alias("_sha"), F.xxhash64("_norm").alias("_hash2"), F.length("_norm").alias("_size"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text that occurs twice or more: its key, n, and the winner's _keep_len and _keep_id."""
    shared_root(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col).select("_sha", "_hash2", "_size", "_norm", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt"), _merit(F.col("_len"), F.col("_id")).alias("_merit"))
    key = ["_sha", "_hash2", "_size", "_norm"]
    salted = rows.groupBy(*key, "_salt").agg(F.count("*").alias("_n"), F.max("_merit").alias("_merit"))
    whole = salted.groupBy(*key).agg(F.sum("_n").alias("_n"), F.max("_merit").alias("_merit"))
    keep_len, keep_id = _winner(F.col("_merit"))
    found = whole.filter("_n > 1").select("_sha", "_hash2", "_size", "_n", keep_len.alias("_keep_len"), keep_id.alias("_keep_id"))
    return found.checkpoint()


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = _keyed(docs, id_col, text_col).drop("_norm")
    out = rows.join(groups(docs, id_col, text_col), KEY, "left")
    alone = F.col("_n").isNull()
    best = alone | _best(F.col("_len"), F.col("_id"))
    # repeated rows of one id: the first of the best ones
    order = Window.partitionBy("_sha", "_id").orderBy(F.col("_len").desc())
    return out.select(
        F.col("_id").alias("doc_id"), F.when(alone, F.col("_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).alias("group_size"), (best & (F.row_number().over(order) == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


KEY = ["_sha", "_hash2", "_size"]


def _best(row_len: Column, row_id: Column) -> Column:
    return (row_len == F.col("_keep_len")) & row_id.eqNullSafe(F.col("_keep_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of docs (kept in one struct meanwhile,
    so their names don't matter).

    Whole rows move once, in the join with the verdicts. Winners that are repeated
    rows are found before, without texts, and written as a table of their own: it
    is nearly always tiny, the planner sees its size, and rows needn't move for it."""
    spark = docs.sparkSession
    found = groups(docs, id_col, text_col)
    path = scratch_path(spark, "exact-dedup-repeated")
    keyed = _keyed(docs, id_col, text_col).drop("_norm").join(found, KEY).filter(_best(F.col("_len"), F.col("_id")))
    keyed.groupBy(*KEY, "_keep_len", "_keep_id").agg(F.count("*").alias("_times")).filter("_times > 1").drop("_times").write.parquet(path)
    repeated = spark.read.parquet(path)
    norm = docs.select(F.struct("*").alias("_row"), normalised(F.col(text_col)).alias("_norm"))
    rows = norm.select("_row", F.unhex(F.sha2("_norm", 256)).alias("_sha"), F.xxhash64("_norm").alias("_hash2"), F.length("_norm").alias("_size"))
    own = _best(F.coalesce(F.length(f"_row.`{text_col}`"), F.lit(0)), F.col(f"_row.`{id_col}`").cast("long"))
    verdict = found.join(repeated.select(*KEY, F.lit(True).alias("_many")), KEY, "left")
    stays = rows.join(verdict, KEY, "left").filter(F.col("_n").isNull() | (own & F.col("_many").isNull()))
    one = Window.partitionBy(*KEY).orderBy(F.lit(1))
    first = rows.join(repeated, KEY).filter(own).withColumn("_rn", F.row_number().over(one)).filter("_rn = 1")
    return stays.select("_row.*").union(first.select("_row.*"))
