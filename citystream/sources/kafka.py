"""Kafka-shaped records: encoding a feed the way its producer publishes it,
and decoding the `value` JSON back into typed columns.

In deployment the envelope comes from `format("kafka")`; in tests and on the
bundled tables it is built from a feed, so the same decode path runs on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream import schemas
from citystream.functions.time import event_time

CORRUPT = "_corrupt_record"
# Partitions of the simulated topics.
DEFAULT_PARTITIONS = 3


def key_partition(key: Column, partitions: int) -> Column:
    """Partition of a simulated topic: the numeric suffix of the key modulo
    the partition count (a stand-in for the client's key hash that any engine
    can reproduce)."""
    return F.pmod(F.regexp_extract(key, r"([0-9]+)$", 1).cast("bigint"),
                  F.lit(partitions)).cast("int")


def envelope(feed_df: DataFrame, feed_name: str, partitions: int = DEFAULT_PARTITIONS) -> DataFrame:
    """Feed -> topic records (key, value, topic, partition, offset, timestamp)."""
    fields = schemas.FEEDS[feed_name].fieldNames()
    key = schemas.FEED_KEYS[feed_name]
    value_cols = [F.col(c) for c in fields]
    if feed_name == "smart_meters":
        # meters publish the epoch-ms timestamp as a JSON number
        value_cols[fields.index("timestamp")] = F.col("timestamp_ms").alias("timestamp")
    return feed_df.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*value_cols)).cast("binary").alias("value"),
        F.lit(f"city.{feed_name}").alias("topic"),
        key_partition(F.col(key), partitions).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )


def decode(env: DataFrame, feed_name: str) -> DataFrame:
    """Topic records -> typed feed rows plus `event_time`, `seq`, `partition`
    and the raw text of malformed values in `_corrupt_record`."""
    schema = T.StructType(schemas.FEEDS[feed_name].fields + [T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(F.col("value").cast("string"), schema,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a generator is a barrier for filters: pushed below the decode, each reference to a
    # field would parse the value again
    return (env.select(F.inline(F.array(data)), F.col("offset").alias("seq"), "partition",
                       F.col("timestamp").alias("ingest_time"))
               .withColumn("event_time", event_time("timestamp")))
