"""Streaming sources. Deployment reads Kafka topics; the bundled tables are
replayed as a Kafka-shaped file stream so the very same decode path and
transformations run in tests and benchmarks.

Admission per micro-batch is always bounded (`maxOffsetsPerTrigger` for Kafka,
`maxFilesPerTrigger` for files; both can be set by the source), so per-key
state processors see at most one micro-batch of rows at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas
from citystream.session import configure
from citystream.sources import feeds, kafka

#: Records of a topic, or files of a replayed one, that a micro-batch takes in.
MOST_OFFSETS = 5_000_000
MOST_FILES = 8


def topic_stream(spark: SparkSession, feed_name: str, source: dict | None = None) -> DataFrame:
    """Kafka-shaped records of one feed.

    source = {"format": "kafka", "options": {...}} reads a real topic (needs
    the Kafka connector on the classpath); `options` may hold the job's own
    startingOffsets, consumer group and admission. A restart on the same
    checkpoint goes on from its offsets instead. Otherwise `{"path": dir}` replays
    `events*.parquet` files in `dir` as the feed's topic, with `"dirty": True`
    spoilt as a real one is."""
    configure(spark)
    source = source or {}
    if source.get("format") == "kafka":
        opts = {"subscribe": f"city.{feed_name}", "startingOffsets": "latest", "maxOffsetsPerTrigger": str(MOST_OFFSETS), **source.get("options", {})}
        return spark.readStream.format("kafka").options(**opts).load()
    ev = (spark.readStream.schema(schemas.EVENTS)
          .option("pathGlobFilter", source.get("glob", "events*.parquet"))
          .option("maxFilesPerTrigger", int(source.get("max_files_per_trigger", MOST_FILES))).parquet(source["path"]))
    records = kafka.envelope(feeds.feed(ev, feed_name), feed_name)
    return feeds.dirty(records) if source.get("dirty") else records


def topic_batch(spark: SparkSession, feed_name: str, kafka_options: dict) -> DataFrame:
    """Bounded read of a topic, from its earliest to its present end. `jobs.drain_topic`
    remembers how far it has read."""
    opts = {"subscribe": f"city.{feed_name}", "startingOffsets": "earliest", "endingOffsets": "latest", **kafka_options}
    return spark.read.format("kafka").options(**opts).load()


def feed_stream(spark: SparkSession, feed_name: str, source: dict | None = None) -> DataFrame:
    """Decoded, typed feed rows with `event_time`, `seq`, `timestamp_ms`.

    With `"ingest_time_fallback": True` in the source, a record whose timestamp
    cannot be parsed takes the broker's ingest time instead of NULL (and so is
    not a dead letter)."""
    dec = kafka.decode(topic_stream(spark, feed_name, source), feed_name)
    if (source or {}).get("ingest_time_fallback"):
        dec = dec.withColumn("event_time", F.coalesce("event_time", "ingest_time"))
    return dec.withColumn("timestamp_ms", F.unix_millis("event_time"))
