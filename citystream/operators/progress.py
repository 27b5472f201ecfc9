"""Consumer-group progress on one topic: per group and partition, messages
consumed, last offset, and how many progress reports the group emits (one
every `interval` messages). On a table all groups have read the same records,
so one partial aggregate per partition serves every group; a stream job counts
what its own group has read (`streaming.jobs.progress_stream`), and how far it
is behind is in `streaming.lag`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Consumer groups on the signals topic and their report interval.
GROUPS = [("HIGH_PRIORITY", 20), ("STANDARD_PRIORITY", 5)]


def group_progress(envelope: DataFrame, groups=GROUPS) -> DataFrame:
    per_partition = (envelope.groupBy("partition")
                     .agg(F.count(F.lit(1)).alias("messages"),
                          F.max("offset").alias("last_offset")))
    return group_progress_from_counts(per_partition, groups)


def group_progress_from_counts(per_partition: DataFrame, groups=GROUPS) -> DataFrame:
    """(partition, messages, last_offset) -> one row per group and partition."""
    g = F.inline(F.array(*[F.struct(F.lit(name).alias("consumer_group"),
                                    F.lit(n).cast("bigint").alias("report_interval"))
                           for name, n in groups]))
    return (per_partition.select("*", g)
            .select("consumer_group", "partition", "messages", "last_offset",
                    F.expr("messages div report_interval")
                     .alias("progress_reports")))
