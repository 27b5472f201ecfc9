"""Streaming sinks and query runner.

Every query has its own checkpoint location (exactly-once recovery); sinks are
file sinks (append), `foreachBatch` writers that keep each micro-batch apart (a
replayed batch overwrites its own folder), a labelled console, and Kafka in
deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TO_THE_END = {"availableNow": True}


def start_files(df: DataFrame, path: str, checkpoint: str, name: str, partition_by: list[str] | None = None,
                trigger: dict | None = None, form: str = "parquet") -> StreamingQuery:
    w = (df.writeStream.format(form).option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append").queryName(name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(**(trigger or TO_THE_END)).start()


def print_batch(label: str, rows: int = 20):
    """foreachBatch function that prints a label and the first rows of a micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"--- {label}, batch {batch_id} ---")
        batch.show(rows, truncate=False)
    return write


def start_console(df: DataFrame, checkpoint: str, label: str, trigger: dict | None = None,
                  output_mode: str = "append") -> StreamingQuery:
    return start_foreach_batch(df, print_batch(label), checkpoint, f"{label}_console", trigger or {"processingTime": "10 seconds"}, output_mode)


def _record_sink(topic: str, options: dict) -> tuple[str, dict]:
    """Format and options of a topic's writer. `"format"` in the options names another sink
    of records than Kafka; a folder sink writes to `<path>/<topic>`."""
    rest = {k: v for k, v in options.items() if k not in ("format", "path")}
    if options.get("format", "kafka") == "kafka":
        return "kafka", rest | {"topic": topic}
    return options["format"], rest | {"path": f"{options['path']}/{topic}"}


def start_kafka(records: DataFrame, topic: str, checkpoint: str, name: str,
                kafka_options: dict, trigger: dict | None = None,
                output_mode: str = "append") -> StreamingQuery:
    """`records` has `value` (and optionally `key`) columns; needs the Kafka connector."""
    form, options = _record_sink(topic, kafka_options)
    w = (records.writeStream.format(form).options(**options).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).queryName(name))
    return w.trigger(**(trigger or TO_THE_END)).start()


def publish(records: DataFrame, topic: str, kafka_options: dict) -> None:
    """Batch form, for a `foreachBatch` function."""
    form, options = _record_sink(topic, kafka_options)
    records.write.format(form).options(**options).mode("append").save()


def batch_writer(path: str, preview_order: list[str] | None = None, form: str = "parquet", options: dict | None = None,
                 preview_rows: int = 20):
    """foreachBatch function writing each micro-batch under `path/batch_id=<id>`,
    overwriting that folder on replay; `form` may be any batch format (a JDBC
    table gets the rows appended with their batch_id). With `preview_order`, the
    first `preview_rows` rows of the batch in that order are printed (a top-n,
    never the whole batch)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if preview_order:
            print(f"--- batch {batch_id} ---")
            batch.orderBy(*preview_order).show(preview_rows, truncate=False)
        if form == "jdbc":
            batch.withColumn("batch_id", F.lit(batch_id)).write.format("jdbc").options(**(options or {})).mode("append").save()
        else:
            batch.write.format(form).options(**(options or {})).mode("overwrite").save(f"{path}/batch_id={batch_id}")
    return write


def batches(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """All micro-batches that a file `batch_writer` has written."""
    return spark.read.format(form).option("header", True).load(path)


def start_foreach_batch(df: DataFrame, fn, checkpoint: str, name: str,
                        trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    w = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).queryName(name))
    return w.trigger(**(trigger or TO_THE_END)).start()


def run_to_end(q: StreamingQuery) -> StreamingQuery:
    """Waits for a query that ends by itself (availableNow)."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any active query of the session terminates (several
    queries run side by side, e.g. lake ingest, console and aggregates).
    False if the time is over first."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(int(timeout_s))
