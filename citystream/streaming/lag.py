"""How far stream jobs are behind their sources, from the progress events of the jobs themselves.

`ProgressLog` keeps per job, micro-batch and source the rows read and the offsets Spark reports:
where the batch began and ended and what the source then had. From a topic's offsets
`offsets_behind` gives the lag per partition; a source without such offsets (a replayed folder)
has its lag in rows, `rows_behind`."""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Progress entries a log holds before the oldest go.
KEPT_EVENTS = 100_000
SCHEMA = "job string, run_id string, batch_id long, source int, input_rows long, start_offset string, end_offset string, latest_offset string"


class ProgressLog(StreamingQueryListener):
    def __init__(self, keep: int = KEPT_EVENTS):
        self._entries, self._ended, self._change = deque(maxlen=keep), set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.enter(p.name, str(p.runId), p.batchId, [(s.numInputRows, s.startOffset, s.endOffset, s.latestOffset) for s in p.sources])

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def enter(self, job: str, run_id: str, batch_id: int, sources: list[tuple]) -> None:
        with self._change:
            for i, (rows, *offsets) in enumerate(sources):
                # an offset that isn't there comes as None or as the text "null"
                self._entries.append((job, run_id, batch_id, i, rows, *[None if o in (None, "null", "None") else str(o) for o in offsets]))

    def wait(self, queries, timeout_s: float = 60.0) -> None:
        """Until the last event of each ended query is here."""
        runs = {str(q.runId) for q in queries}
        with self._change:
            if not self._change.wait_for(lambda: runs <= self._ended, timeout_s):
                raise TimeoutError(f"no end of {runs - self._ended} after {timeout_s} s")

    def table(self, spark: SparkSession) -> DataFrame:
        with self._change:
            return spark.createDataFrame(list(self._entries), SCHEMA)


def offsets_behind(progress: DataFrame) -> DataFrame:
    """(job, run_id, batch_id, source, topic, partition, end_offset, latest_offset, lag) of sources whose
    offsets are those of a topic's partitions. A partition that the batch's end doesn't name is not
    begun: its lag is all it holds."""
    shape = "map<string, map<string, bigint>>"
    p = progress.select("job", "run_id", "batch_id", "source", F.from_json("end_offset", shape).alias("ends"),
                        F.explode(F.from_json("latest_offset", shape)).alias("topic", "latest"))
    p = p.select("job", "run_id", "batch_id", "source", "topic", F.col("ends")[F.col("topic")].alias("ends"), F.explode("latest").alias("partition", "latest_offset"))
    end = F.coalesce(F.col("ends")[F.col("partition")], F.lit(0))
    return p.select("job", "run_id", "batch_id", "source", "topic", F.col("partition").cast("int"), end.alias("end_offset"), "latest_offset",
                    F.greatest(F.col("latest_offset") - end, F.lit(0)).alias("lag"))


def rows_behind(progress: DataFrame, end_rows: int) -> DataFrame:
    """(job, batch_id, input_rows, read_rows, behind_rows): `end_rows` is what the source holds. A micro-batch that was run again counts once."""
    once = (progress.groupBy("job", "batch_id", "source").agg(F.max("input_rows").alias("input_rows"))
            .groupBy("job", "batch_id").agg(F.sum("input_rows").alias("input_rows")).filter("input_rows > 0"))
    read = F.sum("input_rows").over(Window.partitionBy("job").orderBy("batch_id"))
    return once.withColumn("read_rows", read).withColumn("behind_rows", F.greatest(F.lit(end_rows) - F.col("read_rows"), F.lit(0)))
