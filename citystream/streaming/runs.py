"""Tables that a stream writes micro-batch by micro-batch and that stay quick to read.

A table is a list of runs, each a Parquet folder, named by a manifest (`streaming.manifest`).
A micro-batch adds one run of level 0 and is in the manifest under its id, so a replayed one
changes nothing. Once a level holds `fan` runs they are merged into one of the next level:
sorted, in files that AQE sizes, with one row per key if the table has keys. A row is so
rewritten once per level, and the number of runs grows with the logarithm of the number of
micro-batches; a run beyond `full_bytes` is merged no more. The runs' bounds of `order` are in
the manifest, so a reader of a range opens only the runs that reach into it.

With `keys` a table holds one row per key: the latest micro-batch's, or with `combine` (column
-> sum, min or max) what all its rows add up to. A merge of `fan` runs works on these alone."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream.streaming.manifest import KEPT_VERSIONS, Manifest

FAN = 8
FULL_BYTES = 64 << 30
RECORDS_PER_FILE = 5_000_000
_BATCH = "_batch"
_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


class RunTable:
    def __init__(self, spark: SparkSession, root: str, keys: list[str] | None = None, order: str | None = None,
                 partition_by: list[str] | None = None, combine: dict[str, str] | None = None, fan: int = FAN, full_bytes: int = FULL_BYTES):
        """`order`: a column of long type whose bounds per run are kept."""
        if combine and not keys:
            raise ValueError("combine needs keys")
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), keys or [], order
        self.partition_by, self.combine, self.fan, self.full_bytes = partition_by or [], combine or {}, fan, full_bytes
        self.manifest = Manifest(spark, f"{self.root}/_manifest")

    # ---------------------------------------------------------------- state

    def state(self) -> tuple[int, dict]:
        version, state = self.manifest.latest()
        return version, state or {"last_batch": -1, "schema": None, "runs": []}

    def runs(self) -> list[dict]:
        return self.state()[1]["runs"]

    def last_batch(self) -> int:
        return self.state()[1]["last_batch"]

    # ---------------------------------------------------------------- reading

    def _load(self, runs: list[dict], schema: str) -> DataFrame:
        fields = T.StructType.fromJson(json.loads(schema))
        if not runs:
            return self.spark.createDataFrame([], fields)
        with_run = T.StructType(fields.fields + [T.StructField("run", T.StringType())])
        return (self.spark.read.schema(with_run).option("basePath", self.root)
                .parquet(*[f"{self.root}/run={r['run']}" for r in runs]).select(*fields.fieldNames()))

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        types = {f.name: f.dataType for f in rows.schema.fields}
        values = [c for c in rows.columns if c not in (*self.keys, _BATCH)]
        if self.combine:
            aggregates = [_COMBINE[self.combine[c]](c).cast(types[c]).alias(c) for c in values]
            return rows.groupBy(*self.keys).agg(*aggregates, F.max(_BATCH).alias(_BATCH)).select(*rows.columns)
        held = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), _BATCH).alias("_v"), F.max(_BATCH).alias(_BATCH))
        return held.select(*[F.col(f"_v.{c}").alias(c) if c in values else F.col(c) for c in rows.columns])

    def read(self, between: tuple[int, int] | None = None) -> DataFrame:
        """The table as the newest manifest has it; `between` bounds `order` (both ends taken in)
        and must not part the rows of a key."""
        _, state = self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing has been written to {self.root}")
        runs = state["runs"]
        if between is not None:
            runs = [r for r in runs if r["lo"] is not None and r["lo"] <= between[1] and r["hi"] >= between[0]]
        rows = self._load(runs, state["schema"])
        if between is not None:
            rows = rows.filter(F.col(self.order).between(*between))
        return self._one_per_key(rows).drop(_BATCH)

    def since(self, batch_id: int) -> DataFrame:
        """Rows of the micro-batches after `batch_id` that are still runs of their own (level 0)."""
        _, state = self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing has been written to {self.root}")
        return self._load([r for r in state["runs"] if r["first"] > batch_id], state["schema"]).drop(_BATCH)

    def reached_before(self, batch_id: int) -> int | None:
        """The greatest `order` of all micro-batches before this one."""
        return max((r["hi"] for r in self.runs() if r["last"] < batch_id and r["hi"] is not None), default=None)

    # ---------------------------------------------------------------- writing

    def _write(self, rows: DataFrame, name: str, sorted_by: list[str]) -> dict:
        folder = f"{self.root}/run={name}"
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        else:
            rows = rows.hint("rebalance")
        if sorted_by:
            rows = rows.sortWithinPartitions(*sorted_by)
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", RECORDS_PER_FILE)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(folder)
        low, high = None, None
        if self.order:
            written = self._load([{"run": name}], rows.schema.json())
            low, high = written.agg(F.min(self.order), F.max(self.order)).first()
        path = self.manifest._jvm.org.apache.hadoop.fs.Path(folder)
        size = self.manifest.files().getContentSummary(path).getLength()
        return {"run": name, "bytes": size, "lo": low, "hi": high}

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """Adds a micro-batch; False, and nothing done, if it is there already."""
        version, state = self.state()
        if batch_id <= state["last_batch"]:
            return False
        rows = rows.withColumn(_BATCH, F.lit(batch_id).cast("long"))
        rows = self._one_per_key(rows) if self.combine else rows
        run = self._write(rows, f"b{batch_id:012d}-{uuid.uuid4().hex[:8]}", [])
        run |= {"level": 0, "first": batch_id, "last": batch_id}
        self.manifest.commit(version, {"last_batch": batch_id, "schema": rows.schema.json(), "runs": state["runs"] + [run]})
        return True

    def compact(self) -> int:
        """Merges each level that is full; the number of merges."""
        merges = 0
        while True:
            version, state = self.state()
            levels: dict[int, list[dict]] = {}
            for r in state["runs"]:
                if r["bytes"] < self.full_bytes:
                    levels.setdefault(r["level"], []).append(r)
            full = [level for level, members in sorted(levels.items()) if len(members) >= self.fan]
            if not full:
                return merges
            members = sorted(levels[full[0]], key=lambda r: r["first"])[:self.fan]
            name = f"m{members[0]['first']:012d}-{uuid.uuid4().hex[:8]}"
            rows = self._one_per_key(self._load(members, state["schema"]))
            run = self._write(rows, name, [*self.partition_by, *([self.order] if self.order else self.keys)])
            run |= {"level": full[0] + 1, "first": members[0]["first"], "last": members[-1]["last"]}
            gone = {r["run"] for r in members}
            self.manifest.commit(version, state | {"runs": [r for r in state["runs"] if r["run"] not in gone] + [run]})
            merges += 1

    def vacuum(self, keep: int = KEPT_VERSIONS) -> int:
        """Deletes run folders that none of the last `keep` versions names (merged ones, and those
        of writers that died before their commit). For the table's one writer."""
        named = {f"run={r['run']}" for state in self.manifest.forget(keep) for r in state["runs"]}
        fs, root = self.manifest.files(), self.manifest._jvm.org.apache.hadoop.fs.Path(self.root)
        if not fs.exists(root):
            return 0
        old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("run=") and s.getPath().getName() not in named]
        for path in old:
            fs.delete(path, True)
        return len(old)

    def maintain(self) -> None:
        if self.compact():
            self.vacuum()

    def writer(self):
        """foreachBatch function: the micro-batch, then merges that are due."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.append(batch, batch_id)
            self.maintain()
        return write
