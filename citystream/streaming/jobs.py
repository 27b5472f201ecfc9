"""Streaming jobs, from the same transformation functions as the batch queries.

`start_*` functions start one query and return it, so several run side by side.
Each takes `base`, the job's own folder in the shared storage: `base/out` is its
sink and `base/_checkpoint` its checkpoint. Starting a job again on the same
folder resumes where it stopped. The `*_stream` functions replay a source to
its end (availableNow) and return what the sink holds as a batch DataFrame."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citystream.functions.exact import units
from citystream.operators import advisory, alerts, energy, enrich, incidents, progress, quality
from citystream.session import scratch_path
from citystream.sources import lookups
from citystream.streaming import sinks
from citystream.streaming.lag import ProgressLog, rows_behind
from citystream.streaming.manifest import Ledger
from citystream.streaming.runs import RunTable
from citystream.streaming.sources import MOST_FILES, feed_stream, topic_stream
from citystream.operators.near import TILE_M
from citystream.streaming.stateful import (BUNCHING_OUT, EVALUATED, GRIDLOCK_OUT, LANES, PAIR_BUCKETS, ROCKSDB_PROVIDER, TRACKED, BusTracker,
                                           GridlockProcessor, InOrder, PairFold, TileWatch, to_tiles, with_lane)

STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
#: What an executor's RocksDB instances share, in MB: each would have buffers and a cache of its own.
STATE_MB = 128


def _out(base: str) -> str:
    return f"{base}/out"


def _checkpoint(base: str) -> str:
    return f"{base}/_checkpoint"


@contextmanager
def _rocksdb_state(spark: SparkSession):
    """transformWithState needs the RocksDB state store, here with bounded memory (unless the session
    says how); restore the previous settings afterwards."""
    own = {STATE_PROVIDER_CONF: ROCKSDB_PROVIDER}
    if f"{_ROCKSDB}.boundedMemoryUsage" not in spark.conf.getAll:
        own |= {f"{_ROCKSDB}.boundedMemoryUsage": "true", f"{_ROCKSDB}.maxMemoryUsageMB": str(STATE_MB)}
    old = {k: spark.conf.getAll.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _replayed(spark: SparkSession, start, source: dict, name: str, base: str | None, **kw) -> tuple[str, StreamingQuery]:
    """Runs a job to its source's end; its folder and the ended query."""
    base = base or scratch_path(spark, name)
    return base, sinks.run_to_end(start(spark, source, base, **kw))


def _append(spark, df: DataFrame, base: str, name: str, trigger, partition_by=None, form: str = "parquet") -> StreamingQuery:
    return sinks.start_files(df, _out(base), _checkpoint(base), name, partition_by, trigger, form)


def _read(spark: SparkSession, base: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(_out(base))


# ------------------------------------------------------------ ward energy

LAKE_COLUMNS = ["meter_id", "ward_id", "kwh_reading", "voltage", "power_factor", "timestamp", "event_time", "date"]


def start_lake(spark: SparkSession, source: dict, base: str, trigger=None) -> StreamingQuery:
    """Raw readings into the date/ward-partitioned lake."""
    lake = energy.with_lake_columns(feed_stream(spark, "smart_meters", source)).select(*LAKE_COLUMNS)
    return _append(spark, lake, base, "meter_lake", trigger, ["date", "ward_id"])


def lake_stream(spark: SparkSession, source: dict, base: str | None = None) -> DataFrame:
    base, _ = _replayed(spark, start_lake, source, "meter_lake", base)
    return _read(spark, base)


def start_meter_console(spark: SparkSession, source: dict, base: str, trigger=None) -> StreamingQuery:
    """Readings printed as they come, for watching a feed."""
    return sinks.start_console(feed_stream(spark, "smart_meters", source), _checkpoint(base), "smart_meters", trigger)


def start_ward_energy(spark: SparkSession, source: dict, base: str, trigger=None, window: str = "15 minutes",
                      watermark: str = "2 minutes", preview: bool = False, form: str = "parquet",
                      options: dict | None = None) -> StreamingQuery:
    """Windowed ward totals, append mode: a window is written once the
    watermark (max event time - `watermark`) passes its end; rows older than
    the watermark are dropped. `form` and `options` name the sink's format (a
    Parquet, ORC or CSV folder, or a JDBC table)."""
    meters = feed_stream(spark, "smart_meters", source)
    agg = energy.ward_energy(meters.withWatermark("event_time", watermark), window)
    writer = sinks.batch_writer(_out(base), ["ward_id", "window_start"] if preview else None, form, options)
    return sinks.start_foreach_batch(agg, writer, _checkpoint(base), "ward_energy", trigger)


def ward_energy_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> DataFrame:
    base, _ = _replayed(spark, start_ward_energy, source, "ward_energy", base, **kw)
    form = kw.get("form", "parquet")
    return sinks.batches(spark, _out(base), form).drop("batch_id")


def start_all_meters(spark: SparkSession, source: dict, base: str, trigger: dict) -> list[StreamingQuery]:
    """Lake, console and totals side by side on one topic; `sinks.await_any` waits for them (queries
    that ended earlier in the session are forgotten first, or it would not wait)."""
    spark.streams.resetTerminated()
    return [start_lake(spark, source, f"{base}/lake", trigger), start_meter_console(spark, source, f"{base}/console", trigger),
            start_ward_energy(spark, source, f"{base}/energy", trigger, preview=True)]


class MeterTables:
    """What the one-pass job keeps: raw lake, pieces of the ward totals, rows that came too late
    (or without a time), and the console's ledger."""

    def __init__(self, spark: SparkSession, base: str):
        self.lake = RunTable(spark, f"{base}/lake", order="timestamp_ms", partition_by=["date", "ward_id"])
        self.pieces = RunTable(spark, f"{base}/totals", keys=energy.PIECE_KEYS, order="start_ms", combine=energy.PIECE_COMBINE)
        self.late = RunTable(spark, f"{base}/late", order="timestamp_ms")
        self.console = Ledger(spark, f"{base}/console")

    def totals(self) -> DataFrame:
        return energy.totals_of(self.pieces.read())


def start_meters_once(spark: SparkSession, source: dict, base: str, trigger=None, window: str = "15 minutes", watermark_ms: int = 120_000,
                      console: bool = True, preview_rows: int = 20) -> StreamingQuery:
    """Lake, ward totals, late rows and console from one scan and one decode.

    A micro-batch is written to the lake and read back from there by the others. Each sink has the
    batch's id in its own manifest, so after a crash between two sinks the batch goes on with the
    ones that lack it (the console may print one twice). A reading is late if its window had ended
    by the watermark, which is the greatest event time of the batches before less `watermark_ms`;
    late readings and those without a time are kept with a reason, so each reading is in one total
    or there. Merges run when all sinks have the batch."""
    size_ms = energy.window_ms(window)

    def write(batch: DataFrame, batch_id: int) -> None:
        at = MeterTables(batch.sparkSession, base)
        at.lake.append(energy.with_lake_columns(batch).select(*LAKE_COLUMNS, "timestamp_ms", "seq"), batch_id)
        rows = at.lake.since(batch_id - 1)
        seen = at.lake.reached_before(batch_id)
        start = F.col("timestamp_ms") - F.pmod("timestamp_ms", F.lit(size_ms))
        late = F.lit(False) if seen is None else start + size_ms <= seen - watermark_ms
        reason = F.when(F.col("timestamp_ms").isNull(), quality.BAD_TIME).when(late, quality.LATE)
        at.pieces.append(energy.ward_pieces(rows.filter(reason.isNull()), window), batch_id)
        at.late.append(rows.withColumn("error_reason", reason).filter("error_reason IS NOT NULL"), batch_id)
        if console:
            at.console.once(batch_id, lambda: sinks.print_batch("smart_meters", preview_rows)(rows, batch_id))
        for table in (at.lake, at.pieces, at.late):
            table.maintain()

    return sinks.start_foreach_batch(feed_stream(spark, "smart_meters", source), write, _checkpoint(base), "meters_once", trigger)


def meters_once_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> MeterTables:
    base, _ = _replayed(spark, start_meters_once, source, "meters_once", base, **kw)
    return MeterTables(spark, base)


# ------------------------------------------------------------ bounded drain

def drain_topic(spark: SparkSession, feed_name: str, source: dict, base: str | None = None) -> DataFrame:
    """Everything a topic holds from where the last drain on this folder ended (at first: from its
    beginning) to its present end, as a table of records.

    The checkpoint is the ledger of ends, and a micro-batch is kept under its id by a commit that
    only one of two drains can make: each record is in one drain's result."""
    if source.get("format") == "kafka":
        source = source | {"options": {"startingOffsets": "earliest", **source.get("options", {})}}
    base = base or scratch_path(spark, "drain")
    table = RunTable(spark, _out(base), order="offset")
    before = table.last_batch()
    records = topic_stream(spark, feed_name, source)
    sinks.run_to_end(sinks.start_foreach_batch(records, lambda batch, i: table.append(batch, i), _checkpoint(base), f"drain_{feed_name}"))
    if table.last_batch() < 0:
        return spark.createDataFrame([], records.schema)
    drained = table.since(before)
    table.compact()         # the result's runs stay readable for some versions
    return drained


# ------------------------------------------------------------ health advisories

def _minutes(spark: SparkSession, source: dict, watermark: str) -> DataFrame:
    """Per zone and slide: fixed-point sum and count. A reading is in one of these
    tumbling pieces; the sliding windows are put together from them on read."""
    air = feed_stream(spark, "air_quality", source).withWatermark("event_time", watermark)
    w = F.window("event_time", f"{advisory.SLIDE_MINUTES} minute")
    return (air.groupBy("zone", w.alias("w")).agg(F.sum(units("aqi")).alias("u"), F.count(units("aqi")).alias("n"), F.count(F.lit(1)).alias("rows"))
            .select("zone", F.unix_millis("w.start").alias("bucket_ms"), "u", "n", "rows"))


def advisory_pieces(spark: SparkSession, base: str) -> RunTable:
    """The pieces' sink: the latest row per zone and minute."""
    return RunTable(spark, _out(base), keys=["zone", "bucket_ms"], order="bucket_ms")


def start_health_advisory(spark: SparkSession, source: dict, base: str, trigger=None, watermark: str = "10 minutes") -> StreamingQuery:
    """Update mode: each micro-batch adds the pieces it changed; merges read some earlier ones."""
    return sinks.start_foreach_batch(_minutes(spark, source, watermark), advisory_pieces(spark, base).writer(), _checkpoint(base),
                                     "health_advisory", trigger, output_mode="update")


def health_advisory_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> DataFrame:
    base, _ = _replayed(spark, start_health_advisory, source, "health_advisory", base, **kw)
    return advisory.advisories_of(advisory.windows_of(advisory_pieces(spark, base).read()), lookups.zone_profile_side(spark))


def start_health_advisory_kafka(spark: SparkSession, source: dict, base: str, kafka_options: dict,
                                topic: str = "city.health_advisories", trigger=None) -> StreamingQuery:
    """Keyed JSON records in update mode. A micro-batch's changed pieces are joined with
    the pieces of the windows they touch (only the runs that reach there are opened), and
    those windows' advisories are published."""
    table = advisory_pieces(spark, base)

    def publish(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id)
        touched = [r for r in table.runs() if r["last"] >= batch_id and r["lo"] is not None]
        if not touched:
            return
        reach = (advisory.WINDOW_MINUTES - 1) * 60_000
        near = min(r["lo"] for r in touched) - reach, max(r["hi"] for r in touched) + reach
        windows = advisory.windows_of(table.read(near)).filter(F.col("window_start_ms").between(near[0], near[1] - reach))
        out = advisory.advisories_of(windows, lookups.zone_profile_side(spark))
        sinks.publish(advisory.advisory_records(out), topic, kafka_options)
        table.maintain()

    return sinks.start_foreach_batch(_minutes(spark, source, "10 minutes"), publish, _checkpoint(base), "health_advisory_kafka", trigger, "update")


# ------------------------------------------------------------ stateless streams

def start_aqi_alerts(spark: SparkSession, source: dict, base: str, trigger=None) -> StreamingQuery:
    return _append(spark, alerts.aqi_alerts(feed_stream(spark, "air_quality", source)), base, "aqi_alerts", trigger)


def aqi_alert_stream(spark: SparkSession, source: dict, base: str | None = None) -> DataFrame:
    base, _ = _replayed(spark, start_aqi_alerts, source, "aqi_alerts", base)
    return _read(spark, base)


def start_dlq(spark: SparkSession, source: dict, base: str, trigger=None) -> StreamingQuery:
    return _append(spark, quality.dead_letters(feed_stream(spark, "air_quality", source)), base, "dlq", trigger)


def dlq_stream(spark: SparkSession, source: dict, base: str | None = None) -> DataFrame:
    base, _ = _replayed(spark, start_dlq, source, "dlq", base)
    return _read(spark, base)


def start_dlq_kafka(spark: SparkSession, source: dict, base: str, kafka_options: dict, topic: str = "city.dlq", trigger=None) -> StreamingQuery:
    """Dead-letter envelopes to their topic."""
    records = quality.dead_letter_records(quality.dead_letters(feed_stream(spark, "air_quality", source)))
    return sinks.start_kafka(records, topic, _checkpoint(base), "dlq_kafka", kafka_options, trigger)


ENRICHED_COLUMNS = ["bus_id", "route_id", "lat", "lon", "speed_kmh", "occupancy_pct", "timestamp",
                    "seq", "timestamp_ms", "route_name", "scheduled_arrival_time", "terminal"]


def start_enrich(spark: SparkSession, source: dict, base: str, trigger=None) -> StreamingQuery:
    bus = feed_stream(spark, "bus_gps", source)
    return _append(spark, enrich.enrich_bus(bus, lookups.route_schedule_side(spark)).select(*ENRICHED_COLUMNS), base, "bus_enriched", trigger)


def enrich_stream(spark: SparkSession, source: dict, base: str | None = None) -> DataFrame:
    base, _ = _replayed(spark, start_enrich, source, "bus_enriched", base)
    return _read(spark, base)


def _progress_table(spark: SparkSession, base: str) -> RunTable:
    return RunTable(spark, _out(base), keys=["partition"])


def start_progress(spark: SparkSession, source: dict, base: str, trigger=None, group: str = "feed_progress") -> StreamingQuery:
    """One consumer group on the signals topic: per-partition message counts as a running
    aggregate (update mode), plus observed metrics on the raw records (visible
    in each micro-batch's progress report). `source` has the group's own admission."""
    env = topic_stream(spark, "signals", source).observe(
        "signals_progress", F.count(F.lit(1)).alias("messages"), F.max("offset").alias("last_offset"))
    counts = (env.groupBy("partition")
                 .agg(F.count(F.lit(1)).alias("messages"), F.max("offset").alias("last_offset")))
    return sinks.start_foreach_batch(counts, _progress_table(spark, base).writer(), _checkpoint(base), group, trigger, "update")


def progress_stream(spark: SparkSession, source: dict, base: str | None = None) -> DataFrame:
    """Each group is a job of its own, side by side; a report is due every n messages that it has read."""
    base = base or scratch_path(spark, "feed_progress")
    jobs = [(name, n, start_progress(spark, source, f"{base}/{name}", group=name)) for name, n in progress.GROUPS]
    parts = []
    for name, n, query in jobs:
        sinks.run_to_end(query)
        parts.append(progress.group_progress_from_counts(_progress_table(spark, f"{base}/{name}").read(), [(name, n)]))
    return reduce(DataFrame.unionByName, parts)


def lag_stream(spark: SparkSession, source: dict, base: str | None = None, admission: dict[str, int] | None = None) -> DataFrame:
    """The groups' lag after each micro-batch, from their progress events: (job, batch_id, input_rows,
    read_rows, behind_rows). `admission`: files a micro-batch, per group."""
    base, log = base or scratch_path(spark, "lag"), ProgressLog()
    spark.streams.addListener(log)
    try:
        jobs = [start_progress(spark, source | {"max_files_per_trigger": (admission or {}).get(name, source.get("max_files_per_trigger", MOST_FILES))},
                               f"{base}/{name}", group=name) for name, _ in progress.GROUPS]
        for query in jobs:
            sinks.run_to_end(query)
        log.wait(jobs)
    finally:
        spark.streams.removeListener(log)
    held = spark.read.option("pathGlobFilter", source.get("glob", "events*.parquet")).parquet(source["path"]).count()
    return rows_behind(log.table(spark), held)


# ------------------------------------------------------------ keyed-state detectors

def _keyed_state(rows: DataFrame, keys: list[str], processor, schema, event_time: bool = False) -> DataFrame:
    more = {"eventTimeColumnName": "event_time"} if event_time and "event_time" in str(schema) else {}
    return rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append",
                                                          timeMode="EventTime" if event_time else "None", **more)


def _released(rows: DataFrame, keys: list[str], reorder: str | None) -> DataFrame:
    """Rows as they come, or with `reorder` (a delay) held until the watermark has passed them, in order."""
    if reorder is None:
        return rows
    return _keyed_state(rows.withWatermark("event_time", reorder), keys, InOrder(rows.columns), rows.schema, event_time=True)


def _gridlock(spark: SparkSession, source: dict, reorder: str | None = None) -> DataFrame:
    sig = feed_stream(spark, "signals", source).select("junction_id", "zone", "avg_wait_sec", "timestamp_ms", "seq", "event_time").filter("junction_id IS NOT NULL")
    return _keyed_state(_released(sig, ["junction_id"], reorder).drop("event_time"), ["junction_id"], GridlockProcessor(), GRIDLOCK_OUT)


def _bunching(spark: SparkSession, source: dict, reorder: str | None = None, expiry_ms: int | None = None, tile_m: float = TILE_M, lanes: int = LANES,
              buckets: int = PAIR_BUCKETS, watermark: str = "10 minutes") -> DataFrame:
    """`reorder`: delay for which events are held and put in order. `expiry_ms`: silence (in event time)
    after which a bus and its episodes are forgotten; `watermark` then is how late events may be."""
    bus = with_lane(feed_stream(spark, "bus_gps", source), lanes)
    bus = _released(bus, ["route_id", "lane"], reorder)
    if expiry_ms is not None and reorder is None:
        bus = bus.withWatermark("event_time", watermark)
    tracked = _keyed_state(bus, ["route_id", "lane"], BusTracker(expiry_ms), TRACKED, event_time=expiry_ms is not None)
    seen = _keyed_state(to_tiles(tracked, tile_m=tile_m), ["route_id", "tile"], TileWatch(), EVALUATED)
    pairs = seen.withColumn("bucket", F.pmod(F.xxhash64("pair", "bus_1"), F.lit(buckets)).cast("int"))
    return _keyed_state(pairs, ["route_id", "bucket"], PairFold(), BUNCHING_OUT).withColumn("distance_m", F.round("distance", 2)).drop("distance")


def start_gridlock(spark: SparkSession, source: dict, base: str, trigger=None, reorder: str | None = None) -> StreamingQuery:
    with _rocksdb_state(spark):
        return _append(spark, _gridlock(spark, source, reorder), base, "gridlock", trigger)


def gridlock_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> DataFrame:
    base, _ = _replayed(spark, start_gridlock, source, "gridlock", base, **kw)
    return _read(spark, base, GRIDLOCK_OUT)


def start_bunching(spark: SparkSession, source: dict, base: str, trigger=None, **kw) -> StreamingQuery:
    with _rocksdb_state(spark):
        return _append(spark, _bunching(spark, source, **kw), base, "bus_bunching", trigger)


def bunching_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> DataFrame:
    base, _ = _replayed(spark, start_bunching, source, "bus_bunching", base, **kw)
    return _read(spark, base)


# ------------------------------------------------------------ unified incidents

def _incidents(spark: SparkSession, source: dict, reorder: str | None = None) -> DataFrame:
    return incidents.unified(alerts.aqi_alerts(feed_stream(spark, "air_quality", source)), _gridlock(spark, source, reorder), _bunching(spark, source, reorder))


def start_incidents(spark: SparkSession, source: dict, base: str, trigger=None, reorder: str | None = None) -> StreamingQuery:
    """The three detectors as one streaming query into one incident sink."""
    with _rocksdb_state(spark):
        return _append(spark, _incidents(spark, source, reorder), base, "incidents", trigger)


def start_incidents_kafka(spark: SparkSession, source: dict, base: str, kafka_options: dict, topic: str = "city.incidents", trigger=None) -> StreamingQuery:
    """The same as JSON values of one topic."""
    with _rocksdb_state(spark):
        return sinks.start_kafka(incidents.incident_records(_incidents(spark, source)), topic, _checkpoint(base), "incidents_kafka", kafka_options, trigger)


def incident_stream(spark: SparkSession, source: dict, base: str | None = None, **kw) -> DataFrame:
    base, _ = _replayed(spark, start_incidents, source, "incidents", base, **kw)
    return _read(spark, base)
