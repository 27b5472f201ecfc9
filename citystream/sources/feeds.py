"""The four city feeds, derived row by row from the `events` table.

Each feed is a pure projection of `events` (no shuffle), so a feed of an N-row
table is N rows and inherits the table's partitioning. Every numeric field is
built with integer arithmetic and one final division so that any engine
computes bit-identical doubles.

Common columns: `seq` (arrival order, = event_id), `timestamp_ms` (epoch ms)
and `event_time` (TIMESTAMP). `timestamp` is the wire text the producer would
send: epoch-ms digits for smart meters, ISO-8601 for the other feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.time import iso_string

# Feed clock origin (2024-01-01T00:00:00Z) and spacing per event.
ORIGIN_MS = 1704067200000
STEP_MS = 7000

# Zone names by user_id % 6; the last has no profile row.
ZONES = ["North", "South", "East", "West", "Central", "Zone-A"]
# Signal phases by k % 3.
PHASES = ["RED", "GREEN", "YELLOW"]


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(names: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx + 1).cast("int"))


def _clock(ev: DataFrame) -> DataFrame:
    return ev.select(
        "*",
        F.col("event_id").alias("seq"),
        (F.lit(ORIGIN_MS) + F.col("event_id") * STEP_MS).alias("timestamp_ms"),
        _k().alias("k"),
    ).withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def _zone() -> Column:
    return _pick(ZONES, F.col("user_id") % 6)


def air_quality(ev: DataFrame) -> DataFrame:
    e = _clock(ev)
    aqi = (F.when((F.col("event_type") == "error") & (F.col("k") < 25), F.lit(None).cast("double"))
            .when(F.col("k") == 99, F.lit(-1.0))
            .otherwise(F.floor(F.col("value") * 2.0).cast("double")))
    return e.select(
        F.concat(F.lit("SENSOR-"), (F.col("user_id") % 20 + 1).cast("string")).alias("sensor_id"),
        _zone().alias("zone"),
        F.col("value").alias("pm25"),
        (F.col("value") * 1.5).alias("pm10"),
        F.col("k").cast("double").alias("no2"),
        aqi.alias("aqi"),
        iso_string("event_time").alias("timestamp"),
        "seq", "timestamp_ms", "event_time",
    )


def signals(ev: DataFrame) -> DataFrame:
    e = _clock(ev)
    return e.select(
        F.concat(F.lit("JN-"), (F.col("user_id") % 10 + 1).cast("string")).alias("junction_id"),
        _zone().alias("zone"),
        (F.col("k") + 5).cast("int").alias("vehicle_count"),
        F.when(F.col("k") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") * 4.0).alias("avg_wait_sec"),
        _pick(PHASES, F.col("k") % 3).alias("signal_phase"),
        iso_string("event_time").alias("timestamp"),
        "seq", "timestamp_ms", "event_time",
    )


def bus_gps(ev: DataFrame) -> DataFrame:
    e = _clock(ev)
    return e.select(
        F.concat(F.lit("BUS-"), (F.col("user_id") + 1000).cast("string")).alias("bus_id"),
        F.concat(F.lit("R"), (F.col("user_id") % 6 + 101).cast("string")).alias("route_id"),
        ((F.lit(188500) + (F.col("k") % 8) * 7).cast("double") / 10000).alias("lat"),
        ((F.lit(475200) + (F.col("event_id") % 8) * 7).cast("double") / 10000).alias("lon"),
        F.col("value").alias("speed_kmh"),
        (F.col("k") % 91 + 10).cast("int").alias("occupancy_pct"),
        iso_string("event_time").alias("timestamp"),
        "seq", "timestamp_ms", "event_time",
    )


def smart_meters(ev: DataFrame) -> DataFrame:
    e = _clock(ev)
    return e.select(
        F.concat(F.lit("meter_"), (F.col("user_id") + 1000).cast("string")).alias("meter_id"),
        F.concat(F.lit("ward_"), (F.col("user_id") % 15 + 1).cast("string")).alias("ward_id"),
        (F.col("value") / 100).alias("kwh_reading"),
        ((F.lit(2100) + F.col("k") * 3).cast("double") / 10).alias("voltage"),
        ((F.lit(800) + F.col("k") * 2).cast("double") / 1000).alias("power_factor"),
        F.col("timestamp_ms").cast("string").alias("timestamp"),
        "seq", "timestamp_ms", "event_time",
    )


def dirty(envelope: DataFrame) -> DataFrame:
    """Air-quality records as a real topic has them: of every 50, one is no JSON and
    three have a time that can't be read."""
    value, at = F.col("value").cast("string"), F.col("offset") % 50
    spoilt = F.when(at == 7, F.concat(F.lit("{bad "), F.col("offset")))
    for place, text in BAD_TIMES.items():
        spoilt = spoilt.when(at == place, F.regexp_replace(value, '"timestamp":"[^"]*"', f'"timestamp":"{text}"'))
    return envelope.withColumn("value", spoilt.otherwise(value).cast("binary"))


#: Places among 50 records, and the time text each has.
BAD_TIMES = {13: "garbage", 21: "99999999999999999999", 29: "12:30"}

FEED_BUILDERS = {
    "air_quality": air_quality,
    "signals": signals,
    "bus_gps": bus_gps,
    "smart_meters": smart_meters,
}


def feed(ev: DataFrame, name: str) -> DataFrame:
    return FEED_BUILDERS[name](ev)
