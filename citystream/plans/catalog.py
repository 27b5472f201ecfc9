"""Query catalogue: every query the project answers, as a function
(spark, sf_dir) -> DataFrame, with its reference SQL where one exists.

Each function builds a lazy plan over the full input tables; nothing is
collected. Streaming queries run their stream to completion (availableNow)
into a sink under the shared checkpoint folder and return the sink as a
DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas
from citystream.functions import exact as X
from citystream.operators import advisory, alerts, bunching, energy, enrich, progress, quality
from citystream.operators import gridlock as gridlock_op
from citystream.operators import incidents as incidents_op
from citystream.plans import oracle as O
from citystream.session import scratch_path
from citystream.sources import feeds, kafka, lookups, tables
from citystream.streaming import jobs as stream_jobs

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feeds.feed(tables.events(spark, sf_dir), name)


# ---------------------------------------------------------------- ward energy

def _ward_energy_sql(window_ms: int) -> str:
    ws = f"timestamp_ms - timestamp_ms % {window_ms}"
    return O.with_feeds("smart_meters") + f"""
SELECT ward_id,
       {O.bound(ws)} AS window_start,
       {O.bound(f'{ws} + {window_ms}')} AS window_end,
       round(sum(kwh_reading), 4) AS total_kwh_consumed,
       {X.sql_rounded_mean(f"sum({X.sql_units('power_factor')})", "count(power_factor)")} AS avg_power_factor,
       round(max(voltage), 4) AS peak_voltage
FROM smart_meters
GROUP BY ward_id, {ws}"""


@register("ward_energy_15m", _ward_energy_sql(900_000))
def ward_energy_15m(spark, sf_dir):
    return energy.ward_energy(feed(spark, sf_dir, "smart_meters"), "15 minutes")


@register("ward_energy_1m", _ward_energy_sql(60_000))
def ward_energy_1m(spark, sf_dir):
    return energy.ward_energy(feed(spark, sf_dir, "smart_meters"), "1 minute")


@register("ward_energy_preview",
          f"SELECT * FROM ({_ward_energy_sql(900_000)}) ORDER BY ward_id, window_start LIMIT 20")
def ward_energy_preview(spark, sf_dir):
    return energy.preview(ward_energy_15m(spark, sf_dir), 20)


# ------------------------------------------------------------ air-quality alerts

@register("aqi_alerts", O.with_feeds("air_quality") + """
SELECT 'AQI_EMERGENCY' AS incident_type, sensor_id, zone, aqi, timestamp_ms, seq
FROM air_quality WHERE aqi > 300""")
def aqi_alerts(spark, sf_dir):
    return alerts.aqi_alerts(feed(spark, sf_dir, "air_quality"))


# ------------------------------------------------------------ validation / DLQ

_REASON_SQL = """CASE WHEN aqi IS NULL THEN 'NULL_AQI_VALUE'
            WHEN NOT (aqi BETWEEN 0 AND 500) THEN 'AQI_OUT_OF_RANGE' END"""
_CHECKED = O.with_feeds("air_quality", extra=f"""checked AS (
  SELECT *, {_REASON_SQL} AS error_reason FROM air_quality)""")


def _report_sql() -> str:
    return f"""count(*) AS total_processed,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS total_failed,
       count(*) FILTER (WHERE error_reason = 'NULL_AQI_VALUE') AS null_aqi_count,
       count(*) FILTER (WHERE error_reason = 'AQI_OUT_OF_RANGE') AS out_of_range_count,
       CASE WHEN count(*) > 0
            THEN round_even(count(*) FILTER (WHERE error_reason IS NOT NULL) / count(*) * 100.0, 1)
            ELSE 0.0 END AS failure_pct"""


@register("dlq_records", _CHECKED + """
SELECT sensor_id, zone, pm25, pm10, no2, aqi, "timestamp", seq, error_reason,
       'city.air_quality' AS source_topic, CAST(NULL AS VARCHAR) AS raw_value
FROM checked WHERE error_reason IS NOT NULL""")
def dlq_records(spark, sf_dir):
    return quality.dead_letters(feed(spark, sf_dir, "air_quality"))


_DIRTY = O.with_feeds("air_quality", extra="""spoilt AS (
  SELECT * REPLACE (CASE seq % 50 WHEN 13 THEN 'garbage' WHEN 21 THEN '99999999999999999999' WHEN 29 THEN '12:30'
                    ELSE "timestamp" END AS "timestamp"), seq % 50 = 7 AS bad FROM air_quality),
judged AS (
  SELECT *, CASE WHEN bad THEN 'MALFORMED_JSON' WHEN aqi IS NULL THEN 'NULL_AQI_VALUE'
                 WHEN aqi < 0 OR aqi > 500 THEN 'AQI_OUT_OF_RANGE'
                 WHEN seq % 50 IN (13, 21, 29) THEN 'UNPARSEABLE_TIMESTAMP' END AS error_reason
  FROM spoilt)""")


def _dirty_rows(spark, sf_dir):
    return kafka.decode(feeds.dirty(kafka.envelope(feed(spark, sf_dir, "air_quality"), "air_quality")), "air_quality")


@register("dlq_dirty", _DIRTY + """
SELECT if(bad, NULL, sensor_id) AS sensor_id, if(bad, NULL, zone) AS zone, if(bad, NULL, pm25) AS pm25,
       if(bad, NULL, pm10) AS pm10, if(bad, NULL, no2) AS no2, if(bad, NULL, aqi) AS aqi,
       if(bad, NULL, "timestamp") AS "timestamp", seq, error_reason, 'city.air_quality' AS source_topic,
       if(bad, '{bad ' || CAST(seq AS VARCHAR), NULL) AS raw_value
FROM judged WHERE error_reason IS NOT NULL""")
def dlq_dirty(spark, sf_dir):
    """Dead letters of a topic with unreadable times and malformed JSON."""
    return quality.dead_letters(_dirty_rows(spark, sf_dir))


@register("dlq_envelope", _DIRTY + """
SELECT if(bad, NULL, sensor_id) AS sensor_id, if(bad, NULL, aqi) AS aqi, if(bad, NULL, "timestamp") AS "timestamp",
       if(bad, '{bad ' || CAST(seq AS VARCHAR), NULL) AS raw_value, error_reason, 'city.air_quality' AS source_topic
FROM judged WHERE error_reason IS NOT NULL""")
def dlq_envelope(spark, sf_dir):
    """The envelope as published (without the time it was routed), read back from its JSON."""
    records = quality.dead_letter_records(quality.dead_letters(_dirty_rows(spark, sf_dir)))
    schema = "original_payload struct<sensor_id string, aqi double, timestamp string>, raw_value string, error_reason string, source_topic string"
    return records.select(F.from_json("value", schema).alias("v")).select("v.original_payload.*", "v.raw_value", "v.error_reason", "v.source_topic")


@register("zone_rolling_aqi_dirty", _DIRTY + """, w AS (
  SELECT j.zone, j.aqi, j.timestamp_ms - j.timestamp_ms % 60000 - r.range * 60000 AS ws
  FROM judged j CROSS JOIN range(10) r WHERE NOT bad AND seq % 50 NOT IN (13, 21, 29))
SELECT zone, """ + O.bound("ws") + """ AS window_start, """ + O.bound("ws + 600000") + """ AS window_end,
       CAST(round(avg(CAST(aqi AS DECIMAL(18,6))), 4) AS DOUBLE) AS rolling_avg_aqi, count(aqi) AS aqi_readings
FROM w GROUP BY zone, ws""")
def zone_rolling_aqi_dirty(spark, sf_dir):
    """Rolling averages of the same topic: records without a time are in no window.
    The reference takes plain DECIMAL averages."""
    return advisory.rolling_aqi(_dirty_rows(spark, sf_dir))


@register("valid_records", _CHECKED + """
SELECT sensor_id, zone, pm25, pm10, no2, aqi, "timestamp", seq, timestamp_ms
FROM checked WHERE error_reason IS NULL""")
def valid_records(spark, sf_dir):
    return quality.valid_records(feed(spark, sf_dir, "air_quality")).drop("event_time")


@register("dlq_by_reason", _CHECKED + """
SELECT error_reason, count(*) AS failed_count
FROM checked WHERE error_reason IS NOT NULL GROUP BY error_reason""")
def dlq_by_reason(spark, sf_dir):
    return quality.failures_by_reason(feed(spark, sf_dir, "air_quality"))


@register("dlq_summary", _CHECKED + f"SELECT {_report_sql()} FROM checked")
def dlq_summary(spark, sf_dir):
    return quality.summary(feed(spark, sf_dir, "air_quality"))


@register("dlq_5min", _CHECKED + f"""
SELECT {O.bound('timestamp_ms - timestamp_ms % 300000')} AS window_start,
       {O.bound('timestamp_ms - timestamp_ms % 300000 + 300000')} AS window_end,
       {_report_sql()}
FROM checked GROUP BY timestamp_ms - timestamp_ms % 300000""")
def dlq_5min(spark, sf_dir):
    return quality.windowed_summary(feed(spark, sf_dir, "air_quality"), "5 minutes")


@register("feed_quality", O.with_feeds("air_quality") + """
SELECT zone, count(*) AS event_count, count_if(aqi IS NULL) AS null_aqi_count,
       CASE WHEN count(*) > 0 THEN round_even(count_if(aqi IS NULL) / count(*) * 100.0, 1)
            ELSE 0.0 END AS null_aqi_pct
FROM air_quality GROUP BY ROLLUP (zone)""")
def feed_quality(spark, sf_dir):
    return quality.null_rate(feed(spark, sf_dir, "air_quality"))


# ------------------------------------------------------------ enrichment

@register("bus_enriched", O.with_feeds("bus_gps", extra=O.ROUTE_SCHEDULE) + """
SELECT b.bus_id, b.route_id, b.lat, b.lon, b.speed_kmh, b.occupancy_pct, b."timestamp",
       b.seq, b.timestamp_ms,
       coalesce(s.route_name, 'UNKNOWN') AS route_name,
       coalesce(s.scheduled_arrival_time, 'N/A') AS scheduled_arrival_time,
       coalesce(s.terminal, 'N/A') AS terminal
FROM bus_gps b LEFT JOIN route_schedule s ON b.route_id = s.route_id""")
def bus_enriched(spark, sf_dir):
    bus = feed(spark, sf_dir, "bus_gps").drop("event_time")
    return enrich.enrich_bus(bus, lookups.route_schedule_side(spark))


@register("bus_enriched_csv", O.with_feeds("bus_gps", extra=O.ROUTE_SCHEDULE) + """
SELECT b.bus_id, b.route_id, b.seq,
       coalesce(s.route_name, 'UNKNOWN') AS route_name,
       coalesce(s.scheduled_arrival_time, 'N/A') AS scheduled_arrival_time,
       coalesce(s.terminal, 'N/A') AS terminal
FROM bus_gps b LEFT JOIN route_schedule s ON b.route_id = s.route_id""")
def bus_enriched_csv(spark, sf_dir):
    """Same join with the schedule read from the bundled CSV file (size-checked
    before broadcast, last duplicate wins)."""
    bus = feed(spark, sf_dir, "bus_gps").select("bus_id", "route_id", "seq")
    return enrich.enrich_bus(bus, lookups.route_schedule_side(spark, lookups.ROUTE_SCHEDULE_CSV))


# ------------------------------------------------------------ topic plumbing

def _partition_sql(key: str, n: int = 3) -> str:
    return f"CAST(CAST(regexp_extract({key}, '([0-9]+)$', 1) AS BIGINT) % {n} AS INTEGER)"


@register("feed_progress", O.with_feeds("signals", extra=f"""per_partition AS (
  SELECT {_partition_sql('junction_id')} AS "partition", count(*) AS messages, max(seq) AS last_offset
  FROM signals GROUP BY 1)""") + """
SELECT g.consumer_group, p."partition", p.messages, p.last_offset,
       p.messages // g.report_interval AS progress_reports
FROM per_partition p
CROSS JOIN (VALUES ('HIGH_PRIORITY', 20), ('STANDARD_PRIORITY', 5)) AS g(consumer_group, report_interval)""")
def feed_progress(spark, sf_dir):
    env = kafka.envelope(feed(spark, sf_dir, "signals"), "signals")
    return progress.group_progress(env)


@register("decode_feed", O.with_feeds("air_quality") + f"""
SELECT sensor_id, zone, pm25, pm10, no2, aqi, "timestamp", seq,
       {_partition_sql('sensor_id')} AS "partition",
       timestamp_ms AS event_time_ms, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM air_quality""")
def decode_feed(spark, sf_dir):
    env = kafka.envelope(feed(spark, sf_dir, "air_quality"), "air_quality")
    dec = kafka.decode(env, "air_quality")
    return dec.select(*schemas.AIR_QUALITY.fieldNames(), "seq", "partition",
                      F.unix_millis("event_time").alias("event_time_ms"), kafka.CORRUPT)


@register("decode_meters", O.with_feeds("smart_meters") + f"""
SELECT meter_id, ward_id, kwh_reading, voltage, power_factor, "timestamp", seq,
       {_partition_sql('ward_id')} AS "partition",
       timestamp_ms AS event_time_ms
FROM smart_meters""")
def decode_meters(spark, sf_dir):
    env = kafka.envelope(feed(spark, sf_dir, "smart_meters"), "smart_meters")
    dec = kafka.decode(env, "smart_meters")
    return dec.select(*schemas.SMART_METERS.fieldNames(), "seq", "partition",
                      F.unix_millis("event_time").alias("event_time_ms"))


# ------------------------------------------------------------ rolling AQI / advisories

_AQ_U = f"sum({X.sql_units('aqi')})"
_WINDOWED_AQ = O.with_feeds("air_quality", extra="""aq_windows AS (
  SELECT a.zone, a.aqi, a.timestamp_ms - a.timestamp_ms % 60000 - r.range * 60000 AS ws
  FROM air_quality a CROSS JOIN range(10) r)""")


@register("zone_rolling_aqi", _WINDOWED_AQ + f"""
SELECT zone, {O.bound('ws')} AS window_start, {O.bound('ws + 600000')} AS window_end,
       {X.sql_rounded_mean(_AQ_U, 'count(aqi)')} AS rolling_avg_aqi,
       count(aqi) AS aqi_readings
FROM aq_windows GROUP BY zone, ws""")
def zone_rolling_aqi(spark, sf_dir):
    return advisory.rolling_aqi(feed(spark, sf_dir, "air_quality"))


_ADVISORY_SQL = (_WINDOWED_AQ.rstrip() + ",\n" + O.ZONE_PROFILE + ",\n" + f"""rolling AS (
  SELECT zone, ws, {X.sql_rounded_mean(_AQ_U, 'count(aqi)')} AS avg_aqi
  FROM aq_windows GROUP BY zone, ws
  HAVING {X.sql_mean_above(_AQ_U, 'count(aqi)', 150.0)})
""")


@register("health_advisory", _ADVISORY_SQL + f"""
SELECT r.zone, {O.bound('r.ws')} AS window_start, {O.bound('r.ws + 600000')} AS window_end,
       r.avg_aqi AS rolling_avg_aqi, z.population, z.number_of_schools, r.avg_aqi AS alert_level
FROM rolling r JOIN zone_profile z ON r.zone = z.zone""")
def health_advisory(spark, sf_dir):
    return advisory.health_advisories(feed(spark, sf_dir, "air_quality"),
                                      lookups.zone_profile_side(spark))


@register("health_advisory_csv", _ADVISORY_SQL + f"""
SELECT r.zone, {O.bound('r.ws')} AS window_start, r.avg_aqi AS rolling_avg_aqi,
       z.population, z.number_of_schools
FROM rolling r JOIN zone_profile z ON r.zone = z.zone""")
def health_advisory_csv(spark, sf_dir):
    """Advisories with the zone profile read from the bundled CSV (header,
    declared schema), broadcast behind a row-count check."""
    adv = advisory.health_advisories(feed(spark, sf_dir, "air_quality"),
                                     lookups.zone_profile_side(spark, lookups.ZONE_PROFILE_CSV))
    return adv.select("zone", "window_start", "rolling_avg_aqi", "population", "number_of_schools")


@register("encode_kafka", _ADVISORY_SQL + f"""
SELECT r.zone AS "key",
       '{{"zone":"' || r.zone || '","window_start":"' || {O.bound('r.ws')}
       || '","window_end":"' || {O.bound('r.ws + 600000')}
       || '","rolling_avg_aqi":' || CAST(r.avg_aqi AS VARCHAR)
       || ',"population":' || CAST(z.population AS VARCHAR)
       || ',"number_of_schools":' || CAST(z.number_of_schools AS VARCHAR)
       || ',"alert_level":' || CAST(r.avg_aqi AS VARCHAR) || '}}' AS "value"
FROM rolling r JOIN zone_profile z ON r.zone = z.zone""")
def encode_kafka(spark, sf_dir):
    """Advisories as Kafka records: key = zone, value = JSON text."""
    return advisory.advisory_records(health_advisory(spark, sf_dir))


# ------------------------------------------------------------ gridlock

_GRIDLOCK_CTE = """gl_flag AS (
  SELECT junction_id, zone, seq, timestamp_ms, coalesce(avg_wait_sec, 0) > 180 AS breach FROM signals),
gl_run AS (
  SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END)
              OVER (PARTITION BY junction_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS g
  FROM gl_flag),
gl_pos AS (
  SELECT *, row_number() OVER (PARTITION BY junction_id, g ORDER BY seq) AS rn
  FROM gl_run WHERE breach),
gridlock AS (
  SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, junction_id, zone, timestamp_ms, seq,
         'Average wait time > 180s for 3 consecutive cycles' AS message
  FROM gl_pos WHERE rn % 3 = 0)"""


@register("gridlock", O.with_feeds("signals", extra=_GRIDLOCK_CTE) + "SELECT * FROM gridlock")
def gridlock(spark, sf_dir):
    return gridlock_op.gridlock_alerts(feed(spark, sf_dir, "signals"))


# ------------------------------------------------------------ bus bunching

def _haversine_sql(lat1, lon1, lat2, lon2) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2.0), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2.0), 2)")
    return f"(6371000.0 * 2.0 * atan2(sqrt({a}), sqrt(greatest(0.0, 1.0 - ({a})))))"


_PAIR_CTE = f"""bb_buses AS (SELECT DISTINCT route_id, bus_id FROM bus_gps),
bb_x AS (
  SELECT e.route_id, e.bus_id, b.bus_id AS other_bus_id, e.seq, e.timestamp_ms, e.lat, e.lon
  FROM bus_gps e JOIN bb_buses b ON e.route_id = b.route_id AND e.bus_id <> b.bus_id),
bb_eval AS (
  SELECT x.*, o.lat AS olat, o.lon AS olon
  FROM bb_x x ASOF JOIN bus_gps o
    ON x.route_id = o.route_id AND x.other_bus_id = o.bus_id AND x.seq > o.seq),
bb_dist AS (
  SELECT route_id, bus_id, other_bus_id, seq, timestamp_ms,
         least(bus_id, other_bus_id) AS p1, greatest(bus_id, other_bus_id) AS p2,
         {_haversine_sql('lat', 'lon', 'olat', 'olon')} AS distance
  FROM bb_eval)"""

_BUNCHING_CTE = _PAIR_CTE + """,
bb_run AS (
  SELECT *, sum(CASE WHEN distance <= 200 THEN 0 ELSE 1 END)
              OVER (PARTITION BY route_id, p1, p2 ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run
  FROM bb_dist),
bb_near AS (
  SELECT *, row_number() OVER (PARTITION BY route_id, p1, p2, run ORDER BY seq) AS rn
  FROM bb_run WHERE distance <= 200),
bb_fold AS (
  SELECT route_id, p1, p2, run, rn, timestamp_ms AS start, false AS fire,
         bus_id, other_bus_id, seq, timestamp_ms, distance
  FROM bb_near WHERE rn = 1
  UNION ALL
  SELECT n.route_id, n.p1, n.p2, n.run, n.rn,
         CASE WHEN f.start IS NULL THEN n.timestamp_ms
              WHEN n.timestamp_ms - f.start > 300000 THEN NULL
              ELSE f.start END,
         f.start IS NOT NULL AND n.timestamp_ms - f.start > 300000,
         n.bus_id, n.other_bus_id, n.seq, n.timestamp_ms, n.distance
  FROM bb_fold f JOIN bb_near n
    ON n.route_id = f.route_id AND n.p1 = f.p1 AND n.p2 = f.p2 AND n.run = f.run AND n.rn = f.rn + 1),
bunching AS (
  SELECT 'BUS_BUNCHING' AS incident_type, route_id, bus_id AS bus_1, other_bus_id AS bus_2,
         timestamp_ms, seq, round(distance, 2) AS distance_m
  FROM bb_fold WHERE fire)"""


@register("bus_pair_distances", O.with_feeds("bus_gps", extra=_PAIR_CTE) + """
SELECT route_id, bus_id, other_bus_id, seq, timestamp_ms, round(distance, 2) AS distance_m
FROM bb_dist WHERE distance <= 200""")
def bus_pair_distances(spark, sf_dir):
    return bunching.near_pair_distances(feed(spark, sf_dir, "bus_gps"))


@register("bus_bunching", O.with_feeds("bus_gps", extra=_BUNCHING_CTE, recursive=True)
          + "SELECT * FROM bunching")
def bus_bunching(spark, sf_dir):
    return bunching.bunching_alerts(feed(spark, sf_dir, "bus_gps"))


# ------------------------------------------------------------ unified incidents

_AQI_CTE = """aqi_incidents AS (
  SELECT 'AQI_EMERGENCY' AS incident_type, sensor_id, zone, aqi, timestamp_ms, seq
  FROM air_quality WHERE aqi > 300)"""


@register("incidents", O.with_feeds("air_quality", "signals", "bus_gps",
                                    extra=",\n".join([_AQI_CTE, _GRIDLOCK_CTE, _BUNCHING_CTE]),
                                    recursive=True) + """
SELECT incident_type, sensor_id, zone, aqi, NULL::VARCHAR AS junction_id, NULL::VARCHAR AS message,
       NULL::VARCHAR AS route_id, NULL::VARCHAR AS bus_1, NULL::VARCHAR AS bus_2,
       NULL::DOUBLE AS distance_m, timestamp_ms, seq FROM aqi_incidents
UNION ALL
SELECT incident_type, NULL, zone, NULL, junction_id, message, NULL, NULL, NULL, NULL,
       timestamp_ms, seq FROM gridlock
UNION ALL
SELECT incident_type, NULL, NULL, NULL, NULL, NULL, route_id, bus_1, bus_2, distance_m,
       timestamp_ms, seq FROM bunching""")
def incidents(spark, sf_dir):
    ev = tables.events(spark, sf_dir)
    return incidents_op.unified(
        alerts.aqi_alerts(feeds.air_quality(ev)),
        gridlock_op.gridlock_alerts(feeds.signals(ev)),
        bunching.bunching_alerts(feeds.bus_gps(ev)))


@register("incidents_json", ORACLE["incidents"])
def incidents_json(spark, sf_dir):
    """The incident topic's JSON values, read back (keyed by nothing; absent fields are NULL)."""
    u = incidents(spark, sf_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in u.schema.fields)
    return incidents_op.incident_records(u).select(F.from_json("value", schema).alias("v")).select("v.*")


# ------------------------------------------------------------ lake

_LAKES: dict[tuple[str, str], str] = {}


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake of a source, written once by each application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        path = scratch_path(spark, "smart_meters_lake")
        energy.write_lake(feed(spark, sf_dir, "smart_meters"), path)
        _LAKES[key] = path
    return _LAKES[key]


@register("ward_energy_lake", _ward_energy_sql(900_000))
def ward_energy_lake(spark, sf_dir):
    """Readings landed in the date/ward-partitioned Parquet lake, then the
    15-minute totals computed from the lake."""
    return energy.ward_energy(energy.read_lake(spark, _lake(spark, sf_dir)), "15 minutes")


@register("ward_energy_lake_day", _ward_energy_sql(900_000).replace(
    "FROM smart_meters\n", "FROM smart_meters WHERE CAST(event_time AS DATE) = DATE '2024-01-01'"
    " AND ward_id IN ('ward_1', 'ward_2')\n"))
def ward_energy_lake_day(spark, sf_dir):
    """Partition pruning: one day and two wards read from the lake (only
    matching date=/ward_id= directories are listed and scanned)."""
    lake = energy.read_lake(spark, _lake(spark, sf_dir)).filter(
        (F.col("date") == F.lit("2024-01-01").cast("date")) & F.col("ward_id").isin("ward_1", "ward_2"))
    return energy.ward_energy(lake, "15 minutes")


# ------------------------------------------------------------ streams
# Each replays the `events` table as the feed's topic, runs to the end
# (availableNow) and returns the sink's content.

def _replay(sf_dir: str) -> dict:
    return {"path": sf_dir, "glob": "events.parquet"}


_CLOSED_15M = _ward_energy_sql(900_000).replace(
    "GROUP BY ward_id, timestamp_ms - timestamp_ms % 900000",
    "GROUP BY ward_id, timestamp_ms - timestamp_ms % 900000\n"
    "HAVING timestamp_ms - timestamp_ms % 900000 + 900000 <= "
    "(SELECT max(timestamp_ms) FROM smart_meters) - 120000")


@register("stream_ward_energy", _CLOSED_15M)
def stream_ward_energy(spark, sf_dir):
    return stream_jobs.ward_energy_stream(spark, _replay(sf_dir))


@register("stream_lake", O.with_feeds("smart_meters") + """
SELECT meter_id, ward_id, kwh_reading, voltage, power_factor, "timestamp", CAST(event_time AS DATE) AS "date" FROM smart_meters""")
def stream_lake(spark, sf_dir):
    """Readings landed in the partitioned lake by a stream, read back."""
    return stream_jobs.lake_stream(spark, _replay(sf_dir)).drop("event_time")


@register("stream_dlq_dirty", ORACLE["dlq_dirty"])
def stream_dlq_dirty(spark, sf_dir):
    return stream_jobs.dlq_stream(spark, _replay(sf_dir) | {"dirty": True})


@register("stream_health_advisory", ORACLE["health_advisory"])
def stream_health_advisory(spark, sf_dir):
    return stream_jobs.health_advisory_stream(spark, _replay(sf_dir))


@register("stream_aqi_alerts", ORACLE["aqi_alerts"])
def stream_aqi_alerts(spark, sf_dir):
    return stream_jobs.aqi_alert_stream(spark, _replay(sf_dir))


@register("stream_dlq", ORACLE["dlq_records"])
def stream_dlq(spark, sf_dir):
    return stream_jobs.dlq_stream(spark, _replay(sf_dir))


@register("stream_enrich", ORACLE["bus_enriched"])
def stream_enrich(spark, sf_dir):
    return stream_jobs.enrich_stream(spark, _replay(sf_dir))


@register("stream_gridlock", ORACLE["gridlock"])
def stream_gridlock(spark, sf_dir):
    return stream_jobs.gridlock_stream(spark, _replay(sf_dir))


@register("stream_bus_bunching", ORACLE["bus_bunching"])
def stream_bus_bunching(spark, sf_dir):
    return stream_jobs.bunching_stream(spark, _replay(sf_dir))


@register("stream_feed_progress", ORACLE["feed_progress"])
def stream_feed_progress(spark, sf_dir):
    return stream_jobs.progress_stream(spark, _replay(sf_dir))


@register("stream_incidents", ORACLE["incidents"])
def stream_incidents(spark, sf_dir):
    return stream_jobs.incident_stream(spark, _replay(sf_dir))


@register("stream_meters_once_totals", _ward_energy_sql(900_000))
def stream_meters_once_totals(spark, sf_dir):
    """Ward totals of the job that feeds lake, totals, late rows and console from one scan."""
    return stream_jobs.meters_once_stream(spark, _replay(sf_dir), console=False).totals()


@register("stream_meters_once_lake", ORACLE["stream_lake"])
def stream_meters_once_lake(spark, sf_dir):
    """The same job's lake, through its manifest."""
    return stream_jobs.meters_once_stream(spark, _replay(sf_dir), console=False).lake.read().drop("event_time", "timestamp_ms", "seq")


@register("drain_quality", ORACLE["dlq_summary"])
def drain_quality(spark, sf_dir):
    """Quality report over what a bounded drain of the topic has read."""
    records = stream_jobs.drain_topic(spark, "air_quality", _replay(sf_dir))
    return quality.summary(kafka.decode(records, "air_quality"))


@register("stream_lag", """SELECT g.job, count(*) AS input_rows, count(*) AS read_rows, 0 AS behind_rows
FROM events CROSS JOIN (VALUES ('HIGH_PRIORITY'), ('STANDARD_PRIORITY')) AS g(job) GROUP BY g.job""")
def stream_lag(spark, sf_dir):
    """Lag of the two groups' jobs, whose replay is one micro-batch, after it."""
    return stream_jobs.lag_stream(spark, _replay(sf_dir)).drop("batch_id")
