"""Reference SQL for the correctness check: each query restated in plain SQL
(DuckDB dialect) over the same `events` table, computed independently of the
Spark code path. Feed definitions mirror `sources/feeds.py` expression for
expression; lookups are inlined as VALUES."""

from __future__ import annotations

from citystream.sources import lookups

EV = """ev AS (
  SELECT *, event_id AS seq,
         1704067200000 + event_id * 7000 AS timestamp_ms,
         make_timestamp((1704067200000 + event_id * 7000) * 1000) AS event_time,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

ZONE = "(['North','South','East','West','Central','Zone-A'])[user_id % 6 + 1]"

AIR_QUALITY = f"""air_quality AS (
  SELECT 'SENSOR-' || CAST(user_id % 20 + 1 AS VARCHAR) AS sensor_id,
         {ZONE} AS zone,
         value AS pm25, value * 1.5 AS pm10, CAST(k AS DOUBLE) AS no2,
         CAST(CASE WHEN event_type = 'error' AND k < 25 THEN NULL
                   WHEN k = 99 THEN -1.0
                   ELSE floor(value * 2.0) END AS DOUBLE) AS aqi,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp",
         seq, timestamp_ms, event_time
  FROM ev)"""

SIGNALS = f"""signals AS (
  SELECT 'JN-' || CAST(user_id % 10 + 1 AS VARCHAR) AS junction_id,
         {ZONE} AS zone,
         CAST(k + 5 AS INTEGER) AS vehicle_count,
         CASE WHEN k = 0 THEN NULL ELSE value * 4.0 END AS avg_wait_sec,
         (['RED','GREEN','YELLOW'])[k % 3 + 1] AS signal_phase,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp",
         seq, timestamp_ms, event_time
  FROM ev)"""

BUS_GPS = """bus_gps AS (
  SELECT 'BUS-' || CAST(user_id + 1000 AS VARCHAR) AS bus_id,
         'R' || CAST(user_id % 6 + 101 AS VARCHAR) AS route_id,
         CAST(188500 + (k % 8) * 7 AS DOUBLE) / 10000 AS lat,
         CAST(475200 + (event_id % 8) * 7 AS DOUBLE) / 10000 AS lon,
         value AS speed_kmh,
         CAST(k % 91 + 10 AS INTEGER) AS occupancy_pct,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp",
         seq, timestamp_ms, event_time
  FROM ev)"""

SMART_METERS = """smart_meters AS (
  SELECT 'meter_' || CAST(user_id + 1000 AS VARCHAR) AS meter_id,
         'ward_' || CAST(user_id % 15 + 1 AS VARCHAR) AS ward_id,
         value / 100 AS kwh_reading,
         CAST(2100 + k * 3 AS DOUBLE) / 10 AS voltage,
         CAST(800 + k * 2 AS DOUBLE) / 1000 AS power_factor,
         CAST(timestamp_ms AS VARCHAR) AS "timestamp",
         seq, timestamp_ms, event_time
  FROM ev)"""

FEED_CTES = {
    "air_quality": AIR_QUALITY,
    "signals": SIGNALS,
    "bus_gps": BUS_GPS,
    "smart_meters": SMART_METERS,
}


def with_feeds(*names: str, extra: str = "", recursive: bool = False) -> str:
    ctes = [EV] + [FEED_CTES[n] for n in names]
    if extra:
        ctes.append(extra)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


ZONE_PROFILE = ("zone_profile AS (SELECT * FROM (VALUES "
                + _values(lookups.ZONE_PROFILE_ROWS)
                + ") AS t(zone, population, number_of_schools))")

ROUTE_SCHEDULE = ("route_schedule AS (SELECT * FROM (VALUES "
                  + _values(lookups.ROUTE_SCHEDULE_ROWS)
                  + ") AS t(route_id, route_name, scheduled_arrival_time, terminal))")


def bound(ms_expr: str) -> str:
    """epoch-ms expression -> window-bound text."""
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%d %H:%M:%S')"
