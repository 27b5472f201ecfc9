"""Zone rolling AQI (sliding windows) and health advisories.

Sliding windows are computed from slide-sized tumbling partials: rows are
aggregated once per (zone, slide bucket) -- a partial + final hash aggregate
that ships a few counters per task -- and each bucket's (sum, count) is then
fanned out to the W/S windows that contain it and re-aggregated. Raw rows are
never replicated W/S times as the direct `window(ts, W, S)` plan (Expand)
does; the fan-out happens on the bucket table, which is zones x minutes.

Means are exact (fixed-point sums, see `functions.exact`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.functions.exact import mean_above, rounded_mean, units
from citystream.functions.time import bound_string

# Rolling window, slide and the unhealthy-average threshold.
WINDOW_MINUTES = 10
SLIDE_MINUTES = 1
UNHEALTHY_AQI = 150.0


def rolling_partials(air: DataFrame, window_minutes: int = WINDOW_MINUTES,
                     slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    """(zone, window_start_ms, window_end_ms, aqi_units, aqi_readings, rows)."""
    if window_minutes % slide_minutes:
        raise ValueError("window length must be a multiple of the slide")
    slide_ms = slide_minutes * 60_000
    ts_ms = F.unix_millis("event_time")
    buckets = (air.filter(F.col("event_time").isNotNull()).groupBy("zone", (ts_ms - F.pmod(ts_ms, F.lit(slide_ms))).alias("bucket_ms"))
               .agg(F.sum(units("aqi")).alias("u"),
                    F.count(units("aqi")).alias("n"),
                    F.count(F.lit(1)).alias("rows")))
    return windows_of(buckets, window_minutes, slide_minutes)


def windows_of(buckets: DataFrame, window_minutes: int = WINDOW_MINUTES, slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    """Sliding windows put together from slide-sized pieces (zone, bucket_ms, u, n, rows)."""
    slide_ms, n_windows = slide_minutes * 60_000, window_minutes // slide_minutes
    starts = F.transform(F.sequence(F.lit(0), F.lit(n_windows - 1)),
                         lambda k: F.col("bucket_ms") - k.cast("bigint") * slide_ms)
    fanned = buckets.select("zone", "u", "n", "rows", F.explode(starts).alias("window_start_ms"))
    return (fanned.groupBy("zone", "window_start_ms")
            .agg(F.sum("u").alias("aqi_units"), F.sum("n").alias("aqi_readings"),
                 F.sum("rows").alias("rows"))
            .withColumn("window_end_ms", F.col("window_start_ms") + window_minutes * 60_000))


def rolling_aqi(air: DataFrame, window_minutes: int = WINDOW_MINUTES,
                slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    p = rolling_partials(air, window_minutes, slide_minutes)
    return p.select(
        "zone",
        bound_string(F.timestamp_millis("window_start_ms")).alias("window_start"),
        bound_string(F.timestamp_millis("window_end_ms")).alias("window_end"),
        rounded_mean("aqi_units", "aqi_readings").alias("rolling_avg_aqi"),
        "aqi_readings")


def health_advisories(air: DataFrame, zone_side: DataFrame, threshold: float = UNHEALTHY_AQI,
                      window_minutes: int = WINDOW_MINUTES,
                      slide_minutes: int = SLIDE_MINUTES) -> DataFrame:
    """Windows whose average AQI exceeds `threshold`, for zones that have a
    profile row (inner join), with the zone's population and schools."""
    return advisories_of(rolling_partials(air, window_minutes, slide_minutes), zone_side, threshold)


def advisories_of(windows: DataFrame, zone_side: DataFrame, threshold: float = UNHEALTHY_AQI) -> DataFrame:
    p = windows.filter(mean_above("aqi_units", "aqi_readings", threshold))
    avg = rounded_mean("aqi_units", "aqi_readings")
    return (p.join(zone_side, "zone", "inner")
             .select("zone",
                     bound_string(F.timestamp_millis("window_start_ms")).alias("window_start"),
                     bound_string(F.timestamp_millis("window_end_ms")).alias("window_end"),
                     avg.alias("rolling_avg_aqi"),
                     "population", "number_of_schools",
                     avg.alias("alert_level")))


ADVISORY_FIELDS = ["zone", "window_start", "window_end", "rolling_avg_aqi",
                   "population", "number_of_schools", "alert_level"]


def advisory_records(adv: DataFrame) -> DataFrame:
    """Kafka form: key = zone, value = the advisory as a JSON object."""
    return adv.select(F.col("zone").alias("key"),
                      F.to_json(F.struct(*ADVISORY_FIELDS)).alias("value"))
