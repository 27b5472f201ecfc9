"""Air-quality validation: an ordered rule list gives each record its first
failing reason; the feed splits into a dead-letter branch and a valid branch
(two filters over one plan), and the reports are plain aggregates.

The reports aggregate partially on every task (a handful of counters per
task), so they stay one small shuffle whatever the input size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.time import bound_string
from citystream.sources.kafka import CORRUPT

# Validation reasons and the valid AQI range (inclusive).
NULL_AQI = "NULL_AQI_VALUE"
OUT_OF_RANGE = "AQI_OUT_OF_RANGE"
# Our own reasons for records that could not be read.
MALFORMED = "MALFORMED_JSON"
BAD_TIME = "UNPARSEABLE_TIMESTAMP"
# ... and for those whose window was closed when they came.
LATE = "LATE"
AQI_MIN, AQI_MAX = 0.0, 500.0
SOURCE_TOPIC = "city.air_quality"

PAYLOAD_FIELDS = ["sensor_id", "zone", "pm25", "pm10", "no2", "aqi", "timestamp"]


def default_rules(columns: list[str]) -> list[tuple[Column, str]]:
    """(failing predicate, reason) in priority order, as far as the columns are there."""
    aqi = F.col("aqi")
    rules = [(aqi.isNull(), NULL_AQI), (~aqi.between(AQI_MIN, AQI_MAX), OUT_OF_RANGE)]
    if CORRUPT in columns:
        rules.insert(0, (F.col(CORRUPT).isNotNull(), MALFORMED))
    if "event_time" in columns:
        rules.append((F.col("event_time").isNull(), BAD_TIME))
    return rules


def with_reason(df: DataFrame, rules: list[tuple[Column, str]] | None = None) -> DataFrame:
    rules = rules or default_rules(df.columns)
    reason = F.lit(None).cast("string")
    for pred, name in reversed(rules):
        reason = F.when(pred, F.lit(name)).otherwise(reason)
    return df.withColumn("error_reason", reason)


def dead_letters(df: DataFrame, rules=None, source_topic: str = SOURCE_TOPIC) -> DataFrame:
    """Failing records: the original payload fields, reason, source topic, and the
    raw text of a value that is no JSON."""
    raw = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    return (with_reason(df, rules)
            .filter(F.col("error_reason").isNotNull())
            .select(*PAYLOAD_FIELDS, "seq", "error_reason",
                    F.lit(source_topic).alias("source_topic"), raw.alias("raw_value")))


def dead_letter_envelope(dlq: DataFrame) -> DataFrame:
    """Dead-letter record as published: payload object nested inside (the raw text
    where it is no JSON), plus the time it was routed."""
    return dlq.select(
        F.struct(*PAYLOAD_FIELDS).alias("original_payload"), "raw_value",
        "error_reason", "source_topic",
        F.current_timestamp().alias("failed_at"))


def dead_letter_records(dlq: DataFrame) -> DataFrame:
    """Kafka form of the envelope: key = sensor, value = JSON."""
    envelope = dead_letter_envelope(dlq)
    return envelope.select(F.col("original_payload.sensor_id").alias("key"), F.to_json(F.struct(*envelope.columns)).alias("value"))


def valid_records(df: DataFrame, rules=None) -> DataFrame:
    return with_reason(df, rules).filter(F.col("error_reason").isNull()).drop("error_reason")


def failures_by_reason(df: DataFrame, rules=None) -> DataFrame:
    return (with_reason(df, rules).filter(F.col("error_reason").isNotNull())
            .groupBy("error_reason").agg(F.count(F.lit(1)).alias("failed_count")))


def _pct(part: Column, whole: Column) -> Column:
    # percentage to one decimal, half to even; 0 when nothing was processed
    return F.when(whole > 0, F.bround(part / whole * 100.0, 1)).otherwise(F.lit(0.0))


def _report_aggs() -> list[Column]:
    failed = F.col("error_reason").isNotNull()
    return [F.count(F.lit(1)).alias("total_processed"),
            F.count_if(failed).alias("total_failed"),
            F.count_if(F.col("error_reason") == NULL_AQI).alias("null_aqi_count"),
            F.count_if(F.col("error_reason") == OUT_OF_RANGE).alias("out_of_range_count")]


def summary(df: DataFrame, rules=None) -> DataFrame:
    """One-row run report (zero rows in -> totals 0 and percentage 0)."""
    return (with_reason(df, rules).agg(*_report_aggs())
            .withColumn("failure_pct", _pct(F.col("total_failed"), F.col("total_processed"))))


def windowed_summary(df: DataFrame, window: str = "5 minutes", rules=None) -> DataFrame:
    w = F.window("event_time", window)
    return (with_reason(df, rules).groupBy(w.alias("w")).agg(*_report_aggs())
            .select(bound_string("w.start").alias("window_start"),
                    bound_string("w.end").alias("window_end"),
                    "total_processed", "total_failed", "null_aqi_count", "out_of_range_count",
                    _pct(F.col("total_failed"), F.col("total_processed")).alias("failure_pct")))


def null_rate(df: DataFrame) -> DataFrame:
    """Events and null-AQI rate per zone, plus an all-zones row (zone NULL)."""
    return (df.rollup("zone")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.count_if(F.col("aqi").isNull()).alias("null_aqi_count"))
            .withColumn("null_aqi_pct", _pct(F.col("null_aqi_count"), F.col("event_count"))))
