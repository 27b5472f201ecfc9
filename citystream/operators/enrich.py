"""Bus GPS enrichment: left lookup join to the route schedule with defaults
for routes that have no schedule row.

Whether the schedule is broadcast is left to the planner and AQE, which know
its measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.sources.lookups import UNKNOWN_ROUTE

SCHEDULE_FIELDS = ["route_name", "scheduled_arrival_time", "terminal"]


def enrich_bus(bus: DataFrame, schedule_side: DataFrame) -> DataFrame:
    s = schedule_side.select("route_id", *[F.col(c).alias(f"_s_{c}") for c in SCHEDULE_FIELDS])
    joined = bus.join(s, on="route_id", how="left")
    return joined.select(
        *bus.columns,
        *[F.coalesce(F.col(f"_s_{c}"), F.lit(UNKNOWN_ROUTE[c])).alias(c) for c in SCHEDULE_FIELDS])
