"""Static lookup tables (zone profile, route schedule)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream import schemas

DATA_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data")
ZONE_PROFILE_CSV = os.path.join(DATA_DIR, "zone_profile.csv")
ROUTE_SCHEDULE_CSV = os.path.join(DATA_DIR, "route_schedule.csv")

# Our own profile figures (zone, population, number_of_schools) for the feed's zone names.
ZONE_PROFILE_ROWS = [
    ("North", 121400, 9),
    ("South", 233700, 21),
    ("East", 98250, 7),
    ("West", 164900, 13),
    ("Central", 341600, 29),
]

# Our own schedule rows (route_id, route_name, scheduled_arrival_time, terminal).
ROUTE_SCHEDULE_ROWS = [
    ("R101", "Route One", "08:00:00", "Terminal One"),
    ("R102", "Route Two", "08:15:00", "Terminal Two"),
    ("R103", "Route Three", "08:30:00", "Terminal Three"),
    ("R104", "Route Four", "08:45:00", "Terminal Four"),
    ("R105", "Route Five", "09:00:00", "Terminal Five"),
]

# What an event on a route without a schedule row carries.
UNKNOWN_ROUTE = {"route_name": "UNKNOWN", "scheduled_arrival_time": "N/A", "terminal": "N/A"}


def zone_profile(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is None:
        return spark.createDataFrame(ZONE_PROFILE_ROWS, schemas.ZONE_PROFILE)
    return spark.read.csv(path, schema=schemas.ZONE_PROFILE, header=True)


def route_schedule(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One row per route_id; with duplicate keys the row nearest the end of
    the file wins, as a dictionary built in file order would keep it. Several
    files count in the order of their paths. A split of a file is read in order
    by one task, so path, the split's start and the row's place in it give the order."""
    if path is None:
        return spark.createDataFrame(ROUTE_SCHEDULE_ROWS, schemas.ROUTE_SCHEDULE)
    raw = (spark.read.csv(path, schema=schemas.ROUTE_SCHEDULE, header=True)
           .withColumn("_pos", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())))
    fields = [c for c in schemas.ROUTE_SCHEDULE.fieldNames() if c != "route_id"]
    return (raw.groupBy("route_id")
            .agg(F.max_by(F.struct(*fields), F.col("_pos")).alias("_last"))
            .select("route_id", *[F.col(f"_last.{c}").alias(c) for c in fields]))


def zone_profile_side(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The lookup as a join side. Whether it is broadcast is the planner's choice,
    by its measured size."""
    return zone_profile(spark, path)


def route_schedule_side(spark: SparkSession, path: str | None = None) -> DataFrame:
    return route_schedule(spark, path)
