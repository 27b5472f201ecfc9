"""Reading the input tables. Only columns a query uses reach the scan: every
feed is a projection, so Catalyst prunes the Parquet ReadSchema for us."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citystream.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
