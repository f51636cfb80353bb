"""Parquet table scans. Column pruning and pushed filters are left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrane.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
