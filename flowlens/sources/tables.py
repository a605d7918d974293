"""Parquet tables (the driver's test data and any warehouse path)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    path = os.path.join(base_dir, f"{name}.parquet")
    return spark.read.parquet(path)
