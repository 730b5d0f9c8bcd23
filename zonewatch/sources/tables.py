"""Readers for the driver's Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Callers select only the columns they need so the
    Parquet scan's ReadSchema stays narrow."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
