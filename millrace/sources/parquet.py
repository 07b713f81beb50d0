"""Parquet scans (SRC-7).

Plain ``spark.read.parquet``: Catalyst prunes columns into the scan's
ReadSchema and pushes filters into the row-group reader, so callers only
``select`` / ``filter`` what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``<folder>/<name>.parquet`` (file or directory)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Read one or more Parquet files / folders as one DataFrame."""
    return spark.read.parquet(*paths)
