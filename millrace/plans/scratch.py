"""Scratch folders and source-file writers for ingest queries and tests.

Ingest queries exercise the real file path: they write Bronze-shaped data
derived from the test tables as CSV / Parquet / Excel files into a fresh
folder below the cluster's shared checkpoint folder, run the ingest, and
read the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.session import shared_dir

# How source CSVs are written (values keep their padding).
SOURCE_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"',
                      "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unique folder for one query / test run."""
    return f"{shared_dir(spark)}/millrace-scratch/{label}-{uuid.uuid4().hex[:12]}"


def write_csv(df: DataFrame, folder: str, sep: str = ",", mode: str = "overwrite",
              key: str | None = None) -> str:
    """Write ``df`` as CSV part files (spread over several files by ``key``)."""
    out = df.repartition(key) if key else df
    out.write.mode(mode).options(**SOURCE_CSV_OPTIONS).option("sep", sep).csv(folder)
    return folder
