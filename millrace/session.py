"""Spark session settings the pipeline relies on.

Everything semantic (UTC, timestamp-without-zone, ANSI casts) is set here so
that results do not depend on the machine's locale.  Sizing knobs are left to
the cluster; the local defaults only matter for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session the library touches: the first block
# changes results (zone, timestamp type, ANSI), the rest is execution.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Silver projections are wide (40+ lenient casts).  A generated method
    # over 8000 bytes of bytecode is never JIT-compiled by HotSpot; past that
    # size Spark falls back to split (compilable) projection code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "millrace",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the semantic settings applied.

    On a cluster ``master`` stays None and the launcher decides; locally it
    defaults to ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[*]")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session.  Those that a
    session can't change (static ones) are left as they are."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Scratch tables, checkpoints and test folders live below it.  Only when the
    session has none (local tests) is a private one created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    if configured and not active:        # DataFrame.checkpoint() uses the cluster's folder
        spark.sparkContext.setCheckpointDir(configured)
    configured = configured or active
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    local = tempfile.mkdtemp(prefix="millrace-ckpt-")
    spark.sparkContext.setCheckpointDir(local)      # the next call finds it there
    return local
