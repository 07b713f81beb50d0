"""Run ledger: run log, file history, audit log, watermark (LED-1..8).

The reference keeps four keyed tables and updates them in place.  Parquet
has no in-place update, so every state change is an appended record and the
keyed view is "latest record per key" — an aggregate (struct max), never a
driver-side loop.  Appends are idempotent per run (same run id, same keys),
and the views make re-appended records harmless.  At a run's end the tables'
files are folded once they are many; no record is dropped.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.latest import latest_by
from millrace.store import TableStore

# Ledger schemas (column, type) and their keys.
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("pipeline_name", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()), T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()), T.StructField("files_found", T.LongType()),
    T.StructField("files_loaded", T.LongType()), T.StructField("rows_loaded", T.LongType()),
    T.StructField("error_message", T.StringType()), T.StructField("recorded_at", T.TimestampNTZType()),
])
FILE_HISTORY = T.StructType([
    T.StructField("pipeline_name", T.StringType()), T.StructField("source_file", T.StringType()),
    T.StructField("file_hash", T.StringType()), T.StructField("file_size_bytes", T.LongType()),
    T.StructField("file_modified_at", T.TimestampNTZType()), T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()), T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("error_message", T.StringType()),
])
AUDIT_LOG = T.StructType([
    T.StructField("audit_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()), T.StructField("stage", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()), T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()), T.StructField("message", T.StringType()),
])
WATERMARK = T.StructType([
    T.StructField("pipeline_name", T.StringType()), T.StructField("watermark_value", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()), T.StructField("run_id", T.StringType()),
])
TABLES = {
    "metadata.elt_run_log": (RUN_LOG, ["run_id"], ["recorded_at", "status"]),
    "metadata.file_history": (FILE_HISTORY, ["pipeline_name", "source_file", "file_hash"],
                              ["loaded_at", "run_id"]),
    "metadata.audit_log": (AUDIT_LOG, ["audit_id"], ["event_time"]),
    "metadata.watermark": (WATERMARK, ["pipeline_name"], ["updated_at", "run_id"]),
}
# Audit stages of a pipeline run.
STAGES = ["DISCOVERY", "BRONZE", "DBT_BUILD", "EXPORT", "PIPELINE"]


def now() -> _dt.datetime:
    """Naive UTC wall clock used for every ledger and lineage timestamp."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class Ledger:
    def __init__(self, spark: SparkSession, store: TableStore):
        self.spark = spark
        self.store = store
        self._audits: list[tuple] = []       # of this run, written together at its end

    # LED-1
    def initialize(self) -> None:
        """Create the four ledger tables (empty, typed) if absent; idempotent."""
        for table, (schema, _, _) in TABLES.items():
            if not self.store.exists(table):
                self.store.append(table, self.spark.createDataFrame([], schema))

    def _append(self, table: str, rows: Sequence[tuple]) -> None:
        schema = TABLES[table][0]
        self.store.append(table, self.spark.createDataFrame(list(rows), schema).coalesce(1))

    def append_frame(self, table: str, df: DataFrame) -> None:
        schema = TABLES[table][0]
        self.store.append(table, df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))

    def raw(self, table: str) -> DataFrame:
        """The table's records, each once (a fold or a repeated append may have
        left a record in several files)."""
        if table == "metadata.audit_log":
            self.flush()
        return self.store.read(table).distinct()

    def fold(self, keep: int = 32) -> None:
        """Keep the number of ledger files bounded, whatever the number of runs."""
        for table in TABLES:
            self.store.fold(table, keep)

    def latest(self, table: str) -> DataFrame:
        """Keyed view: the latest record per key (LED-4 upsert semantics)."""
        schema, keys, order = TABLES[table]
        if table == "metadata.audit_log":
            self.flush()
        return latest_by(self.store.read(table), keys, [*order, *[f.name for f in schema.fields]],
                         [f.name for f in schema.fields])

    # LED-6
    def run_started(self, run_id: str, pipeline: str, at: _dt.datetime) -> None:
        self._append("metadata.elt_run_log",
                     [(run_id, pipeline, at, None, "RUNNING", 0, 0, 0, None, at)])

    def run_finished(self, run_id: str, pipeline: str, started: _dt.datetime, status: str,
                     found: int, loaded: int, rows: int, error: str | None = None) -> None:
        end = now()
        self.flush()
        self._append("metadata.elt_run_log",
                     [(run_id, pipeline, started, end, status, found, loaded, rows, error, end)])

    # LED-7
    def audit(self, run_id: str, pipeline: str, stage: str, status: str, rows: int = 0,
              message: str | None = None) -> None:
        self._audits.append((str(uuid.uuid4()), run_id, pipeline, stage, now(), status, rows, message))

    def flush(self) -> None:
        """Write the audit records held so far (at a run's end, or before a read)."""
        held, self._audits = self._audits, []
        if held:
            self._append("metadata.audit_log", held)

    # LED-4
    def record_files(self, loaded: DataFrame) -> None:
        """Append file-history records; ``loaded`` carries the FILE_HISTORY
        columns (a distributed frame: one row per loaded file)."""
        self.append_frame("metadata.file_history", loaded)

    # LED-5
    def set_watermark(self, pipeline: str, run_id: str, files: DataFrame | None) -> None:
        """Watermark = newest modification time among the run's discovered
        files, else now; upserted per pipeline."""
        stamp = now()
        if files is not None:
            wm = files.agg(F.max("file_modified_at").alias("w")).select(
                F.coalesce("w", F.lit(stamp).cast("timestamp_ntz")).alias("watermark_value"))
        else:
            wm = self.spark.range(1).select(F.lit(stamp).cast("timestamp_ntz").alias("watermark_value"))
        self.append_frame("metadata.watermark", wm.select(
            F.lit(pipeline).alias("pipeline_name"), "watermark_value",
            F.lit(stamp).cast("timestamp_ntz").alias("updated_at"), F.lit(run_id).alias("run_id")))

    # LED-2 / LED-3 as joins
    def successful_files(self, pipeline: str | None = None) -> DataFrame:
        h = self.latest("metadata.file_history").where(F.col("status") == "SUCCESS")
        return h.where(F.col("pipeline_name") == pipeline) if pipeline else h


def unchanged_files(files: DataFrame, history: DataFrame, pipeline: str) -> DataFrame:
    """LED-3: discovered files whose (path, size, mtime) match a successful
    load of this pipeline (``left_semi``)."""
    h = history.where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    cond = ["source_file", "file_size_bytes", "file_modified_at"]
    return files.withColumnRenamed("path", "source_file").join(
        h.select(*cond).distinct(), cond, "left_semi").withColumnRenamed("source_file", "path")


def new_or_changed_files(files: DataFrame, history: DataFrame, pipeline: str) -> DataFrame:
    """LED-3 complement (``left_anti``): files that must be loaded."""
    h = history.where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    cond = ["source_file", "file_size_bytes", "file_modified_at"]
    return files.withColumnRenamed("path", "source_file").join(
        h.select(*cond), cond, "left_anti").withColumnRenamed("source_file", "path")


def loaded_by_hash(profiled: DataFrame, history: DataFrame, pipeline: str) -> DataFrame:
    """LED-2: profiled files whose (pipeline, path, hash) has a SUCCESS load."""
    h = history.where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    return profiled.withColumnRenamed("path", "source_file").join(
        h.select("source_file", "file_hash"), ["source_file", "file_hash"], "left_semi") \
        .withColumnRenamed("source_file", "path")
