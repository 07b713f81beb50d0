"""Path-based table store: ``<root>/<schema>/<table>`` Parquet folders.

* Names are checked against a strict ``schema.table`` pattern before any path
  is built (BRZ-9 / SNK-3) — one rule for ingest and export.
* Bronze tables are sets of batches: each load writes a temporary sibling and
  renames it to the partition folder ``_batch=<batch id>``, so a failed write
  leaves no table.  Row-wise models (Silver, facts) and the partial aggregates
  of the marts follow Bronze batch by batch, under the same ids.
* Reads take committed batches only (BRZ-8, SRC-12).  An id with a dot is
  ``<pipeline>.<run id>``; it counts once the file history holds that run, so
  rows of a load under way, or of one that crashed, are never visible.  Other
  ids are written outside a pipeline and count at once.
* A pipeline's replace load names its batch in a ``_full-<batch id>`` file; from
  the moment the run is recorded, earlier batches no longer count.
* A written batch has an id of its own (``_id-<uuid>``), which changes when the
  batch is written again; what was built from it names it (``_from-<digest>``).
* The other models are full refreshes (BLD-2): written to a sibling temporary
  folder and swapped in by rename, so readers never see half a table
  and a model may read the table it replaces.
* The ledger tables (``metadata.*``) are append-only; "latest row per key"
  views are aggregates on read (:mod:`millrace.plans.ledger`).  Their small
  files are folded into few, so they don't grow in number with the runs.

File-system calls go through Hadoop's FileSystem API of the session, so the
same code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted table names, ``schema.table`` with identifier parts.
SAFE_TABLE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*\.[A-Za-z_][A-Za-z0-9_]*$")
BATCH_COLUMN = "_batch"
HISTORY = "metadata.file_history"
# names of mark files; Spark's readers skip them
WRITE_MARK, SOURCE_MARK, FULL_MARK = "_id-", "_from-", "_full-"
FOLD_BYTES = 128 << 20          # of a folded file of an append-only table
# How batches are encoded.  Their rows are wide text: looking every value up in a
# dictionary, and copying it from there at every read, takes more time than zstd
# needs for what repeats; pages of more rows give zstd more of it to find.
BATCH_OPTIONS = {"parquet.enable.dictionary": "false", "parquet.page.row.count.limit": "200000"}


def check_table_name(table: str) -> tuple[str, str]:
    if not isinstance(table, str) or not SAFE_TABLE.fullmatch(table):
        raise ValueError(f"Unsafe table: {table}")
    schema, name = table.split(".")
    return schema, name


class HadoopFS:
    """Minimal file-system helper over the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        return self._path(p).getFileSystem(self._conf)

    def exists(self, p: str) -> bool:
        return self._fs(p).exists(self._path(p))

    def delete(self, p: str) -> bool:
        return self._fs(p).delete(self._path(p), True)

    def rename(self, src: str, dst: str) -> bool:
        return self._fs(src).rename(self._path(src), self._path(dst))

    def mkdirs(self, p: str) -> bool:
        return self._fs(p).mkdirs(self._path(p))

    def touch(self, p: str) -> None:
        self._fs(p).create(self._path(p), True).close()

    def write_lines(self, p: str, lines: list[str]) -> None:
        out = self._fs(p).create(self._path(p), True)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()

    def read_lines(self, p: str) -> list[str]:
        stream = self._fs(p).open(self._path(p))
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text.splitlines()

    def list_names(self, p: str) -> list[str]:
        if not self.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs(p).listStatus(self._path(p)))

    def glob(self, pattern: str) -> list[tuple[str, int, int]]:
        """(path, bytes, modification time in ms) of the files a glob matches,
        names that begin with ``_`` or ``.`` included."""
        found = self._fs(pattern).globStatus(self._path(pattern)) or []
        return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found if s.isFile()]

    def walk(self, folder: str) -> list[tuple[str, int, int]]:
        """The same for every file below a folder."""
        out, it = [], self._fs(folder).listFiles(self._path(folder), True)
        while it.hasNext():
            s = it.next()
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        return out

    def copy(self, src: str, dst: str) -> None:
        util = self._jvm.org.apache.hadoop.fs.FileUtil
        util.copy(self._fs(src), self._path(src), self._fs(dst), self._path(dst), False, self._conf)


_GLOB_MARK = re.compile(r"([{}\[\]*?\\])")


def glob_escape(path: str) -> str:
    """A path that stands for itself where Spark and Hadoop expect a glob."""
    return _GLOB_MARK.sub(r"\\\1", path)


def arrow_file_system(uri: str):
    """(pyarrow file system, path) for a URI as Spark writes it, for code that
    streams a file inside a task."""
    from pyarrow import fs
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", uri).lstrip("/")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + rest)


class TableStore:
    """Tables of one pipeline deployment below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = HadoopFS(spark)

    # ------------------------------------------------------------ paths
    def path(self, table: str) -> str:
        schema, name = check_table_name(table)
        return f"{self.root}/{schema}/{name}"

    def exists(self, table: str) -> bool:
        """Whether the table holds data that counts (a folder that a failed
        write or an unrecorded load left behind is none)."""
        p = self.path(table)
        self._repair(p)
        names = self.fs.list_names(p)
        if any(n.startswith(f"{BATCH_COLUMN}=") for n in names):
            return bool(self.committed(table))
        return any(not n.startswith((".", "_")) for n in names)

    def _repair(self, final: str) -> None:
        """Finish a swap that a crash cut short: between its two renames only
        the table's old folder is there."""
        if self.fs.exists(final):
            return
        parent, name = final.rsplit("/", 1)
        old = [n for n in self.fs.list_names(parent) if n.startswith(f"{name}.__old_")]
        if old:
            self._move(f"{parent}/{old[-1]}", final)

    def _move(self, src: str, dst: str) -> None:
        if not self.fs.rename(src, dst):
            raise RuntimeError(f"could not rename {src} to {dst}")

    def publish(self, tmp: str, final: str) -> str:
        """Move ``tmp`` (file or folder) to ``final``; what was there is put
        back if that fails, and removed afterwards."""
        self._repair(final)
        old = f"{final}.__old_{uuid.uuid4().hex}"
        had_old = self.fs.exists(final)
        if had_old:
            self._move(final, old)
        try:
            self._move(tmp, final)
        except RuntimeError:
            if had_old:
                self._move(old, final)
            raise
        if had_old:
            self.fs.delete(old)
        return final

    # ------------------------------------------------------------ read
    def read(self, table: str) -> DataFrame:
        """The whole table: its committed batches, if it is made of batches.
        Every batch is written aligned to the table's columns, so no schema
        merge (no pass over all file footers) is needed."""
        p = self.path(table)
        if not self.batches(table):
            folded = self._folded(p)
            if not folded:
                return self.spark.read.parquet(p)
            return self.spark.read.parquet(*(glob_escape(f"{p}/{n}") for n in self.fs.list_names(p)
                                             if not n.startswith((".", "_")) and n not in folded))
        visible = self.committed(table)
        if not visible:
            raise ValueError(f"{table} has no committed batch")
        return self.spark.read.parquet(*(glob_escape(f"{p}/{BATCH_COLUMN}={b}") for b in visible))

    def read_batch(self, table: str, batch_id: str) -> DataFrame:
        """One batch, committed or not."""
        return self.spark.read.parquet(glob_escape(f"{self.path(table)}/{BATCH_COLUMN}={batch_id}"))

    def committed(self, table: str) -> list[str]:
        """Ids of the batches that count: those of recorded runs, from the last
        recorded replace load on, and those written outside a pipeline."""
        batches = self.batches(table)
        owned = [b for b in batches if "." in b]
        if not owned:
            return batches
        at = self._recorded(owned)
        cut = max((at[b] for b in self._full_batches(table) if b in at), default=None)
        if cut is not None:
            return [b for b in batches if b in at and at[b] >= cut]
        return [b for b in batches if "." not in b or b in at]

    def _recorded(self, batches: list[str]) -> dict:
        """Batch id -> when its run was recorded, for recorded ones (one row a batch)."""
        if not self.fs.exists(self.path(HISTORY)):
            return {}
        runs = (self.read(HISTORY).where(F.col("status") == "SUCCESS")
                .select(F.concat_ws(".", "pipeline_name", "run_id").alias("batch"), "loaded_at"))
        asked = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        found = runs.join(asked, "batch", "left_semi").groupBy("batch").agg(F.max("loaded_at").alias("at"))
        return {r["batch"]: r["at"] for r in found.collect()}

    def _full_batches(self, table: str) -> list[str]:
        return [n[len(FULL_MARK):] for n in self.fs.list_names(self.path(table)) if n.startswith(FULL_MARK)]

    # ------------------------------------------------------------ write
    def overwrite(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Full refresh: write a temporary sibling, then swap by rename."""
        final = self.path(table)
        tmp = f"{final}.__tmp_{uuid.uuid4().hex}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(tmp)
        return self.publish(tmp, final)

    def write_batch(self, table: str, df: DataFrame, batch_id: str, source: str | None = None, full: bool = False) -> str:
        """Write (or re-write) one batch: a hidden sibling first, then a rename
        to its partition folder, so readers never see half a batch.  ``source``
        names what it was built from; ``full`` marks a pipeline's replace load."""
        if "/" in batch_id or "=" in batch_id:
            raise ValueError(f"bad batch id: {batch_id}")
        folder = self.path(table)
        target = f"{folder}/{BATCH_COLUMN}={batch_id}"
        tmp = self._written(f"{folder}/.__tmp_{uuid.uuid4().hex}", df, source)
        if full:
            self.fs.touch(f"{folder}/{FULL_MARK}{batch_id}")
        if self.fs.exists(target):
            old = f"{folder}/.__old_{uuid.uuid4().hex}"
            self._move(target, old)
            self._move(tmp, target)
            self.fs.delete(old)
        else:
            self._move(tmp, target)
        return target

    def _written(self, folder: str, df: DataFrame, source: str | None) -> str:
        df.write.mode("overwrite").options(**BATCH_OPTIONS).parquet(folder)
        self.fs.touch(f"{folder}/{WRITE_MARK}{uuid.uuid4().hex}")
        if source is not None:
            self.fs.touch(f"{folder}/{SOURCE_MARK}{source}")
        return folder

    def replace_batches(self, table: str, df: DataFrame, batch_id: str, source: str | None = None) -> str:
        """The table becomes exactly this batch (written to a temporary table
        folder, then swapped in)."""
        final = self.path(table)
        tmp = f"{final}.__tmp_{uuid.uuid4().hex}"
        self._written(f"{tmp}/{BATCH_COLUMN}={batch_id}", df, source)
        return self.publish(tmp, final)

    def marks(self, table: str, mark: str) -> dict[str, str]:
        """Batch id -> its mark of one kind, from one listing."""
        found = self.fs.glob(f"{glob_escape(self.path(table))}/{BATCH_COLUMN}=*/{mark}*")
        named = (p.rsplit("/", 2)[-2:] for p, _, _ in found)
        return {folder[len(BATCH_COLUMN) + 1:]: name[len(mark):] for folder, name in named}

    def drop_superseded(self, table: str) -> None:
        """After a recorded replace load: remove the batches before it."""
        full = self._full_batches(table)
        if not full:
            return
        batches = self.batches(table)
        at, keep = self._recorded([b for b in batches if "." in b]), set(self.committed(table))
        if not any(b in at for b in full):
            return
        for b in batches:
            # what no run recorded belongs to a load under way, or is removed by its pipeline's next one
            if b not in keep and ("." not in b or b in at):
                self.drop_batch(table, b)
        for b in full:
            if b in at:
                self.fs.delete(f"{self.path(table)}/{FULL_MARK}{b}")

    def batches(self, table: str) -> list[str]:
        """Ids of the table's batches."""
        mark = f"{BATCH_COLUMN}="
        return [n[len(mark):] for n in self.fs.list_names(self.path(table)) if n.startswith(mark)]

    def drop_batch(self, table: str, batch_id: str) -> None:
        self.fs.delete(f"{self.path(table)}/{BATCH_COLUMN}={batch_id}")
        self.fs.delete(f"{self.path(table)}/{FULL_MARK}{batch_id}")

    def drop(self, table: str) -> None:
        """Remove a table with its columns."""
        self.fs.delete(self.path(table))

    def append(self, table: str, df: DataFrame) -> None:
        """Append-only write (ledger records)."""
        df.write.mode("append").parquet(self.path(table))

    def fold(self, table: str, keep: int = 32) -> int:
        """Fold an append-only table's files into a few once they are more than
        ``keep``; returns how many were folded.

        Folded files are named in a note, so that readers leave them out, and
        stay until the next fold, so that a reader that began before still finds
        them.  Between the fold's files and its note, or after a crash there,
        records are there twice: readers take distinct ones.
        """
        folder = self.path(table)
        note = f"{folder}/_folded"
        files = {p.rsplit("/", 1)[1]: size for p, size, _ in self.fs.glob(f"{glob_escape(folder)}/*")}
        files = {name: size for name, size in files.items() if not name.startswith((".", "_"))}
        done = self._folded(folder)
        live = sorted(files.keys() - done)
        if len(live) <= keep:
            return 0
        for name in done & files.keys():
            self.fs.delete(f"{folder}/{name}")
        fold = uuid.uuid4().hex
        tmp = f"{folder}/.__fold_{fold}"
        parts = 1 + sum(files[name] for name in live) // FOLD_BYTES
        (self.spark.read.schema(self.read(table).schema).parquet(*(glob_escape(f"{folder}/{name}") for name in live))
         .distinct().coalesce(parts).write.parquet(tmp))
        for name in self.fs.list_names(tmp):
            if not name.startswith((".", "_")):
                self._move(f"{tmp}/{name}", f"{folder}/fold-{fold}-{name}")
        self.fs.delete(tmp)
        self.fs.write_lines(f"{folder}/.__note_{fold}", live)
        self.publish(f"{folder}/.__note_{fold}", note)
        return len(live)

    def _folded(self, folder: str) -> set[str]:
        """Names of files whose records a later file holds."""
        self._repair(f"{folder}/_folded")
        return set(self.fs.read_lines(f"{folder}/_folded")) if self.fs.exists(f"{folder}/_folded") else set()

    def clear(self, table: str) -> None:
        """Empty a table; its columns stay (no-op when absent)."""
        if self.exists(table):
            self.replace_batches(table, self.read(table).limit(0), "empty")
