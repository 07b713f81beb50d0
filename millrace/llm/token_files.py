"""Token ids as Arrow IPC files of fixed-size lists (operator 9).

Documents are dealt out by ranges of ascending id; each task writes its ids as
one Arrow IPC file: batches of equal-length sequences (``ids``: fixed-size list
of uint16, or uint32 for larger vocabularies) with a ``mask`` (fixed-size list
of booleans, false on the padding of the file's last sequence), and beside it
an index file (id, first token, tokens).  Nothing is compressed, so a reader
that maps the file gets any sequence, or any document, without a copy.

A file's name is new for each attempt and only the names that a finished task
returned are in the manifest, so lost executors and retried tasks leave no
wrong file.  Files go to the folder that executors share, through pyarrow's
file systems (local, s3a, hdfs, gs, abfs).

Defined results: a null or empty text is its end id alone.  A null id comes
first; rows with equal ids follow each other by crc32 of the text.  An empty
table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.scratch import Workspace
from millrace.llm.subword import coder
from millrace.llm.unit_coder import BLOCK_BYTES


@dataclass(frozen=True)
class Config:
    length: int = 1024           # ids of a sequence
    batch: int = 256             # sequences of a record batch
    end_id: int = 2
    tokenizer: str | None = None


def file_system(uri: str):
    """(file system, path) of a folder Spark names."""
    from pyarrow import fs
    scheme, sep, rest = uri.partition(":")
    if not sep or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if sep else uri).lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    return fs.FileSystem.from_uri(uri)


def schema(config: Config, wide: bool, id_type: pa.DataType) -> tuple[pa.Schema, pa.Schema]:
    kind = pa.uint32() if wide else pa.uint16()
    about = {"end_id": str(config.end_id), "length": str(config.length), "batch": str(config.batch)}
    return (pa.schema([pa.field("ids", pa.list_(kind, config.length), False), pa.field("mask", pa.list_(pa.bool_(), config.length), False)], about),
            pa.schema([pa.field("id", id_type), pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64())]))


class Writer:
    """One task's pair of files; holds less than one record batch."""

    def __init__(self, folder: str, name: str, config: Config, wide: bool, id_type: pa.DataType):
        self.config, self.kind = config, np.uint32 if wide else np.uint16
        self.fs, path = file_system(folder)
        self.fs.create_dir(path, recursive=True)
        self.sequences, self.documents = schema(config, wide, id_type)
        self.out = self.fs.open_output_stream(f"{path}/{name}.arrow")
        self.index_out = self.fs.open_output_stream(f"{path}/{name}.index.arrow")
        self.writer = pa.ipc.new_file(self.out, self.sequences)
        self.index = pa.ipc.new_file(self.index_out, self.documents)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.total, len(ids)))
        self.total += len(ids)
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        full = self.config.length * self.config.batch
        if self.n_held >= full:
            flat = np.concatenate(self.held)
            whole = len(flat) // full * full
            for lo in range(0, whole, full):
                self._batch(flat[lo:lo + full], full)
            self.held, self.n_held = [flat[whole:].copy()], len(flat) - whole
        if len(self.rows) >= 8192:
            self._index()

    def _batch(self, flat: np.ndarray, used: int) -> None:
        n = self.config.length
        ids = pa.FixedSizeListArray.from_arrays(pa.array(flat), n)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < used), n)
        self.writer.write_batch(pa.RecordBatch.from_arrays([ids, mask], schema=self.sequences))

    def _index(self) -> None:
        if self.rows:
            cols = list(zip(*self.rows))
            self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.documents)], schema=self.documents))
            self.rows = []

    def close(self) -> int:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.kind)
        if len(flat):
            short = -len(flat) % self.config.length
            self._batch(np.concatenate([flat, np.full(short, self.config.end_id, self.kind)]), len(flat))
        self._index()
        for x in (self.writer, self.index, self.out, self.index_out):
            x.close()
        return self.total


class Reader:
    """Random access to one file's sequences and documents; local files are mapped."""

    def __init__(self, folder: str, name: str):
        self.fs, path = file_system(folder)
        self.file = pa.ipc.open_file(self._source(f"{path}/{name}.arrow"))
        self.documents = pa.ipc.open_file(self._source(f"{path}/{name}.index.arrow"))
        about = self.file.schema.metadata
        self.length, self.batch = int(about[b"length"]), int(about[b"batch"])
        self._at, self._flat = -1, None

    def _source(self, path: str):
        return pa.memory_map(path) if self.fs.type_name == "local" else self.fs.open_input_file(path)

    def _ids(self, batch: int) -> np.ndarray:
        if batch != self._at:
            self._at, self._flat = batch, self.file.get_batch(batch).column(0).flatten().to_numpy()
        return self._flat

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the k-th sequence (views)."""
        got = self.file.get_batch(k // self.batch)
        lo = k % self.batch * self.length
        return (got.column(0).flatten().to_numpy()[lo:lo + self.length],
                got.column(1).flatten().slice(lo, self.length).to_numpy(zero_copy_only=False))

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views that together are the ``n`` ids from ``start`` on."""
        full = self.length * self.batch
        while n:
            flat, lo = self._ids(start // full), start % full
            part = flat[lo:lo + n]
            yield part
            start, n = start + len(part), n - len(part)

    def index(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.documents.num_record_batches):
            yield self.documents.get_batch(k)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Write the files; returns the manifest (part, name, n_docs, n_tokens), lazily: materialise it once."""
    from pyspark.sql.pandas.types import to_arrow_type
    config = config or Config()
    spark = docs.sparkSession
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = to_arrow_type(src.schema["id"].dataType)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = src.withColumn("crc", F.crc32("text")).repartitionByRange(n, "id", "crc").sortWithinPartitions("id", "crc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, units = TaskContext.get().partitionId(), coder(config.tokenizer)
        units.limit = None
        wide = units.library.get_vocab_size(with_added_tokens=True) > 1 << 16 or config.end_id >= 1 << 16
        end = np.array([config.end_id], np.uint32)
        writer, n_docs = None, 0
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, data, offsets in tx.text_blocks(batch.column(1), BLOCK_BYTES):
                ids, first = units.encode(data, offsets)
                for k in range(b - a):
                    writer = writer or Writer(folder, name, config, wide, id_type)
                    writer.add(keys[a + k], np.concatenate([ids[first[k]:first[k + 1]], end]))
                n_docs += b - a
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([name]), pa.array([n_docs], pa.int64()),
                                              pa.array([writer.close()], pa.int64())], names=["part", "name", "n_docs", "n_tokens"])

    return dealt.mapInArrow(run, "part bigint, name string, n_docs bigint, n_tokens bigint")


def read_documents(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """id, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` read from the files."""
    # one row per file; a file's first token is the sum of those before
    rows = manifest.orderBy("part").select("part", "name", "n_tokens").collect()
    spark, at, files = manifest.sparkSession, 0, []
    for r in rows:
        files.append((r["part"], r["name"], at))
        at += r["n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                reader = Reader(folder, name)
                for docs in reader.index():
                    crc = []
                    for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        value = 0
                        for ids in reader.tokens(start, n):
                            value = zlib.crc32(ids.astype("<u4").tobytes(), value)
                        crc.append(value)
                    yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(docs.column(1).to_numpy() + first), docs.column(2), pa.array(crc, pa.int64())],
                                                     names=["id", "start", "n_tokens", "ids_crc32"])

    table = spark.createDataFrame(files, "part bigint, name string, first bigint")
    return (table.repartition(max(1, len(files)), "part")
            .mapInArrow(run, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"))


def token_files(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """Write the files (to a new shared folder unless named) and read every document back."""
    ws = Workspace(docs.sparkSession, "token-files")
    folder = folder or f"{ws.path}/files"
    manifest = ws.put("manifest", write_tokens(docs, folder, id_col, text_col, config))
    return read_documents(manifest, folder, docs.schema[id_col].dataType.simpleString()).withColumnRenamed("id", id_col)
