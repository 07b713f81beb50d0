"""File discovery and profiling (SRC-1, 2, 4, 8, 9, 10).

``discover`` lists files through the session's Hadoop file systems, so names
that begin with ``_`` or ``.``, patterns with folders and names with glob
characters all work.  ``profile`` opens each surviving file once, in a
distributed job that streams it in blocks whatever its size: SHA-256 of the
whole content, the header record (as long as it is), the separator, the column
names and whether a quoted field runs over a line end.
"""

from __future__ import annotations

import csv
import datetime as dt
import fnmatch
import hashlib
import re
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.store import HadoopFS, arrow_file_system, glob_escape

# Supported source suffixes and candidate CSV separators (in
# tie-break order: the first wins when counts are equal).
CSV_SUFFIXES = (".csv",)
EXCEL_SUFFIXES = (".xlsx", ".xlsm")
PARQUET_SUFFIXES = (".parquet",)
SUPPORTED_SUFFIXES = CSV_SUFFIXES + EXCEL_SUFFIXES + PARQUET_SUFFIXES
SEPARATORS = [",", ";", "\t", "|"]
BLOCK = 4 << 20                 # bytes read at once; no effect on results
LISTING = ("path string, file_name string, suffix string, file_size_bytes bigint, "
           "file_modified_at timestamp_ntz")


def local_path(c) -> Column:
    """``file:/x/y`` -> ``/x/y``; other schemes keep their URI."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, r"^file:(//)?(?=/)", "")


def source_path() -> Column:
    """The path of the file a row was read from, as :func:`discover` lists it
    (Spark's metadata column is URL-encoded; a plus sign stands for itself)."""
    return local_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def discover(spark: SparkSession, folders: str | Sequence[str], pattern: str = "*",
             recursive: bool = False) -> DataFrame:
    """Files below ``folders`` matching the glob ``pattern`` (which may name
    sub-folders; ``recursive``: names at any depth): path, name, suffix, size
    and modification time.  No content is read; like Spark's own file index,
    the driver holds one small row per file."""
    fs, found = HadoopFS(spark), []
    for folder in [folders] if isinstance(folders, str) else folders:
        folder = folder.rstrip("/")
        if recursive:
            found += [x for x in fs.walk(folder) if fnmatch.fnmatchcase(x[0].rsplit("/", 1)[1], pattern)]
        else:
            found += fs.glob(f"{glob_escape(folder)}/{pattern}")
    rows = []
    for path, size, stamp in sorted(set(found)):
        path = re.sub(r"^file:(//)?(?=/)", "", path)
        name = path.rsplit("/", 1)[1]
        dot = name.rfind(".")
        at = dt.datetime.fromtimestamp(stamp // 1000, dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(milliseconds=stamp % 1000)
        rows.append((path, name, name[dot:].lower() if dot >= 0 else "", size, at))
    return spark.createDataFrame(rows, LISTING)


def unsupported(files: DataFrame) -> DataFrame:
    """SRC-8: discovered files whose suffix no reader handles."""
    return files.where(~F.col("suffix").isin(list(SUPPORTED_SUFFIXES)))


def raise_if_unsupported(files: DataFrame) -> None:
    bad = [r.path for r in unsupported(files).select("path").orderBy("path").collect()]
    if bad:
        raise ValueError(f"Unsupported file: {', '.join(bad)}")


def separator(header: str) -> str:
    """The candidate that occurs most outside quotes (ties: listed order)."""
    bare = "".join(header.split('"')[::2])
    best = max(SEPARATORS, key=lambda x: (bare.count(x), -SEPARATORS.index(x)))
    return best if best in bare else ","


def header_columns(header: str, sep: str) -> list[str]:
    """Column names of a header record, by the rules of CSV."""
    return [c.strip() for c in next(csv.reader([header], delimiter=sep), [])] if header.strip() else []


class _Scan:
    """One pass over a CSV file's blocks: the header record, and whether some
    line (ended by a line feed or a carriage return) has an odd number of
    quotes, i.e. a quoted field goes on behind it.  Holds the header and two
    flags, never a whole line of the data."""

    def __init__(self):
        self.head, self.head_done, self.in_quotes, self.odd, self.quoted = [], False, False, False, False

    def feed(self, block: bytes) -> None:
        if not self.head_done:
            self._feed_header(block)
        if not self.quoted and (self.odd or b'"' in block):
            data = np.frombuffer(block, np.uint8)
            quotes = np.flatnonzero(data == 0x22)
            ends = np.flatnonzero((data == 0x0A) | (data == 0x0D))
            # quotes before each line end and before the block's own end, less those of earlier lines
            before = np.append(np.searchsorted(quotes, ends), len(quotes))
            odd = np.diff(before, prepend=0) % 2 == 1
            odd[0] ^= self.odd
            self.quoted, self.odd = bool(odd[:-1].any()), bool(odd[-1])

    def _feed_header(self, block: bytes) -> None:
        start = 0
        for end in re.finditer(rb"[\n\r]", block):
            self.in_quotes ^= block.count(b'"', start, end.start()) % 2 == 1
            start = end.start()
            if not self.in_quotes:
                self.head_done = True
                self.head.append(block[:start])
                return
        self.in_quotes ^= block.count(b'"', start) % 2 == 1
        self.head.append(block)

    def header(self) -> str:
        return b"".join(self.head).decode("utf-8", "replace").lstrip("\ufeff")


def _stream_profile(batches: Iterable) -> Iterable:
    """mapInPandas body: every file is read once, in blocks."""
    import pandas as pd
    for pdf in batches:
        out = []
        for path, suffix in zip(pdf["path"], pdf["suffix"]):
            system, inner = arrow_file_system(path)
            digest, scan = hashlib.sha256(), _Scan()
            with system.open_input_stream(inner, compression=None) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
                    if suffix in CSV_SUFFIXES:
                        scan.feed(block)
            header, sep = scan.header(), None
            columns: list[str] = []
            if suffix in CSV_SUFFIXES:
                sep = separator(header)
                columns = header_columns(header, sep)
            elif suffix in PARQUET_SUFFIXES:
                import pyarrow.parquet as pq
                with system.open_input_file(inner) as f:
                    columns = pq.read_schema(f).names
            out.append((path, digest.hexdigest(), header, scan.quoted or scan.odd, sep, columns))
        yield pd.DataFrame(out, columns=["path", "file_hash", "header", "quoted", "sep", "columns"])


def profile(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Per file: SHA-256 hex, header record, separator, column names (CSV and
    Parquet) and ``quoted``: a quoted field may run over a line end (only such
    files need a whole-file CSV parse; the rest stay splittable).

    ``files`` is a :func:`discover` frame (already filtered, e.g. by the
    incremental anti-join); only those paths are opened.  Lazy: a caller that
    uses it twice, or changes the ledger behind its filter, writes it first.
    """
    # listings are tiny: by column alone, adaptive execution would put all files into one task
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    prof = files.select("path", "suffix").repartition(tasks, "path").mapInPandas(
        _stream_profile, "path string, file_hash string, header string, quoted boolean, sep string, columns array<string>")
    return files.select("path", "file_name", "suffix", "file_size_bytes", "file_modified_at").join(prof, "path")


def missing_required(profiled: DataFrame, required: Sequence[str] | None) -> DataFrame:
    """SRC-9: one row per file with its sorted missing required columns
    (empty array when complete); names are compared after trimming,
    case-sensitively.  ``required`` None or empty = no check."""
    req = F.array(*[F.lit(c) for c in (required or [])]).cast("array<string>")
    return profiled.select("path", "file_name",
                           F.array_sort(F.array_except(req, F.col("columns"))).alias("missing"))


def raise_if_missing(profiled: DataFrame, required: Sequence[str] | None) -> None:
    if not required:
        return
    bad = (missing_required(profiled, required).where(F.size("missing") > 0)
           .orderBy("path").limit(1).collect())
    if bad:
        r = bad[0]
        raise ValueError(f"Missing required column(s) in {r.file_name}: {', '.join(r.missing)}")


def dedupe_names(columns: Sequence[str]) -> list[str]:
    """Header names as the reference's reader exposes them: duplicates get
    ``_1``, ``_2`` ...; a blank name becomes ``column<i>``."""
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(columns):
        name = c if c else f"column{i}"
        base, k = name, seen.get(name.lower(), 0)
        while name.lower() in seen:
            k += 1
            name = f"{base}_{k}"
        seen[base.lower()] = k
        seen[name.lower()] = 0
        out.append(name)
    return out

