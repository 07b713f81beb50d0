"""Working tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.plans.scratch import scratch


class Workspace:
    """Written tables of one run: ``put`` cuts lineage, ``drop`` removes the folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, scratch(spark, label)

    def put(self, name: str, df: DataFrame, big_rows: bool = False, **options) -> DataFrame:
        """``big_rows``: rows of some MB each, a row group of its own for every one.
        Spark's reader decodes a row group's 4,096 rows at once, and its writer looks
        at the size of a row group after 100 rows only."""
        if big_rows:
            options["parquet.block.row.count.limit"] = 1
        df.write.mode("overwrite").options(**options).parquet(f"{self.path}/{name}")
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal first ``keys`` columns (long), over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if last is not None and last != tuple(c[0] for c in cols):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
