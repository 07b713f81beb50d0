"""Keep the latest row per key (WIN-1, WIN-2, JN-3, SRT-3, LED-4).

The reference writes ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY t DESC) = 1``
(or joins rank 1 back).  A window puts every row of a key into one task and
sorts it there, so one hot key holding a third of the data becomes one huge
task.  Here the same answer is an aggregate: ``max(struct(order..., payload...))``
per key.  Struct comparison is field by field with NULL smallest, i.e. exactly
``ORDER BY o1 DESC NULLS LAST, o2 DESC NULLS LAST, ...``; the aggregate is
partial, so each map task reduces its share of a hot key to one row before the
shuffle.  Callers pass enough ordering columns to make the order total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_struct(order_by: Sequence, payload: Sequence[str], name: str = "_latest") -> Column:
    """Aggregate expression: the payload of the greatest ``order_by`` tuple."""
    fields = [_as_col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    fields += [F.col(c).alias(c) for c in payload]
    return F.max(F.struct(*fields)).alias(name)


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence,
              payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_by`` values
    (descending, NULLs last).  Output columns: keys then payload, in order."""
    payload = [c for c in (payload or df.columns) if c not in keys]
    out = df.groupBy(*keys).agg(latest_struct(order_by, payload))
    return out.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in payload])


def rank_desc_window(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                     name: str = "event_rank") -> DataFrame:
    """Plain ``row_number()`` window (all rows of a key in one task); kept as
    the reference formulation for tests."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[_as_col(c).desc_nulls_last() for c in order_by])
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def rank_desc(df: DataFrame, keys: Sequence[str], order_by: Sequence,
              name: str = "event_rank", partitions: int | None = None) -> DataFrame:
    """``row_number()`` per key by ``order_by`` descending (NULLs last), with
    no task holding a whole key.

    1. Range-partition and sort by (keys, order): a hot key spreads over
       several consecutive partitions, each sorted.
    2. Number rows inside each partition (``monotonically_increasing_id``
       is consecutive within a partition, in the sorted order).
    3. A small aggregate per (key, partition) gives each key's row count and
       first position per partition; a running sum over the partitions of a
       key (at most one row per partition) gives the offset.
    4. rank = offset + position - first position + 1, joined on
       (key, partition) — a hot key's rows are spread over its partitions.
    The ranged rows are checkpointed once, so the count branch and the row
    branch read the very same partitions (re-evaluating a range exchange over
    an input of unstable order could sample different bounds).  Keys are
    column names; ``order_by`` should be a total order.
    """
    from pyspark.sql import Window
    sort = [F.col(k).asc_nulls_first() for k in keys] + \
        [_as_col(c).desc_nulls_last() for c in order_by]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    from millrace.session import shared_dir
    shared_dir(df.sparkSession)  # checkpoint folder: the cluster's, or a local one in tests
    # Materialize once (reliable checkpoint, survives executor loss): the
    # partition ids and positions become plain columns both branches share.
    ranged = (df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    per_part = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"),
                                                 F.min("_pos").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # NULL is a key like any other (as in the window)
    named = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_pid").alias("_part"), "_first", "_offset")
    same = F.col("_pid") == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = ranged.join(named, same).drop("_part", *[f"_k{i}" for i in range(len(keys))])
    return joined.withColumn(name, (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("bigint")) \
        .drop("_pid", "_pos", "_first", "_offset")
