"""K-d tree sharding (operator 2), DataFrame operations only.

Rows become points in a small metadata space (by default byte size, character
count and language).  From one node holding everything, each node is split at
the byte-weighted median along its widest dimension, until there are as many
leaves as shards, i.e. until a leaf holds its target bytes.

A weighted median is found without a sort: rows are ordered by (coordinate,
crc32 of the text, id), read as a sequence of 16-bit digits.  A grouped sum per
digit shows which digit's rows straddle the target; the next job refines only
that digit's rows.  It stops as soon as the rows in question weigh less than
``tolerance`` of a leaf; they go to the side that is nearer to the target.  So
rows with equal texts stay together unless together they outweigh the
tolerance, and a group of any size is cut by id where it must be.  All nodes of
a level share their jobs; at most 2**16 sums a node reach the driver.

Law: ``bytes`` (shards' sizes near equal).  Slots number each shard's rows
without gaps, by crc32 and id.

Defined results: a null text weighs 1 byte and has crc32 0; null metadata lie
below all values; a null id sorts first.  Repeated rows are placed like any
others; only rows equal in all of the key stay together whatever they weigh.
An empty table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import Workspace

_BITS = 16


def _byte_size(df: DataFrame, text: str) -> Column:
    return F.coalesce(F.octet_length(df[text]), F.lit(0)).cast("bigint") + 1


def _log_scale(c: Column) -> Column:
    """A count as a 32-bit coordinate that grows with its logarithm (ties only between equals in practice)."""
    return F.coalesce((F.log2(F.greatest(c, F.lit(0)) + 1) * F.lit(float(1 << 26))).cast("bigint"), F.lit(0))


def default_dimensions(df: DataFrame, text: str) -> list[Column]:
    """Coordinates from 0 to below 2**32: byte size, characters, language."""
    return [_log_scale(_byte_size(df, text)), _log_scale(F.char_length(df[text])),
            F.coalesce(F.crc32(df["lang"]) + 1, F.lit(0)).cast("bigint") if "lang" in df.columns else F.lit(0).cast("bigint")]


def shards(docs: DataFrame, count: int = 16, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.004,
           slot_partitions: int | None = None, dimensions: Callable[[DataFrame, str], Sequence[Column]] = default_dimensions) -> DataFrame:
    """Rows' id, ``size``, ``text_crc32``, ``shard`` and ``slot``; ``count`` is a power of two."""
    depth = count.bit_length() - 1
    if 1 << depth != count:
        raise ValueError(f"shard count must be a power of two: {count}")
    spark = docs.sparkSession
    ws = Workspace(spark, "kd-shards")
    dims = list(dimensions(docs, text_col))
    points = docs.select(docs[id_col].alias("id"), _byte_size(docs, text_col).alias("size"),
                         F.coalesce(F.crc32(docs[text_col]), F.lit(0)).alias("crc"), *[d.cast("bigint").alias(f"d{i}") for i, d in enumerate(dims)])
    # the id as an ascending unsigned number; null first
    points = ws.put("points", points.withColumn("key", F.coalesce(F.col("id").cast("bigint"), F.lit(-(1 << 63)))))
    node = F.lit(0)
    total = points.agg(F.sum("size").alias("s")).first()["s"] or 0
    slack = tolerance * total / count
    extent = points.agg(*[F.min(f"d{i}").alias(f"lo{i}") for i in range(len(dims))], *[F.max(f"d{i}").alias(f"hi{i}") for i in range(len(dims))]).first()
    for level in range(depth):
        placed = points.withColumn("node", node)
        spans = placed.groupBy("node").agg(F.sum("size").alias("s"), *[F.min(f"d{i}").alias(f"lo{i}") for i in range(len(dims))],
                                           *[F.max(f"d{i}").alias(f"hi{i}") for i in range(len(dims))]).collect()
        cuts = {}
        for r in spans:
            wide = [(r[f"hi{i}"] - r[f"lo{i}"]) / max(1, extent[f"hi{i}"] - extent[f"lo{i}"]) for i in range(len(dims))]
            axis = max(range(len(dims)), key=lambda i: (wide[i], -i))
            cuts[r["node"]] = {"axis": axis, "target": r["s"] / 2, "below": 0, "prefix": []}
        _medians(placed, cuts, slack)
        # right of the cut: node * 2 + 1
        right = F.lit(False)
        for n, c in cuts.items():
            right = F.when(F.col("node") == n, _beyond(c)).otherwise(right)
        points = ws.put(f"level{level}", placed.withColumn("node", (F.col("node") * 2 + right.cast("int")).cast("int")))
        ws.drop(f"level{level - 1}" if level else "points")
        node = F.col("node")
    return _slots(ws, points.withColumn("node", node), f"level{depth - 1}" if depth else "points", id_col, slot_partitions)


def _digits(axis: int) -> list[Column]:
    """The row's place as 16-bit digits: coordinate (2), crc32 (2), id (4)."""
    parts = [(F.col(f"d{axis}"), 32), (F.col("crc"), 32), (F.col("key"), 64)]
    out = []
    for c, bits in parts:
        for shift in range(bits - _BITS, -1, -_BITS):
            digit = F.shiftrightunsigned(c, shift).bitwiseAND((1 << _BITS) - 1)
            # the id's sign bit is turned, so negative ids come first
            out.append(digit.bitwiseXOR(1 << (_BITS - 1)) if bits == 64 and shift == bits - _BITS else digit)
    return out


def _medians(placed: DataFrame, cuts: dict, slack: float) -> None:
    """Refine every node's cut until the rows at the cut weigh less than ``slack``."""
    open_ = set(cuts)
    for step in range(8):
        if not open_:
            return
        wanted, digit = F.lit(False), F.lit(0).cast("bigint")
        for n in open_:
            c = cuts[n]
            own = F.col("node") == n
            digits = _digits(c["axis"])
            for d, value in zip(digits, c["prefix"]):
                own = own & (d == value)
            wanted = wanted | own
            digit = F.when(F.col("node") == n, digits[step]).otherwise(digit)
        sums = placed.where(wanted).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("s")).orderBy("node", "digit").collect()
        by_node: dict = {}
        for r in sums:
            by_node.setdefault(r["node"], []).append(r)
        for n, rows in by_node.items():
            c, before = cuts[n], cuts[n]["below"]
            for k, r in enumerate(rows):
                if before + r["s"] >= c["target"] or k == len(rows) - 1:
                    c["prefix"] = [*c["prefix"], r["digit"]]
                    c["below"] = before
                    if r["s"] <= slack or step == 7:
                        # the straddling rows go to the nearer side
                        c["left"] = c["target"] - before >= before + r["s"] - c["target"]
                        open_.discard(n)
                    break
                before += r["s"]


def _beyond(cut: dict) -> Column:
    """Is the row right of the cut?  Digits compared in order with the cut's prefix."""
    digits = _digits(cut["axis"])[:len(cut["prefix"])]
    out = F.lit(not cut.get("left", True))
    for d, value in reversed(list(zip(digits, cut["prefix"]))):
        out = F.when(d > value, F.lit(True)).when(d < value, F.lit(False)).otherwise(out)
    return out


def _slots(ws: Workspace, points: DataFrame, last: str, id_col: str, partitions: int | None) -> DataFrame:
    """Number each shard's rows: range partitions in (shard, crc, id) order, row
    numbers inside a partition, and per partition the rows of its shard before."""
    spark = points.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["node", "crc", "key"]
    placed = points.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = ws.put("ordered", placed.select("id", "size", "crc", "node", "at"))
    ws.drop(last)
    part = F.shiftright("at", 33).alias("part")
    # one row for each partition and shard in it: at most partitions + shards
    counts = placed.groupBy("node", part).agg(F.count("*").alias("n"), F.min("at").alias("first")).select(
        "node", "part", "n", "first")
    from pyspark.sql import Window
    before = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("node", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    out = placed.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(offsets), ["node", "part"])
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      F.col("node").cast("int").alias("shard"), (F.col("at") + F.col("shift")).cast("bigint").alias("slot"))
