"""Filter interaction audit over a sparse document-term matrix (operator 13).

Five filters judge every document: A too few words, B too few distinct words,
C too many capitals, D a mark character, E a text that a smaller id has.  The
audit tells, for each part of the corpus and each of the 120 orders of the
filters, what every step removes, what it would have removed, and what is lost.

1. Each task cuts its texts into blocks; a block holds its documents as a CSR
   matrix over its own words (Arrow dictionary codes).
2. The words are dictionary-encoded globally: a block sends each bucket (hash
   of the word) its distinct words as one row, the bucket's task gives every
   distinct word a code, and the codes go back by block.  A word travels once a
   block, however often it occurs, so no frequent word makes a hot task; there
   are never more rows than words sent, and buckets grow in number, not size.
3. A block with the codes is a CSR shard (``matrix``): row pointers, global
   column ids ``bucket << 32 | code``, counts.  Row sums are word counts,
   nonzeros per row are distinct words; they decide A and B.
4. C and D come from the bytes.  For E, rows with the same text (SHA-256) are
   counted by id, then by group, map-side first, and compared with the least id
   of the text; only groups are joined, so a text with any number of copies is
   a few rows.
5. What is left are counts by part, set of failed filters and labels, at most
   32 sets a part; the orders are exploded from those.

Defined results: a null text is empty, a null part is the empty string.  A row
without an id fails E never and gives no other row a reason to fail it; rows
that repeat an id are documents of their own, and none of them is smaller than
the other.  A document is good (toxic) if any label row of its id says 1.  An
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.scratch import Workspace, sorted_groups

FILTERS = "ABCDE"
_CAPITAL = np.isin(np.arange(256), np.arange(0x41, 0x5B))


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    min_distinct_pct: int = 65
    max_capital_pct: int = 5
    marks: str = "#$%&*|"             # ASCII


@dataclass(frozen=True)
class Config:
    block_bytes: int = 4 << 20        # text of a block, about, or one longer text
    bucket_bytes: int = 16 << 20      # text whose distinct words fill one bucket, about


def words_of(w: tx.Words) -> pa.DictionaryArray:
    """The block's words as an Arrow dictionary."""
    size = w.end - w.start
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.start] += 1
    inside[w.end] -= 1
    stay = w.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    ends = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(stay)).dictionary_encode()


def local_matrix(w: tx.Words, buckets: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(dictionary by bucket, first word of each bucket, row pointers, columns, counts) of a block."""
    coded = words_of(w)
    known = coded.dictionary
    data, offsets = tx.column_bytes(known)
    bucket = (tx.hash_spans(data, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rows = len(w.first) - 1
    cell = w.row * max(1, len(known)) + place[coded.indices.to_numpy()]
    cell, count = np.unique(cell, return_counts=True)
    row, column = np.divmod(cell, max(1, len(known)))
    pointers = np.searchsorted(row, np.arange(rows + 1))
    return known.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(buckets + 1)), pointers, column, count


def _list(kind: pa.DataType, values) -> pa.ListArray:
    """One list that holds all ``values``."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(src: DataFrame, buckets: int, rules: Rules, config: Config) -> DataFrame:
    """One row per block of ``src`` (id, part, key, text)."""
    mark = np.isin(np.arange(256), list(rules.marks.encode()))

    def count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[offsets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = tx.column_bytes(batch.column(3))
            for a, b in tx.row_blocks(offsets, config.block_bytes):
                part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                known, first, pointers, column, counts = local_matrix(tx.words(part, at, lower=False), buckets)
                chars = np.diff(tx.heads(part)[at])
                docs = pa.StructArray.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(3)),
                     pa.array(100 * count(_CAPITAL[part], at) > rules.max_capital_pct * chars), pa.array(count(mark[part], at) > 0)],
                    names=["id", "part", "key", "capitals", "marks"])
                used = np.flatnonzero(np.diff(first))
                sent = pa.StructArray.from_arrays(
                    [pa.array(used), pa.array(first[used].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.append(first[used], len(known)).astype(np.int32)), known.cast(pa.string()))],
                    names=["bucket", "first", "words"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), _list(docs.type, docs), _list(pa.int32(), pointers.astype(np.int32)),
                     _list(pa.int32(), column.astype(np.int32)), _list(pa.int32(), counts.astype(np.int32)), _list(sent.type, sent)],
                    names=["block", "docs", "pointers", "columns", "counts", "sent"])
                block += 1
            tx.release()

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"block bigint, docs {_docs_type(kind)}, pointers array<int>, columns array<int>, counts array<int>, "
                               "sent array<struct<bucket bigint, first int, words array<string>>>")


def _docs_type(kind: str) -> str:
    return f"array<struct<id {kind}, part string, key binary, capitals boolean, marks boolean>>"


def _codes(sent: DataFrame, buckets: int) -> DataFrame:
    """Rows (block, bucket, first, codes), and (null, bucket, null, null, words) with each bucket's dictionary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 1):
            lists = group.column("words").combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            coded = lists.flatten().dictionary_encode()
            at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [group.column("block").combine_chunks(), group.column("bucket").combine_chunks(), group.column("first").combine_chunks(),
                 pa.ListArray.from_arrays(pa.array(at), coded.indices.cast(pa.int32())), pa.nulls(n, pa.list_(pa.string()))],
                names=["block", "bucket", "first", "codes", "words"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), group.column("bucket").combine_chunks().slice(0, 1), pa.nulls(1, pa.int32()),
                 pa.nulls(1, pa.list_(pa.int32())), _list(pa.string(), coded.dictionary)],
                names=["block", "bucket", "first", "codes", "words"])
            tx.release()

    dealt = sent.select("bucket", "block", "first", "words").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "block bigint, bucket bigint, first int, codes array<int>, words array<string>")


def _encoded(docs: DataFrame, id_col: str, text_col: str, part_col: str, rules: Rules, config: Config) -> tuple[DataFrame, DataFrame]:
    """Blocks with their codes, and the global dictionary."""
    ws = Workspace(docs.sparkSession, "filter-audit")
    text = F.coalesce(docs[text_col], F.lit(""))
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                      F.unhex(F.sha2(text, 256)).alias("key"), text.alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // config.bucket_bytes
    blocks = ws.put("blocks", _blocks(src, buckets, rules, config), big_rows=True)
    codes = ws.put("codes", _codes(blocks.select("block", F.explode("sent").alias("s")).select("block", "s.*"), buckets))
    back = codes.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "first", "codes")).alias("codes"))
    dictionary = codes.where("block is null").select("bucket", F.posexplode("words").alias("code", "word"))
    return (blocks.select("block", "docs", "pointers", "columns", "counts").join(back, "block", "left"),
            dictionary.select((F.shiftleft("bucket", 32) + F.col("code")).alias("column"), "word"))


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the batch, row pointers, global columns, counts) of each block of an encoded batch."""
    for i in range(batch.num_rows):
        pointers, columns, counts = (batch.column(c)[i].values.to_numpy() for c in (2, 3, 4))
        world = np.empty(int(columns.max()) + 1 if len(columns) else 0, np.int64)
        if len(columns):
            codes = batch.column(5)[i].values
            bucket, first = (codes.field(f).to_numpy() for f in (0, 1))
            for k, (b, f) in enumerate(zip(bucket.tolist(), first.tolist())):
                own = codes.field(2)[k].values.to_numpy()
                world[f:f + len(own)] = own.astype(np.int64) + (b << 32)
        yield i, pointers, world[columns], counts


def matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", rules: Rules | None = None,
           config: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix: CSR shards (ids, pointers, columns, counts) and the dictionary (column, word)."""
    encoded, dictionary = _encoded(docs, id_col, text_col, part_col, rules or Rules(), config or Config())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, pointers, columns, counts in _shards(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), _list(batch.column(1).type, batch.column(1)[i].values.field(0)),
                     _list(pa.int32(), pointers), _list(pa.int64(), columns), _list(pa.int32(), counts)],
                    names=["shard", "ids", "pointers", "columns", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    return encoded.mapInArrow(run, f"shard bigint, ids array<{kind}>, pointers array<int>, columns array<bigint>, counts array<int>"), dictionary


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", rules: Rules | None = None,
           config: Config | None = None) -> DataFrame:
    """One row per document: id, part, key of its text, n_words, n_distinct and filters A to D, from the CSR shards."""
    rules = rules or Rules()
    encoded, _ = _encoded(docs, id_col, text_col, part_col, rules, config or Config())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, pointers, _, counts in _shards(batch):
                total = np.concatenate([[0], np.cumsum(counts)])
                n_words, n_distinct = np.diff(total[pointers]), np.diff(pointers).astype(np.int64)
                rows = batch.column(1)[i].values
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(f) for f in range(3)), pa.array(n_words), pa.array(n_distinct), pa.array(n_words < rules.min_words),
                     pa.array(100 * n_distinct < rules.min_distinct_pct * n_words), rows.field(3), rows.field(4)],
                    names=["id", "part", "key", "n_words", "n_distinct", *FILTERS[:4]])

    kind = docs.schema[id_col].dataType.simpleString()
    return encoded.mapInArrow(run, f"id {kind}, part string, key binary, n_words bigint, n_distinct bigint, A boolean, B boolean, C boolean, D boolean")


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failures(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts (part, failed: bit set of filters, n, good, toxic) of judged rows."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    failed = sum((F.col(f).cast("int") * _bit(f) for f in FILTERS[:4]), F.lit(0))
    rows = rows.select("id", "part", "key", failed.alias("failed")).join(known, "id", "left")
    group = ["key", "part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # one row per id first: then the least id of a group knows how many rows bear it
    one = rows.groupBy(*group, "id").agg(F.count("*").alias("n"))
    some = one.groupBy("key", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    least = some.groupBy("key").agg(F.min("least").alias("first"))
    some = some.join(least, "key", "left")
    stay = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = F.array(F.struct(stay.alias("n"), F.col("failed").alias("failed")),
                   F.struct((F.col("n") - stay).alias("n"), (F.col("failed") + _bit("E")).alias("failed")))
    some = some.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*").where("n > 0")
    return some.groupBy("part", "failed").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                              F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """All orders and steps from :func:`failures`: at most 32 rows a part go in, 600 come out."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = (counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.array(*(F.lit(i) for i in range(1, 6)))))
            .withColumn("own", F.expr("substring(filter_order, step, 1)")))
    earlier = sum((F.when(F.locate(f, F.expr("substring(filter_order, 1, step - 1)")) > 0, _bit(f)).otherwise(0) for f in FILTERS), F.lit(0))
    bit = sum((F.when(F.col("own") == f, _bit(f)).otherwise(0) for f in FILTERS), F.lit(0))
    rows = rows.withColumn("bit", bit).withColumn("gone", F.col("failed").bitwiseAND(earlier) != 0).withColumn(
        "fails", F.col("failed").bitwiseAND(F.col("bit")) != 0)
    removed = F.col("fails") & ~F.col("gone")

    def total(which, value="n"):
        return F.sum(F.when(which, F.col(value)).otherwise(0)).cast("bigint")

    # of the 120 orders, each of a document's failing filters comes first among them in an equal share
    share = F.expr("n * (120 div greatest(bit_count(failed), 1))")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"), total(removed).alias("removed"),
        total(F.col("fails") & F.col("gone")).alias("redundant"), total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
        F.sum(F.when(F.col("fails"), share).otherwise(0)).cast("bigint").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                 rules: Rules | None = None, config: Config | None = None) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    ws = Workspace(docs.sparkSession, "filter-audit")
    return audit(ws.put("counts", failures(judged(docs, id_col, text_col, part_col, rules, config), labels, id_col)))
