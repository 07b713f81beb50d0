"""Near-duplicate classes (operator 3): one-permutation MinHash with optimal
densification, banded buckets, star-shaped candidate edges.

Texts are lower-cased (A-Z), cut into words and shingled by ``size`` words
(fewer words: the whole sequence is one shingle).  Documents with equal shingle
sets collapse into one class first.  Each class gets one permutation split into
``bands * rows`` bins; empty bins borrow from non-empty ones by a universal
hash; ``rows`` bins make a band bucket.  A bucket of n classes gives n-1 edges,
to a centre that the hash of (class, bucket) picks, so a class that shares
several buckets meets several centres.  Edges are confirmed on the full sets.

Stars alone could miss a link between two classes that are no centre of a
shared bucket.  So every bucket that still holds two components is compared in
blocks by signatures (one byte per bin); pairs of different components that can
reach the threshold are confirmed on the full sets too, in the task that finds
them.  No bucket is capped.

Chance that a pair at the threshold 0.75 shares no bucket: 2.3e-6, less above.

Defined results: a null text, or one without words, has an empty set and is
linked with nothing.  Rows that share an id are one document: every row is
returned, links of any of them count.  A row without an id belongs to the class
of equal sets if that has an id and isn't kept; else its component is null and
it is kept.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import bloom
from millrace.llm import text as tx
from millrace.llm.scratch import Workspace, sorted_groups


@dataclass(frozen=True)
class Config:
    size: int = 5                # words of a shingle
    percent: int = 75            # link at 100 * intersection >= percent * union
    bands: int = 48
    rows: int = 5
    block: int = 1024            # classes compared at once in a mixed bucket
    slack: float = 0.13          # signatures may fall this far below the threshold (over 4.5 sigma)
    filter_segments: int = 32    # of 128 KB: narrows the second read of the texts


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, grouped by row, and their row ranges."""
    w = tx.words(data, offsets, lower=True)
    h, count = w.hashes(), w.count()
    key, at = tx.windows(h, w.row, size)
    keys, rows = [key], [w.row[at]]
    for n in range(1, size):
        if (count == n).any():
            key, at = tx.windows(h, w.row, n)
            short = count[w.row[at]] == n
            keys.append(key[short])
            rows.append(w.row[at[short]])
    key, row = np.concatenate(keys), np.concatenate(rows)
    tagged = tx.mix(key ^ (row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    order = np.argsort(tagged)
    fresh = np.ones(len(order), bool)
    fresh[1:] = tagged[order[1:]] != tagged[order[:-1]]
    pick = order[fresh]
    pick = pick[np.argsort(row[pick], kind="stable")]
    return key[pick], np.searchsorted(row[pick], np.arange(len(offsets)))


def signatures(key: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """Bin minima of each row; empty bins hold the value of the bin that their probes reach first."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    m = np.full(n * bins, none, np.uint64)
    h = tx.mix(key ^ np.uint64(0x5851F42D4C957F2D))
    np.minimum.at(m, row * bins + ((h >> np.uint64(32)) % np.uint64(bins)).astype(np.int64), h & np.uint64(0xFFFFFFFF))
    m = m.reshape(n, bins)
    sig = m.copy()
    at_row, at_bin = np.nonzero((m == none) & (np.diff(first) > 0)[:, None])
    t = 0
    while len(at_row):
        t += 1
        probe = tx.mix(at_bin.astype(np.uint64) * np.uint64(0x100000001) + np.uint64(t << 20)) % np.uint64(bins)
        got = m[at_row, probe.astype(np.int64)]
        sig[at_row, at_bin] = got
        left = got == none
        at_row, at_bin = at_row[left], at_bin[left]
    return sig


def _sketches(docs: DataFrame, config: Config) -> DataFrame:
    """id, n_shingles, set fingerprint (two longs), band buckets, signature bytes."""
    bins = config.bands * config.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                key, first = shingles(data, offsets, config.size)
                n = b - a
                prints = []
                for salt in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F):
                    total = np.zeros(len(key) + 1, np.uint64)
                    np.cumsum(tx.mix(key ^ np.uint64(salt)), out=total[1:])
                    prints.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
                sig = signatures(key, first, bins)
                band = np.zeros((n, config.bands), np.uint64) + np.arange(1, config.bands + 1, dtype=np.uint64)
                for r in range(config.rows):
                    band = tx.mix(band) ^ sig.reshape(n, config.bands, config.rows)[:, :, r]
                band = tx.mix(band).view(np.int64)
                tiny = (tx.mix(sig) & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(np.diff(first)), *map(pa.array, prints),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * config.bands), pa.array(band.reshape(-1))),
                     pa.array([x.tobytes() for x in tiny], pa.binary())],
                    names=["id", "n_shingles", "print_a", "print_b", "buckets", "signature"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n_shingles bigint, print_a bigint, print_b bigint, "
                                "buckets array<bigint>, signature binary")


def _sets(docs: DataFrame, bits: np.ndarray, config: Config) -> DataFrame:
    """Full shingle sets of the documents whose id the filter holds (a few more do no harm)."""
    probes = 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            batch = batch.filter(pa.array(bloom.contains(bits, key, probes)))
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                got, first = shingles(data, offsets, config.size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(got.view(np.int64)))],
                    names=["id", "shingles"])

    return (docs.select("id", "text", F.xxhash64("id").alias("key"))
            .mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, shingles array<bigint>"))


def _confirmed(pairs: DataFrame, sets: DataFrame, config: Config) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    small, large = F.least(F.size("set_a"), F.size("set_b")), F.greatest(F.size("set_a"), F.size("set_b"))
    return (pairs.join(one, "a").join(two, "b").where(100 * small >= config.percent * large)
            .withColumn("n", both).where(100 * F.col("n") >= config.percent * (F.size("set_a") + F.size("set_b") - F.col("n")))
            .select("a", "b"))


def components(ws: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(id, component): smallest id reachable, for every id in ``links`` (a, b),
    by alternating large and small stars on written edge tables."""
    def totals(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = ws.put(f"{name}_0", links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    now, k = totals(edges), 0
    while now[0]:
        k += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        edges = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = ws.put(f"{name}_{k}a", edges)
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = (edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges, before = ws.put(f"{name}_{k}", small), now
        ws.drop(f"{name}_{k - 1}", f"{name}_{k}a")
        now = totals(edges)
        if now == before:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` of buckets with ``n`` members, dealt out as pairs of blocks of about ``size``."""
    blocks = F.ceil(F.col("n") / size).cast("bigint")
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(17)), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))))
    rest = [c for c in rows.columns if c not in ("bucket", "block", "other", "n")]
    rows = rows.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", *rest)
    return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def _open_pairs(group: pa.Table, config: Config) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): pairs of different components that only this bucket decides on
    (it is the first they share, neither is its centre) and whose signatures
    can reach the threshold."""
    bins = config.bands * config.rows
    least = (config.percent / 100 - config.slack) * bins
    sig = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, bins)
    shared = group["buckets"].combine_chunks().flatten().to_numpy().reshape(-1, config.bands)
    label, ids, block = group["component"].to_numpy(), group["id"].to_numpy(), group["block"].to_numpy()
    middle, bucket = ids == group["centre"].to_numpy(), group["bucket"][0].as_py()
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    right = np.flatnonzero((block == high) & ~middle)
    for i in np.flatnonzero((block == low) & ~middle):
        j = right[label[right] != label[i]]
        if low == high:
            j = j[j > i]
        j = j[(sig[j] == sig[i]).sum(axis=1) >= least]
        if len(j):
            j = j[shared[i][(shared[j] == shared[i]).argmax(axis=1)] == bucket]
        if len(j):
            yield i, j


def _mixed_links(ws: Workspace, mixed: DataFrame, sets: DataFrame, config: Config) -> DataFrame:
    """Links between components in buckets that hold several of them.

    ``mixed``: bucket, centre, id, component, n, buckets, signature.  Signatures
    show which members have open pairs; only those bring their sets to a second
    deal, where the pairs are confirmed in place, so only links leave a task."""
    kind = mixed.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            some = np.zeros(group.num_rows, bool)
            for i, j in _open_pairs(group, config):
                some[i] = True
                some[j] = True
            if some.any():
                yield from group.select(["bucket", "id"]).filter(pa.array(some)).to_batches()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            ids, full = group["id"].to_numpy(), {}
            links = []
            for i, js in _open_pairs(group, config):
                for k in (i, *js):
                    if k not in full:
                        full[k] = np.array(group["shingles"][int(k)].as_py(), np.int64)
                for j in js:
                    both = len(np.intersect1d(full[i], full[j], assume_unique=True))
                    if 100 * both >= config.percent * (len(full[i]) + len(full[j]) - both):
                        links.append((int(ids[i]), int(ids[j])))
            if links:
                x, y = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    active = ws.put("active", _dealt(mixed, config.block).mapInArrow(find, f"bucket bigint, id {kind}").distinct())
    size = active.groupBy("bucket").agg(F.count("*").alias("n"))
    whole = active.join(size, "bucket").join(mixed.drop("n"), ["bucket", "id"]).join(sets, "id")
    return _dealt(whole, config.block // 4).mapInArrow(confirm, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``."""
    config = config or Config()
    ws = Workspace(docs.sparkSession, "near-dups")
    src = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    sketches = ws.put("sketches", _sketches(src, config))
    full = sketches.where("n_shingles > 0")
    reps = ws.put("reps", full.groupBy("n_shingles", "print_a", "print_b")
                  .agg(F.min("id").alias("id"), F.any_value("buckets").alias("buckets"), F.any_value("signature").alias("signature")))
    spread = reps.select("id", F.explode("buckets").alias("bucket"))
    # the centre is the class with the least hash; partial minima keep hot buckets small
    stars = (spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("id", "bucket").alias("h"), "id")).alias("c"))
             .where("n > 1").select("bucket", "n", F.col("c.id").alias("centre")))
    members = ws.put("members", spread.join(stars, "bucket"))
    pairs = ws.put("pairs", members.where("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    ids = members.select(F.xxhash64("id").alias("key")).distinct()
    sets = ws.put("sets", _sets(src, bloom.build(ids, config.filter_segments, 4), config))
    links = ws.put("links", _confirmed(pairs, sets, config))
    first = ws.put("first", components(ws, links, "round1"))
    named = members.where("n > 2").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    mixed = ws.put("mixed", named.join(mixed, "bucket").join(reps.select("id", "buckets", "signature"), "id"))
    more = ws.put("more", _mixed_links(ws, mixed, sets, config))
    # the first round's components stand for its links
    last = components(ws, first.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), "round2")
    last = ws.put("components", last)
    classes = ws.put("classes", reps.select("n_shingles", "print_a", "print_b", "id").join(last, "id", "left")
                     .select("n_shingles", "print_a", "print_b", F.coalesce("component", "id").alias("component")))
    # what follows reads the sketches and the classes only
    ws.drop("reps", "members", "pairs", "sets", "links", "first", "mixed", "active", "more", "components")
    out = sketches.select("id", "n_shingles", "print_a", "print_b").join(classes, ["n_shingles", "print_a", "print_b"], "left")
    component = F.coalesce("component", "id")
    kept = F.coalesce(F.col("id") == component, component.isNull())
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """One document of each class, all columns unchanged.

    Rows that share an id but not their text are documents of their own here:
    they go by a hash of both (below zero), so that none is judged by another's
    text; of rows that share both one stays.  Only rows that may have to go
    (not kept, or repeated) are joined and shuffled; a bounded filter lets all
    others pass in place.  Rows without an id stay."""
    config = config or Config()
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession, "keep-one")
    key = docs[id_col].cast("bigint")
    often = ws.put("often", docs.select(key.alias("id")).where("id is not null").groupBy("id").count().where("count > 1").select("id"))
    # the caller's columns travel as one struct, so that no name clashes
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    if often.limit(1).count():
        rows = _own_names(rows, bloom.build(often.select(F.xxhash64("id").alias("key")), config.filter_segments, 4))
    classes = near_duplicates(rows.select("id", "text"), "id", "text", config).where("id is not null")
    suspects = ws.put("suspects", classes.groupBy("id").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).where("n > 1 or not kept"))
    bits = bloom.build(suspects.select(F.xxhash64("id").alias("key")), config.filter_segments, 4)
    marked = _met(rows.select("row", "id"), bits)
    judged = marked.where("met and id is not null").join(suspects, "id", "left").where("coalesce(kept, true)")
    once = judged.where("n is null or n = 1").select("row").unionByName(judged.where("n > 1").dropDuplicates(["id"]).select("row"))
    return marked.where("not met or id is null").select("row").unionByName(once).select("row.*")


def _met(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """``rows`` with ``met``: the filter (of hashed ids) may hold the row's id."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)
    keyed = rows.withColumn("met", F.xxhash64("id"))
    last = len(keyed.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(last).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(bloom.contains(sent.value, key, 4))], names=batch.schema.names)

    return keyed.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("met", T.BooleanType())]))


def _own_names(rows: DataFrame, often: np.ndarray) -> DataFrame:
    """``rows`` with a hash of id and text as the id of those whose id is repeated."""
    own = F.xxhash64("id", "text").bitwiseOR(F.lit(-(1 << 63)))
    return _met(rows, often).withColumn("id", F.when(F.col("met") & F.col("id").isNotNull(), own).otherwise(F.col("id"))).drop("met")
