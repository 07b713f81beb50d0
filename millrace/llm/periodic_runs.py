"""Periodic runs of words (operator 11).

A run is a stretch of consecutive words with smallest period q, at least
``max(min_length, 2 * q)`` long, that no neighbouring word extends keeping q.
In match space (positions i whose word equals word i + q) it is a maximal
stretch of at least ``max(q, min_length - q)`` positions.

Periods are dealt to octaves [2^k, 2^(k+1)).  For each octave a document is
exploded into tiles: a core of words with a halo of a few periods on both
sides.  Boundaries lie so close together that every long enough stretch holds
one with a short window after it; a tile is made only where such a window
recurs at a distance of the octave, so prose makes none.  Tiles are shuffled
as rows of their own and solved independently: at a boundary, a Z-function of
the words after it and one of the words before it give, for all periods at
once, how far the match reaches to either side.  A stretch that a halo cuts is
reported as a fragment; halos hold at least two periods, so each tile decides
alone whether a smaller period rules (q / p for a prime p; Fine and Wilf).
Fragments are shuffled by document and period and stitched where they meet.

Work is O(n log n) words whatever the texts repeat; no tile is longer than 20
times its longest period (or about ``core`` words), and a document's runs are
fewer than its words.

Defined results: a null or empty text has no words and no runs.  Repeated rows
are worked on as often as they occur.  A null id is kept.  Other columns,
whatever their names, are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.scratch import Workspace

CELLS = 1 << 20        # words compared at once (memory only)


@dataclass(frozen=True)
class Config:
    min_length: int = 12     # words of a run, at least; at least two periods anyway
    core: int = 4096         # words of a tile's core, at least
    task_words: int = 1 << 18    # words of tiles a task solves, about


@dataclass(frozen=True)
class Octave:
    """Geometry of the periods [low, high)."""

    low: int
    least: int       # positions of a stretch, at least
    step: int        # between boundaries
    window: int      # words that must recur after a boundary
    reach: int       # words seen to either side of a boundary
    core: int        # words of a tile's core

    @property
    def high(self) -> int:
        return 2 * self.low


def octave(k: int, config: Config) -> Octave:
    low = 1 << k
    least = min(max(q, config.min_length - q) for q in {low, 2 * low - 1, *range(low, min(2 * low, config.min_length))})
    step = max(1, least // 2)
    reach = max(4 * low, 2 * least)
    core = -(-max(8 * low, config.core) // step) * step
    return Octave(low, least, step, 8 if least - step + 1 >= 8 else max(1, min(4, least - step + 1)), reach, core)


def octaves(words: int, config: Config) -> list[Octave]:
    """Octaves whose smallest period fits twice into ``words``."""
    if words < config.min_length:
        return []
    return [octave(k, config) for k in range(max(1, words // 2).bit_length())]


def grams(h: np.ndarray, row: np.ndarray, n: int, pad: int) -> np.ndarray:
    """Hash of the n words from each position; 0 where the row or the padding ends them."""
    out = np.zeros(len(h) + pad, np.uint64)
    key, at = tx.windows(h, row, n)
    out[at] = key | np.uint64(1)
    return out


def candidates(gram: np.ndarray, bounds: np.ndarray, o: Octave) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(boundary, period) pairs whose windows recur up to the next boundary, in
    pieces of bounded size, boundaries ascending.

    ``gram`` is padded by ``o.high`` zeros at least.  The first window decides
    for all pairs; windows further on, at doubling distances, thin them out."""
    spread = np.lib.stride_tricks.sliding_window_view(gram, o.low)
    rows = max(1, CELLS // o.low)
    bounds = bounds[gram[bounds] != 0]
    span = o.least - o.step + 1          # matching words that follow a boundary of a long enough stretch
    ahead = [x for x in (8 << j for j in range(60)) if x < span - o.window] + [span - o.window]
    for a in range(0, len(bounds), rows):
        b = bounds[a:a + rows]
        i, q = np.nonzero(spread[b + o.low] == gram[b][:, None])
        at, period = b[i], q + o.low
        for x in ahead:
            keep = gram[at + x] == gram[at + x + period]
            at, period = at[keep], period[keep]
        if len(at):
            yield at, period


def tiles_of(w: tx.Words, h: np.ndarray, config: Config) -> dict[int, list[tuple[Octave, int, np.ndarray]]]:
    """row -> (octave, first word of the core, boundaries) of tiles with candidates."""
    sizes, out = w.count(), {}
    if not len(h):
        return out
    known: dict[int, np.ndarray] = {}
    for o in octaves(int(sizes.max()), config):
        rows = np.flatnonzero(sizes >= max(config.min_length, 2 * o.low))
        if o.window not in known:
            known[o.window] = grams(h, w.row, o.window, 0)
        gram = np.concatenate([known[o.window], np.zeros(2 * o.high + o.least, np.uint64)])
        # boundaries count from each row's first word
        count = -(-sizes[rows] // o.step)
        owner = np.repeat(rows, count)
        local = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * o.step
        met = [np.unique(at[at + period < w.first[w.row[at] + 1]]) for at, period in candidates(gram, w.first[owner] + local, o)]
        if not met:
            continue
        at = np.concatenate(met)
        row = w.row[at]
        local = at - w.first[row]
        cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(local // o.core) != 0)) + 1
        for part in np.split(np.arange(len(at)), cut):
            if len(part):
                first = int(local[part[0]]) // o.core * o.core
                out.setdefault(int(row[part[0]]), []).append((o, first, local[part]))
    return out


def z_array(x: list[int], limit: int) -> list[int]:
    """z[j]: words that x[j:] and x share at their starts, for j < limit (z[0] = len(x))."""
    n = len(x)
    z = [0] * min(limit, n)
    if z:
        z[0] = n
    a = b = 0
    for j in range(1, len(z)):
        v = min(z[j - a], b - j) if j < b else 0
        if j + v >= b:
            while j + v < n and x[v] == x[j + v]:
                v += 1
            a, b = j, j + v
        z[j] = v
    return z


def shared_prefix(pattern: list[int], z: list[int], x: list[int], limit: int) -> list[int]:
    """Words that x[j:] and ``pattern`` share at their starts, for j < limit; ``z`` belongs to the pattern."""
    n, m = len(x), len(pattern)
    out = [0] * min(limit, n)
    a = b = 0
    for j in range(len(out)):
        v = min(z[j - a], b - j) if j < b and j - a < len(z) else 0
        if j + v >= b:
            while v < m and j + v < n and pattern[v] == x[j + v]:
                v += 1
            a, b = j, j + v
        out[j] = v
    return out


def reach_at(x: np.ndarray, b: int, o: Octave) -> tuple[np.ndarray, np.ndarray, int, int]:
    """For each shift j < o.high: matches before and from boundary ``b`` (word i
    against word i + j), seen between the returned ends of the window."""
    lo, hi = max(0, b - o.reach), min(len(x), b + o.reach + o.high)
    after, before = np.zeros(o.high, np.int64), np.zeros(o.high, np.int64)
    got = z_array(x[b:hi].tolist(), o.high)
    after[:len(got)] = got
    back = x[lo:b][::-1].tolist()
    if back:
        end = min(len(x), b + o.high - 1)
        got = shared_prefix(back, z_array(back, o.high), x[lo:end][::-1].tolist(), end - b + 1)
        # reversed word j of the window ends the stretch before shift end - b - j
        before[:len(got)] = got[::-1]
    return before, after, lo, hi


def primes_of(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def solve(x: np.ndarray, bounds: np.ndarray, o: Octave, config: Config, open_left: bool, open_right: bool) -> list[tuple[int, int, int]]:
    """(period, first match, end of matches) of a tile's stretches and fragments.

    ``x`` are the tile's words, ``bounds`` positions in it; ``open_*`` tell that
    the document goes on beyond the tile's ends."""
    n = len(x)
    gram = grams(tx.mix(x.astype(np.uint64)), np.zeros(n, np.int64), o.window, 2 * o.high + o.least)
    settled = np.zeros(o.high, np.int64)         # period -> boundaries below need no further look
    out = []
    for at, period in candidates(gram, bounds, o):
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        for a, z in zip(first, [*first[1:], len(at)]):
            b, periods = int(at[a]), period[a:z]
            periods = periods[(settled[periods] <= b) & (b + periods < n)]
            if not len(periods):
                continue
            before, after, lo, hi = reach_at(x, b, o)
            for q in periods.tolist():
                u, v = b - int(before[q]), b + int(after[q])
                cut_left, cut_right = u == lo and (lo > 0 or open_left), v + q == hi and (hi < n or open_right)
                # a cut stretch is found again at a later boundary, whose window must still match
                settled[q] = v - o.step - o.window - o.least if cut_right else v
                if v - u < max(q, config.min_length - q) and not (cut_left or cut_right):
                    continue
                if any(b - before[q // p] <= u and b + q // p + after[q // p] >= v + q for p in primes_of(q)):
                    continue
                out.append((q, u, v))
    return out


def _tile_rows(w: tx.Words, h: np.ndarray, config: Config) -> Iterator[tuple]:
    for row, tiles in sorted(tiles_of(w, h, config).items()):
        a, z = int(w.first[row]), int(w.first[row + 1])
        code = np.unique(h[a:z], return_inverse=True)[1].astype(np.int32)
        for o, first, bounds in tiles:
            lo = max(0, first - o.reach)
            hi = min(z - a, first + o.core + o.reach + o.high)
            yield (row, o.low, lo, hi < z - a, code[lo:hi], (bounds - lo).astype(np.int32))


def joined(data: np.ndarray, w: tx.Words, keep: np.ndarray | None = None) -> pa.LargeStringArray:
    """The words (those of ``keep``) of each row, joined by one space."""
    rows = len(w.first) - 1
    at = np.arange(len(w.start)) if keep is None else np.flatnonzero(keep)
    start, end, row = w.start[at], w.end[at], w.row[at]
    more = np.r_[row[1:] == row[:-1], False] if len(at) else np.empty(0, bool)
    edge = np.zeros(len(data) + 1, np.int32)
    edge[start] += 1
    np.add.at(edge, end + more, -1)          # a blank stays after each word but a row's last
    stay = np.cumsum(edge[:-1]) > 0
    data = data.copy()
    data[end[more]] = 0x20
    size = np.bincount(row, weights=end - start + more, minlength=rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(data[stay]))


TILE = "array<struct<octave int, first int, open boolean, words array<int>, bounds array<int>>>"
RUNS = "array<struct<start bigint, length bigint, period bigint>>"


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32), pa.int32()))


def _tile_lists(tiles: list[tuple], rows: int) -> pa.ListArray:
    """``tiles`` (row, octave, first, open, words, bounds), ascending by row, as one list per row."""
    cols = list(zip(*tiles)) if tiles else [[] for _ in range(6)]
    made = pa.StructArray.from_arrays(
        [pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_()), _lists(list(cols[4])), _lists(list(cols[5]))],
        names=["octave", "first", "open", "words", "bounds"])
    offsets = np.searchsorted(np.array(cols[0], np.int64), np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), made)


def _split(docs: DataFrame, id_col: str, text_col: str, config: Config) -> DataFrame:
    """Rows (key, id, text: words joined by one space, hot: there are tiles, load: their words, tiles)."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                w = tx.words(data, offsets, lower=False)
                tiles = list(_tile_rows(w, w.hashes(), config))
                load = np.zeros(b - a, np.int64)
                np.add.at(load, np.array([t[0] for t in tiles], np.int64), np.array([len(t[4]) for t in tiles], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(key, key + b - a)), batch.column(0).slice(a, b - a), joined(data, w).cast(pa.string()),
                     pa.array(load > 0), pa.array(load), _tile_lists(tiles, b - a)], names=["key", "id", "text", "hot", "load", "tiles"])
                key += b - a

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"key bigint, id {kind}, text string, hot boolean, load bigint, tiles {TILE}")


def _fragments(tiles: DataFrame, config: Config) -> DataFrame:
    """Rows (key, period, first, stop) in match space, of tiles (key, octave, first, open, words, bounds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, low, first, more, words, bounds = (batch.column(i) for i in range(6))
            out = []
            for i in range(batch.num_rows):
                at, o = first[i].as_py(), octave(low[i].as_py().bit_length() - 1, config)
                x = words[i].values.to_numpy(zero_copy_only=False)
                for q, u, v in solve(x, bounds[i].values.to_numpy(zero_copy_only=False).astype(np.int64), o, config, at > 0, more[i].as_py()):
                    out.append((key[i].as_py(), q, at + u, at + v))
            cols = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(cols[:, i]) for i in range(4)], names=["key", "period", "begin", "stop"])

    return tiles.select("key", "octave", "first", "open", "words", "bounds").mapInArrow(
        run, "key bigint, period bigint, begin bigint, stop bigint")


def stitch(fragments: DataFrame, config: Config) -> DataFrame:
    """Runs (key, start, length, period): fragments of a document and period that meet are one stretch."""
    order = Window.partitionBy("key", "period").orderBy("begin", "stop")
    seen = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("begin") <= seen, 0).otherwise(1)
    stretch = (fragments.withColumn("fresh", fresh).withColumn("part", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy("key", "period", "part").agg(F.min("begin").alias("start"), F.max("stop").alias("stop")))
    return (stretch.where(F.col("stop") - F.col("start") >= F.greatest(F.col("period"), config.min_length - F.col("period")))
            .select("key", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period"))


def _collapse(hot: DataFrame) -> DataFrame:
    """``text`` of rows (id, text, runs) without the words that runs repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                w = tx.words(data, offsets, lower=False)
                edge = np.zeros(len(w.start) + 1, np.int64)
                for i, runs in enumerate(batch.column(2).slice(a, b - a)):
                    if runs.is_valid and len(runs.values):
                        start, length, period = (runs.values.field(f).to_numpy(zero_copy_only=False) for f in range(3))
                        np.add.at(edge, w.first[i] + start + period, 1)
                        np.add.at(edge, w.first[i] + start + length, -1)
                text = joined(data, w, np.cumsum(edge[:-1]) == 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), text.cast(pa.string())],
                                                 names=["id", "runs", "collapsed"])

    kind = hot.schema["id"].dataType.simpleString()
    return hot.select("id", "text", "runs").mapInArrow(run, f"id {kind}, runs {RUNS}, collapsed string")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """One row per input row: id, ``runs`` (by start, then period) and
    ``collapsed``, the words outside the runs' repeated parts, joined by one space."""
    config = config or Config()
    ws = Workspace(docs.sparkSession, "periodic-runs")
    split = ws.put("split", _split(docs, id_col, text_col, config))
    hot = split.where("hot")
    tiles = hot.select("key", F.explode("tiles").alias("t")).select("key", "t.*")
    # a long document's tiles go to many tasks; tasks are counted by words, not bytes (which compress well)
    load = hot.agg(F.sum("load")).first()[0] or 0
    tiles = tiles.repartition(1 + load // config.task_words, "key", "octave", "first")
    runs = stitch(_fragments(tiles, config), config).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = runs.withColumn("runs", F.transform("runs", lambda r: F.struct(r.start, r.length, r.period)).cast(RUNS))
    rest = split.where("not hot").select("id", F.array().cast(RUNS).alias("runs"), F.col("text").alias("collapsed"))
    found = hot.select("key", "id", "text").join(runs, "key", "left")
    found = found.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    return _collapse(found).unionByName(rest).withColumnRenamed("id", id_col)
