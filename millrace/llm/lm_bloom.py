"""Language-model scoring with a log-frequency Bloom filter (operator 1).

Texts are lower-cased (A-Z) words followed by one end token; a text's n-grams
run over end, words, end.  Counts of 1- to ``order``-grams are exact, over all
training texts, and every n-gram that occurs enters the filter: no threshold,
so what the model holds grows with the input.

Counts are quantised: level q stands for the whole numbers from base**(q-1) to
below base**q.  The filter holds (n-gram, 1) ... (n-gram, q); a lookup probes
levels 1, 2, ... until one is missing.  The probability of a token is
interpolated over the orders whose context the filter knows: an order gives
(least count of the n-gram's level - ``discount``) / greatest count of the
context's, so no context gets more than its mass and n-grams seen once count
little; unigrams use the mean count of their level; a word outside the filter is
the unknown one.

The filter is cut into segments by ranges of the keys, one per ``segment_bytes``
of text.  A task sums the n-grams of a block of text, sorts them, and sends each
segment one packed row of all orders, so a common n-gram is one entry per block
wherever it goes.  A filter of at most ``capacity`` entries is broadcast and texts
are scored where they lie.  Above, a segment is probed where it is built: every
distinct n-gram once, and each block gets a byte of level back for each of its
n-grams, in the order sent.  Both ways give the same scores.  Rows sent are blocks
times segments, at most one per n-gram of a block.

The filter takes 48 bits of a longer n-gram's key: with 5e9 n-grams an absent one
has another's key in 2e-5 of the cases, far below the 3e-3 in which its probes are
all set.  Words are told apart by 63 bits.  The base score is exact: words' counts
travel with their levels.

Defined results: a null or empty text is its end token alone.  Every row gets
its own result, repeated rows too.  No training rows: N and V are 0, the only
event is the unknown word.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import shared
from millrace.llm import text as tx
from millrace.llm.scratch import Workspace, sorted_groups

END = np.uint64(0x5DEECE66D1CEB00C)      # the end token's hash
SENT_BYTES = 1 << 22                     # packed rows handed to Spark at once
MOST_TASKS = 1 << 14                     # segments beyond it share tasks, one after the other


@dataclass(frozen=True)
class Config:
    order: int = 3
    capacity: int = 1 << 22          # most entries of a filter that is broadcast (how, not what: same scores)
    segment_bytes: int = 1 << 24     # text for which there is a segment
    block_bytes: int = 1 << 23       # text whose n-grams are summed and looked up together
    base: float = 1.5                # counts of one level differ by at most this factor
    bits_per_entry: int = 12
    probes: int = 8
    weights: tuple = (0.2, 0.15)     # of the 2-gram, 3-gram, ... estimates
    discount: float = 0.75           # taken off an n-gram's count
    smooth: float = 0.1


def sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each row with an end token before and after, and their rows."""
    w = tx.words(data, offsets, lower=True)
    row = np.repeat(np.arange(len(offsets) - 1), w.count() + 2)
    seq = np.full(len(row), END, np.uint64)
    seq[np.arange(len(w.start)) + 2 * w.row + 1] = w.hashes()
    return seq, row


def grams(seq: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first tokens) of an order's n-grams; the lowest bit of a key is free."""
    if order == 1:
        return seq & ~np.uint64(1), np.arange(len(seq))
    key, at = tx.windows(seq, row, order)
    return key & ~np.uint64((1 << 16) - 1), at


def planes(a: np.ndarray) -> bytes:
    """Bytes of whole numbers, equal places together (most are zero)."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack(key: np.ndarray) -> bytes:
    """Ascending uint64 keys as differences."""
    return planes(np.diff(key, prepend=np.uint64(0)))


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, np.uint64), dtype=np.uint64)


def level_key(key: np.ndarray, order: int, level: int) -> np.ndarray:
    """What the filter holds for an n-gram's level."""
    return tx.mix(key ^ tx.mix(np.array([level + 1000 * order], np.uint64)))


def level_of(n: np.ndarray, base: float) -> np.ndarray:
    return (np.floor(np.log(np.maximum(n, 1)) / np.log(base) + 1e-9) + 1).astype(np.int64)


def segment_bits(key: np.ndarray, n: np.ndarray, order: int, config: Config) -> tuple[int, np.ndarray]:
    """(entries, bit array) of one segment's n-grams and counts."""
    q = level_of(n, config.base)
    entries = int(q.sum())
    bits = np.zeros(max(1, -(-entries * config.bits_per_entry // 8)) * 8, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        a = tx.mix(level_key(key[q >= level], order, level))
        b = tx.mix(a) | np.uint64(1)
        for k in range(config.probes):
            bits[((a + np.uint64(k) * b) >> np.uint64(20)) % np.uint64(len(bits))] = True
    return entries, np.packbits(bits)


class Filter:
    """Levels of n-grams by repeated probes, one list of segments per order."""

    def __init__(self, config: Config, cuts: int):
        self.config, self.cuts, self.orders = config, cuts, {}

    def hold(self, order: int, segments: dict[int, np.ndarray]) -> None:
        """The bit arrays of an order's segments (those that have entries)."""
        parts = [segments.get(k, np.zeros(1, np.uint8)) for k in range(1 << self.cuts)]
        size = np.array([8 * len(x) for x in parts], np.uint64)
        self.orders[order] = np.concatenate(parts), np.cumsum(size) - size, size

    def probe(self, key: np.ndarray, order: int) -> np.ndarray:
        """Level of each key (0: not in the model)."""
        flat, begin, size = self.orders[order]
        part = (key >> np.uint64(64 - self.cuts)).astype(np.int64) if self.cuts else np.zeros(len(key), np.int64)
        out = np.zeros(len(key), np.uint8)
        left, level = np.arange(len(key)), 1
        while len(left):
            a = tx.mix(level_key(key[left], order, level))
            b = tx.mix(a) | np.uint64(1)
            for _ in range(self.config.probes):
                at = (a >> np.uint64(20)) % size[part[left]] + begin[part[left]]
                hit = (flat[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
                left, a, b = left[hit], a[hit], b[hit]
                a = a + b
            out[left] = level
            level += 1
        return out


def merged(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, ascending, how many of each) of keys marked in the lowest bit."""
    key = np.sort(key)
    plain = key & ~np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], plain[1:] != plain[:-1]]))
    return plain[first], np.add.reduceat((key & np.uint64(1)).astype(np.uint32), first, dtype=np.uint32)


def spread(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each key, from those of the distinct keys in ascending order."""
    order = np.argsort(key)
    held = key[order]
    group = np.cumsum(np.concatenate([[False], held[1:] != held[:-1]]))
    out = np.empty(len(key), value.dtype)
    out[order] = value[group]
    return out


ASKED = "slot bigint, block bigint, keys array<binary>, counts array<binary>"


def _lists(rows: list[list[bytes]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.binary()))


def packed_rows(block: int, seq: np.ndarray, row: np.ndarray, teach: np.ndarray, cuts: int, order: int) -> Iterator[tuple]:
    """(slot, block, keys by order, counts in training texts by order) of a block, ascending by segment."""
    mark = teach[row]
    first = np.concatenate([[True], row[1:] != row[:-1]])     # the end token before a text is no token of its own
    held = []
    for n in range(1, order + 1):
        key, at = grams(seq, row, n)
        if len(key):
            held.append(merged(key | (mark & ~first if n == 1 else mark[at]).astype(np.uint64)))
        else:
            held.append((np.empty(0, np.uint64), np.empty(0, np.uint32)))
    lows = np.arange(1 << cuts, dtype=np.uint64) << np.uint64(64 - cuts) if cuts else np.zeros(1, np.uint64)
    edge = [np.append(np.searchsorted(key, lows), len(key)) for key, _ in held]
    for slot in np.flatnonzero(np.diff(edge).sum(axis=0)).tolist():
        parts = [(key[e[slot]:e[slot + 1]], n[e[slot]:e[slot + 1]]) for (key, n), e in zip(held, edge)]
        yield slot, block, [pack(key) for key, _ in parts], [planes(n) for _, n in parts]


def in_batches(rows: Iterator[tuple], size) -> Iterator[list[tuple]]:
    """Lists of rows of about ``SENT_BYTES``."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += size(r)
        if n >= SENT_BYTES:
            yield held
            held, n = [], 0
    if held:
        yield held


def _blocks(src: DataFrame, kind: str, config: Config) -> DataFrame:
    """Rows of ``src`` (id, text, teach) in blocks: one row of lists each, named by its first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, held, size = TaskContext.get().partitionId() << 33, [], 0

        def listed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ends = pa.array([0, len(table)], pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.ListArray.from_arrays(ends, x.combine_chunks()) for x in table.columns)],
                                              names=["block", "ids", "texts", "teach"])

        for batch in batches:
            _, offsets = tx.column_bytes(batch.column(1))
            for a, b in tx.row_blocks(offsets, config.block_bytes):
                step = int(offsets[b] - offsets[a])
                if held and size + step > config.block_bytes:
                    yield listed()
                    block += sum(x.num_rows for x in held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += step
        if held:
            yield listed()

    return src.mapInArrow(run, f"block bigint, ids array<{kind}>, texts array<string>, teach array<boolean>")


def _asked(blocks: DataFrame, cuts: int, config: Config) -> DataFrame:
    """What blocks (block, texts, teach) send the segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seq, row = sequences(*tx.column_bytes(batch.column(1)[i].values))
                rows = packed_rows(batch.column(0)[i].as_py(), seq, row, batch.column(2)[i].values.to_numpy(zero_copy_only=False), cuts, config.order)
                for some in in_batches(rows, lambda r: sum(map(len, r[2]))):
                    slot, of, keys, counts = map(list, zip(*some))
                    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(of, pa.int64()), _lists(keys), _lists(counts)],
                                                     names=["slot", "block", "keys", "counts"])
                del seq, row, rows
                tx.release()

    return blocks.select("block", "texts", "teach").mapInArrow(run, ASKED)


TOLD = ("slot bigint, block bigint, levels array<binary>, counts binary, entries array<bigint>, tokens bigint, types bigint, "
        "grams array<bigint>, total array<bigint>, bits array<binary>, words binary")


def _told(asked: DataFrame, cuts: int, config: Config, answers: bool) -> DataFrame:
    """A row on each segment (block -1: sums, and its bits and words unless there are
    answers) and, with answers, one for each block that asked it."""
    names = [x.split()[0] for x in TOLD.split(", ")]

    def segment(slot: int, group: pa.Table) -> Iterator[tuple]:
        blocks = group.column(1).to_pylist()
        levels, counts, about, bits, words = [[] for _ in blocks], None, [], [], b""
        for n in range(1, config.order + 1):
            parts = [unpack(x[n - 1].as_py()) for x in group.column(2)]
            key = np.concatenate(parts)
            times = np.concatenate([from_planes(x[n - 1].as_py(), np.uint32) for x in group.column(3)])
            ends = np.cumsum([len(x) for x in parts])[:-1]
            order = np.argsort(key)
            held = key[order]
            fresh = np.concatenate([[True], held[1:] != held[:-1]])[:len(held)]
            first = np.flatnonzero(fresh)
            total = np.add.reduceat(times[order].astype(np.int64), first) if len(first) else np.empty(0, np.int64)
            held, group_of = held[first], np.cumsum(fresh) - 1
            seen = total > 0
            entries, own = segment_bits(held[seen], total[seen], n, config)
            about.append(entries)
            if n == 1:
                q = level_of(total[seen], config.base)
                sums = (int(total.sum()), int(seen.sum()), np.bincount(q).tolist(), np.bincount(q, weights=total[seen]).astype(np.int64).tolist())
            if not answers:
                bits.append(own.tobytes())
                if n == 1:
                    words = pack(held[seen]) + planes(total[seen])
                continue
            f = Filter(config, 0)
            f.hold(n, {0: own})
            level = f.probe(held, n)
            back = np.empty(len(key), np.int64)
            back[order] = group_of
            for mine, x in zip(levels, np.split(level[back], ends)):
                mine.append(x.tobytes())
            if n == 1:
                counts = [planes(x) for x in np.split(total[back], ends)]
        yield slot, -1, None, None, about, *sums, bits, words
        if answers:
            for block, level, count in zip(blocks, levels, counts):
                yield slot, block, level, count, None, None, None, None, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
        for group in sorted_groups(batches, 1):
            rows = segment(group.column(0)[0].as_py(), group)
            for some in in_batches(rows, lambda r: sum(map(len, (r[2] or []) + (r[9] or []))) + len(r[3] or b"")):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*some), types)], names=names)
            del group, rows
            tx.release()

    tasks = min(1 << cuts, MOST_TASKS)
    return (asked.repartitionById(tasks, (F.col("slot") % tasks).cast("int")).sortWithinPartitions("slot", "block")
            .mapInArrow(run, TOLD))


@dataclass
class Model:
    """What the corpus taught: sums, and for a corpus small enough the filter and the words' exact counts."""
    config: Config
    tokens: int                  # N
    types: int                   # V
    level_mean: np.ndarray       # unigrams: mean count by level
    filter: Filter | None = None
    word_key: np.ndarray | None = None       # ascending
    word_count: np.ndarray | None = None

    def base_logs(self, count: np.ndarray) -> np.ndarray:
        smooth = self.config.smooth
        return np.log10((count + smooth) / (self.tokens + smooth * (self.types + 1)))

    def token_logs(self, row: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every token (0 for the end tokens before texts);
        ``levels``: by order, those of the n-grams beginning at each token."""
        c, n_all = self.config, len(row)
        floor = self.tokens + c.smooth * (self.types + 1)
        by_level = np.concatenate([[c.smooth / floor], self.level_mean[1:] / floor])
        held = levels[0]
        p = by_level[np.minimum(held, len(by_level) - 1)]
        # counts of a level are whole numbers
        q = np.arange(256.0)
        low = np.where(q > 0, np.ceil(c.base ** np.minimum(q - 1, 200) - 1e-6), 0)
        high = np.where(q > 0, np.ceil(c.base ** np.minimum(q, 200) - 1e-6) - 1, np.inf)
        gain = np.minimum(1, np.maximum(0, low - c.discount)[:, None] / np.maximum(high, 1)[None, :])
        for n in range(2, c.order + 1):
            k = n_all - n + 1
            if k <= 0:
                break
            known = (row[:k] == row[n - 1:]) & (held[:k] > 0)
            own = np.where(known & (held[1:k + 1] > 0), levels[n - 1][:k], 0)
            share = np.where(known, c.weights[n - 2], 0.0)
            p[n - 1:] = (1 - share) * p[n - 1:] + share * gain[own, held[:k]]
            held = np.append(own, np.zeros(n - 1, own.dtype))
        logs = np.log10(p)
        logs[np.concatenate([[True], row[1:] != row[:-1]])] = 0
        return logs


def _sums(told: DataFrame, config: Config) -> tuple[Model, int]:
    """The model's sums and the filter's entries, from the rows on segments."""
    about = told.where(F.col("block") == -1)
    r = about.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v"),
                  F.sum(F.expr("aggregate(entries, 0L, (a, x) -> a + x)")).alias("entries")).first()
    levels = (about.select(F.posexplode(F.arrays_zip("grams", "total")).alias("q", "x"))
              .groupBy("q").agg(F.sum("x.grams").alias("grams"), F.sum("x.total").alias("total")).collect())
    mean = np.zeros(max([r["q"] for r in levels], default=0) + 1)
    for x in levels:
        mean[x["q"]] = x["total"] / max(1, x["grams"])
    return Model(config, r["n"] or 0, r["v"] or 0, mean), r["entries"] or 0


def _put(ws: Workspace, name: str, df: DataFrame) -> DataFrame:
    """``ws.put``; what the write shuffled is removed with its end, not at some later collection."""
    conf, key = ws.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return ws.put(name, df)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def _source(docs: DataFrame, id_col: str, text_col: str, teach: Column) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.coalesce(teach, F.lit(False)).alias("teach"))


def _sizes(src: DataFrame, config: Config) -> tuple[int, int]:
    """(cuts of the key range, a bound on the entries of the training texts' filter):
    a count of n takes at most n levels, and a word has a byte and a blank after it."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    r = src.agg(F.sum(size).alias("all"), F.sum(F.when(F.col("teach"), F.floor((size + 1) / 2) + 1)).alias("tokens")).first()
    cuts = max(0, int(np.ceil(np.log2(max(1, (r["all"] or 0) / config.segment_bytes)))))
    return cuts, config.order * (r["tokens"] or 0)


def fit(docs: DataFrame, ws: Workspace, text_col: str = "text", config: Config | None = None) -> Model:
    """Learn from all rows of ``docs``; for corpora whose filter can be broadcast
    (others are learned and scored together by :func:`score_with`)."""
    config = config or Config()
    src = _source(docs, text_col, text_col, F.lit(True))
    cuts, _ = _sizes(src, config)
    told = _put(ws, "segments", _told(_asked(_blocks(src, "string", config), cuts, config), cuts, config, False))
    model, entries = _sums(told, config)
    if entries > config.capacity:
        raise ValueError(f"the filter has {entries} entries, more than the {config.capacity} that are broadcast; use score_with")
    got = told.select("slot", "bits", "words").orderBy("slot").collect()
    model.filter = Filter(config, cuts)
    for n in range(1, config.order + 1):
        model.filter.hold(n, {r["slot"]: np.frombuffer(r["bits"][n - 1], np.uint8) for r in got})
    half = [len(r["words"]) // 2 for r in got]
    model.word_key = np.concatenate([unpack(r["words"][:h]) for r, h in zip(got, half)] or [np.empty(0, np.uint64)])
    model.word_count = np.concatenate([from_planes(r["words"][h:], np.int64) for r, h in zip(got, half)] or [np.empty(0, np.int64)])
    return model


def _scored(m: Model, ids: pa.Array, row: np.ndarray, levels: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
    """A row for each text, from its tokens' levels and exact counts."""
    n = len(ids)
    own = np.concatenate([[False], row[1:] == row[:-1]])
    base = np.where(own, m.base_logs(count), 0.0)

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=x, minlength=n)

    return pa.RecordBatch.from_arrays(
        [ids, pa.array(per_text(own).astype(np.int64)), pa.array(per_text(own & (count > 0)).astype(np.int64)),
         pa.array(np.full(n, m.tokens)), pa.array(per_text(base)), pa.array(per_text(m.token_logs(row, levels)))], names=NAMES)


NAMES = ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _result(kind: str) -> str:
    return f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score."""
    sent = shared.share(docs.sparkSession, model)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.unpack(sent)
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                seq, row = sequences(data, offsets)
                levels = []
                for n in range(1, m.config.order + 1):
                    key, at = grams(seq, row, n)
                    levels.append(np.zeros(len(seq), np.uint8))
                    levels[-1][at] = spread(key, m.filter.probe(np.unique(key), n)) if len(key) else 0
                key = grams(seq, row, 1)[0]
                spot = np.minimum(np.searchsorted(m.word_key, key), max(0, len(m.word_key) - 1))
                count = np.where(m.word_key[spot] == key, m.word_count[spot], 0) if len(m.word_key) else np.zeros(len(key), np.int64)
                yield _scored(m, batch.column(0).slice(a, b - a), row, levels, count)

    return src.mapInArrow(run, _result(src.schema["id"].dataType.simpleString())).withColumnRenamed("id", id_col)


def score_with(docs: DataFrame, teach: Column, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """Score all rows of ``docs`` by the model of those that ``teach``, whatever the filter's size."""
    c = config or Config()
    src = _source(docs, id_col, text_col, teach)
    kind = src.schema["id"].dataType.simpleString()
    cuts, _ = _sizes(src, c)
    # written, so that both reads see the same blocks
    blocks = ws.put("blocks", _blocks(src, kind, c), big_rows=True, compression="zstd")
    told = _put(ws, "told", _told(_asked(blocks, cuts, c), cuts, c, True))
    sent = shared.share(docs.sparkSession, _sums(told, c)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.unpack(sent)
        for group in sorted_groups(batches, 1):
            ids, texts = (group.column(k)[0].values for k in (2, 3))
            n_texts = len(ids)
            seq, row = sequences(*tx.column_bytes(texts))
            told_levels, told_counts = (group.column(k).slice(1) for k in (4, 5))
            levels, count = [], None
            for n in range(1, c.order + 1):
                key, at = grams(seq, row, n)
                got = np.frombuffer(b"".join(x[n - 1].as_py() for x in told_levels), np.uint8)
                levels.append(np.zeros(len(seq), np.uint8))
                levels[-1][at] = spread(key, got) if len(key) else 0
                if n == 1:
                    count = spread(key, np.concatenate([from_planes(x.as_py(), np.int64) for x in told_counts]))
            # as many rows at once as without segments
            ends = np.searchsorted(row, np.arange(n_texts + 1))
            for a, b in tx.row_blocks(tx.column_bytes(texts)[1]):
                at = slice(int(ends[a]), int(ends[b]))
                yield _scored(m, ids.slice(a, b - a), row[at] - a, [x[at] for x in levels], count[at])
            del group
        tx.release()

    none = F.lit(None)
    texts = blocks.select("block", F.lit(-1).cast("bigint").alias("slot"), "ids", "texts", none.cast("array<binary>").alias("levels"),
                          none.cast("binary").alias("counts"))
    answers = told.where("block >= 0").select("block", "slot", none.cast(f"array<{kind}>").alias("ids"), none.cast("array<string>").alias("texts"),
                                              "levels", "counts")
    return (texts.union(answers).repartition("block").sortWithinPartitions("block", "slot")
            .mapInArrow(run, _result(kind)).withColumnRenamed("id", id_col))


def held_out(id_col: Column) -> Column:
    """crc32 of the id's decimal text, modulo 10, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 10 == 0


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> DataFrame:
    """Learn from the rows that aren't held out, score all rows."""
    config, ws = config or Config(), Workspace(docs.sparkSession, "lm")
    teach = ~held_out(docs[id_col])
    if _sizes(_source(docs, id_col, text_col, teach), config)[1] <= config.capacity:
        out = score(docs, fit(docs.where(teach), ws, text_col, config), id_col, text_col)
    else:
        out = score_with(docs, teach, ws, id_col, text_col, config)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
