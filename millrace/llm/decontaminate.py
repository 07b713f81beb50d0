"""Benchmark decontamination (operator 5) by latent semantic retrieval.

1.  Document frequencies of hashed words over all documents give the TF-IDF
    weights.
2.  A randomised SVD (random range, power iterations, QR) of TF-IDF passages:
    the benchmark's passages and all passages of all documents
    (``passage_words`` words each), both as heavy.  Products with the passage matrix
    run as Spark tasks over all of them; the driver only receives their sum.
3.  Every document is read whole.  Overlapping windows of 16, 32, 64 and 128
    words are projected and compared with the projected benchmark passages of
    that length; a window is a candidate when its cosine is at least
    ``least_cosine`` and it reaches ``least_share`` of the passage's own mass.
    Passages of which the basis keeps less than ``least_kept`` are candidates
    wherever ``least_words`` of their words stand in a row, too.
4.  Candidates are verified on words: longest common subsequence against the
    passage, and for paraphrases the passage's answer (its last sentence).

The benchmark is taken in blocks of at most ``block_items`` items, so that what
is broadcast has a bound.  Result: one row per (document, item) found.

Defined results: null or empty texts contain nothing; items with fewer than
``least_words`` words are not searched; items up to ``exact_words`` words must
occur whole.  Repeated rows give repeated findings once per id.  Other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.scratch import Workspace, sorted_groups
from millrace.llm.shared import share, unpack


@dataclass(frozen=True)
class Config:
    buckets_log2: int = 15
    rank: int = 64
    oversample: int = 8
    power_iterations: int = 2
    sample_passages: int | None = None       # no effect: the basis is fitted on all passages
    passage_words: int = 64       # words of a corpus passage (255 at most)
    piece_words: int = 1 << 13    # words of passages that travel together
    task_passages: int = 400_000  # passages a task multiplies (8 tasks at least)
    least_kept: float = 0.45      # of an item's TF-IDF length in the basis; others are also looked up by runs of words
    block_items: int = 20_000
    hop: int = 4                  # words; windows begin at hops of a quarter of their length
    longest: int = 128            # words of a window
    least_words: int = 5
    exact_words: int = 8
    least_cosine: float = 0.25
    least_share: float = 0.45
    copy: float = 0.65            # common subsequence, as a part of the passage's words
    paraphrase: float = 0.45      # the same, when the answer is there too
    answer: float = 0.6           # part of the answer's words


def _words(column_or_data, offsets=None) -> tx.Words:
    return tx.words(column_or_data, offsets, lower=True, blank=tx.NOT_WORD)


def _bucket(h: np.ndarray, config: Config) -> np.ndarray:
    return (h >> np.uint64(64 - config.buckets_log2)).astype(np.int64)


def _passage_sizes(first: np.ndarray, words: int) -> np.ndarray:
    """Words of each passage when every text (words first[i] .. first[i + 1] - 1) is cut every ``words`` words."""
    n = np.diff(first)
    n = n[n > 0]
    count = -(-n // words)
    size = np.full(int(count.sum()), words)
    size[np.cumsum(count) - 1] = n - words * (count - 1)
    return size


_PIECES = "buckets binary, sizes binary"


def _pieces(bucket: np.ndarray, size: np.ndarray, words: int) -> Iterator[tuple[bytes, bytes]]:
    """Consecutive passages as rows of about ``words`` words: (16-bit buckets, 8-bit sizes)."""
    end, a = np.cumsum(size), 0
    while a < len(size):
        before = int(end[a] - size[a])
        b = max(a + 1, int(np.searchsorted(end, before + words, side="right")))
        yield bucket[before:end[b - 1]].astype(np.uint16).tobytes(), size[a:b].astype(np.uint8).tobytes()
        a = b


def _tokens(docs: DataFrame, config: Config) -> DataFrame:
    """All passages of all texts, and per task (``part`` not null) the documents
    in which each word bucket occurs, the documents with words and the passages."""
    size = 1 << config.buckets_log2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        schema = pa.schema([("part", pa.int64()), ("counts", pa.binary()), ("buckets", pa.binary()), ("sizes", pa.binary())])
        df = np.zeros(size + 2, np.int64)
        for batch in batches:
            for _, _, data, offsets in tx.text_blocks(batch.column(0)):
                w = _words(data, offsets)
                bucket, passages = _bucket(w.hashes(), config), _passage_sizes(w.first, config.passage_words)
                pair = w.row * size + bucket
                pair = np.sort(pair.astype(np.int32) if len(offsets) <= (1 << 31) // size else pair)
                df[:size] += np.bincount(pair[np.diff(pair, prepend=-1) != 0] % size, minlength=size)
                df[size:] += (w.count() > 0).sum(), len(passages)
                rows = list(_pieces(bucket, passages, config.piece_words))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary()),
                                                  *(pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))], schema=schema)
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId() % 32, "counts": df.tobytes()}], schema=schema)

    return docs.select("text").mapInArrow(run, f"part bigint, counts binary, {_PIECES}")


def _frequencies(tokens: DataFrame, config: Config) -> tuple[np.ndarray, int, int]:
    """Documents in which each word bucket occurs, documents with words, passages."""
    size = 1 << config.buckets_log2

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _summed(batches, np.int64):
            yield batch

    rows = tokens.where("part is not null").select("part", "counts")
    rows = rows.repartition(32, "part").mapInArrow(total, "part bigint, counts binary").collect()
    df = sum((np.frombuffer(r["counts"], np.int64) for r in rows), np.zeros(size + 2, np.int64))
    return df[:size], int(df[size]), int(df[size + 1])


def _summed(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
    """All rows' arrays of a task, added up."""
    acc = None
    for batch in batches:
        for x in batch.column(1):
            x = np.frombuffer(x.as_py(), kind)
            acc = x.copy() if acc is None else acc + x
    if acc is not None:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([acc.tobytes()], pa.binary())], names=["part", "counts"])


def _add(out: np.ndarray, to: np.ndarray, table: np.ndarray, at: np.ndarray, piece: int = 2048) -> None:
    """out[to[i]] += table[at[i]]; ``to`` ascends."""
    rows = np.empty((piece, table.shape[1]), table.dtype)
    for lo in range(0, len(to), piece):
        own = to[lo:lo + piece]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        np.take(table, at[lo:lo + piece], axis=0, out=rows[:len(own)], mode="clip")
        out[own[first]] += np.add.reduceat(rows[:len(own)], first, axis=0)


def _gram(bucket: np.ndarray, size: np.ndarray, idf: np.ndarray, scaled: np.ndarray, weight: float, out: np.ndarray) -> None:
    """Adds weight * A'(A basis) but for the factor idf of its rows; A: the
    passages' TF-IDF rows of unit length; ``scaled``: the basis times idf."""
    row = np.repeat(np.arange(len(size)), size)
    square = np.add.reduceat(idf[bucket] ** 2, np.cumsum(size) - size)
    y = np.zeros((len(size), scaled.shape[1]), np.float32)
    _add(y, row, scaled, bucket)
    y *= (weight / np.maximum(square, 1e-18)).astype(np.float32)[:, None]
    order = np.argsort(bucket, kind="stable")
    _add(out, bucket[order], y, row[order])


def _joined(batches: Iterator[pa.RecordBatch], words: int = 1 << 19, passages: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Passages of consecutive rows of equal weight: (buckets, sizes, weight)."""
    held: list[tuple] = []
    n_words = n_passages = 0
    for batch in batches:
        for weight, buckets, sizes in zip(*(x.to_pylist() for x in batch.columns)):
            row = np.frombuffer(buckets, np.uint16), np.frombuffer(sizes, np.uint8).astype(np.int64), weight
            if held and (weight != held[0][2] or n_words + len(row[0]) > words or n_passages + len(row[1]) > passages):
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), held[0][2]
                held, n_words, n_passages = [], 0, 0
            held.append(row)
            n_words, n_passages = n_words + len(row[0]), n_passages + len(row[1])
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), held[0][2]


def _basis(passages: DataFrame, idf: np.ndarray, config: Config) -> np.ndarray:
    """Leading right singular vectors (buckets x rank) of all passages (weight, buckets, sizes)."""
    rng = np.random.default_rng(7)
    size, width = 1 << config.buckets_log2, config.rank + config.oversample
    q = rng.standard_normal((size, width), dtype=np.float32)
    sc = passages.sparkSession.sparkContext
    step_rows = max(1, size // 64)          # rows of the product that travel together

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 1):
            acc = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group.column("rows")).astype(np.float32)
            yield pa.RecordBatch.from_arrays([group.column("block").slice(0, 1).combine_chunks(), pa.array([acc.tobytes()], pa.binary())],
                                             names=["block", "rows"])

    for step in range(config.power_iterations + 1):
        sent = sc.broadcast((idf, q))

        def product(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            weights, basis = sent.value
            got, scaled = np.zeros_like(basis), basis * weights[:, None]
            for bucket, sizes, weight in _joined(batches):
                _gram(bucket, sizes, weights, scaled, weight, got)
            got *= weights[:, None]
            for lo in range(0, size, step_rows):
                yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int64()), pa.array([got[lo:lo + step_rows].tobytes()], pa.binary())],
                                                 names=["block", "rows"])
            tx.release()

        # partial products are added up by the workers; the driver gets each row of the sum once
        sums = (passages.mapInArrow(product, "block bigint, rows binary").repartition(8, "block").sortWithinPartitions("block")
                .mapInArrow(total, "block bigint, rows binary"))
        got = np.zeros_like(q)
        for r in sums.toLocalIterator():
            got[r["block"]:r["block"] + step_rows] += np.frombuffer(r["rows"], np.float32).reshape(-1, width)
        sent.destroy()
        q, s, _ = np.linalg.svd(got, full_matrices=False) if step == config.power_iterations else (*np.linalg.qr(got), None)
        q = q.astype(np.float32)
        tx.release()
    return q[:, :config.rank]


@dataclass
class Item:
    item_id: object
    words: np.ndarray
    answer: set


def _passages(rows: list[tuple], config: Config) -> list[Item]:
    """Benchmark texts as passages of at most ``longest`` words, with the answer's words."""
    out = []
    for item_id, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        w = _words(raw, np.array([0, len(raw)], np.int64))
        h = w.hashes()
        if len(h) < config.least_words:
            continue
        stops = np.flatnonzero(np.isin(raw, np.frombuffer(b".!?\n", np.uint8)))
        begins = [int(np.searchsorted(w.start, s)) for s in stops]
        last = max((b for b in begins if b < len(h)), default=max(0, len(h) - 5))
        answer = set(h[last:].tolist())
        step = config.longest // 2
        for lo in range(0, max(1, len(h) - step), step) if len(h) > config.longest else (0,):
            out.append(Item(item_id, h[lo:lo + config.longest], answer))
    return out


def common_subsequence(masks: dict, n: int, words: list) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    full, v = (1 << n) - 1, (1 << n) - 1
    for x in words:
        m = masks.get(x)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(item: Item) -> dict:
    out: dict = {}
    for i, x in enumerate(item.words.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


def verdict(item: Item, masks: dict, words: list, config: Config) -> tuple[float, float, bool]:
    """(common part, answer part, is contained) of a stretch of words against an item."""
    n = len(item.words)
    # no subsequence is longer than the item's places whose word is there at all
    own = [x for x in words if x in masks]
    least = min(config.paraphrase, config.copy) * n
    if len(own) < least or sum(map(int.bit_count, map(masks.get, set(own)))) < least:
        return 0.0, 0.0, False
    common = common_subsequence(masks, n, own) / n
    answer = len(item.answer.intersection(words)) / max(1, len(item.answer))
    if n <= config.exact_words:
        target = item.words.tolist()
        return common, answer, any(words[i:i + n] == target for i in range(len(words) - n + 1))
    return common, answer, common >= config.copy or (common >= config.paraphrase and answer >= config.answer)


_SLOTS = 2048

#: Text that is searched at once; a byte takes some 75 bytes of memory meanwhile.
#: Results don't depend on it.
SEARCH_BYTES = 1 << 18


def _slot(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(_SLOTS - 1)).astype(np.int64)


def _ranges(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range, place) of every place of the ranges first .. first + n - 1."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + (first - np.cumsum(n) + n)[which]


class Scale:
    """Projected passages of one window length."""

    def __init__(self, size: int, items: list[Item], table: np.ndarray, config: Config):
        self.size, self.items, self.masks = size, items, [_masks(x) for x in items]
        at = np.stack([table[_bucket(x.words, config)].sum(axis=0) for x in items])
        self.mass = np.linalg.norm(at, axis=1)
        self.at = (at / np.maximum(self.mass, 1e-9)[:, None]).astype(np.float32)
        self.length = np.array([len(x.words) for x in items])
        self.first = np.cumsum(self.length) - self.length
        self.slots = _slot(np.concatenate([x.words for x in items]))
        self.least = min(config.paraphrase, config.copy) * self.length

    def sharing(self, slot: np.ndarray, lead: np.ndarray, stop: np.ndarray, window: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which (window, item) pairs may pass :func:`verdict`: enough of the
        item's places have a word whose slot occurs in the window's stretch."""
        there = np.zeros((len(lead), _SLOTS), bool)
        which, place = _ranges(lead, stop - lead)
        there[which, slot[place]] = True
        out = np.empty(len(item), bool)
        for lo in range(0, len(item), 4096):
            x, own = item[lo:lo + 4096], window[lo:lo + 4096]
            which, place = _ranges(self.first[x], self.length[x])
            found = there[own[which], self.slots[place]]
            out[lo:lo + 4096] = np.bincount(which[found], minlength=len(x)) >= self.least[x]
        return out


class Searcher:
    """Projected benchmark passages by window length; searches blocks of texts.

    Passages that the basis doesn't carry (``least_kept``) are also found by any
    run of ``least_words`` of their words.
    """

    def __init__(self, items: list[Item], basis: np.ndarray, idf: np.ndarray, config: Config):
        table = (basis * idf[:, None]).astype(np.float32)
        # a bucket more, of zeros, for hops that a text's end cuts short
        self.config, self.table = config, np.vstack([table, np.zeros((1, table.shape[1]), np.float32)])
        self.lost = [x for x in items if self._kept(x, table, idf) < config.least_kept]
        self.lost_masks = [_masks(x) for x in self.lost]
        runs = [tx.windows(x.words, np.zeros(len(x.words), np.int64), config.least_words) for x in self.lost]
        key = np.concatenate([k for k, _ in runs] or [np.empty(0, np.uint64)])
        order = np.argsort(key, kind="stable")
        self.run_key = key[order]
        self.run_item = np.repeat(np.arange(len(runs)), [len(k) for k, _ in runs])[order]
        self.run_at = np.concatenate([at for _, at in runs] or [np.empty(0, np.int64)])[order]
        self.run_mark = np.zeros(1 << 16, bool)         # leading bits of the runs' keys
        self.run_mark[key >> np.uint64(48)] = True
        self.scales = []
        size = 4 * config.hop
        while size <= config.longest:
            own = [x for x in items if (len(x.words) <= size or size == config.longest) and (len(x.words) > size // 2 or size == 4 * config.hop)]
            if own:
                self.scales.append(Scale(size, own, table, config))
            size *= 2

    def _kept(self, item: Item, table: np.ndarray, idf: np.ndarray) -> float:
        """Part of an item's TF-IDF length that the basis carries."""
        bucket, times = np.unique(_bucket(item.words, self.config), return_counts=True)
        return float(np.linalg.norm(times @ table[bucket]) / max(1e-9, np.linalg.norm(times * idf[bucket])))

    def _by_runs(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Distinct (lost item, place its first word would have, row) of runs of words found in a block."""
        if not len(self.run_key):
            return np.empty((0, 3), np.int64)
        key, at = tx.windows(h, row, self.config.least_words)
        some = np.flatnonzero(self.run_mark[key >> np.uint64(48)])
        key, at = key[some], at[some]
        lo, hi = np.searchsorted(self.run_key, key), np.searchsorted(self.run_key, key, side="right")
        n = hi - lo
        which = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        begin = np.repeat(at, n)
        return np.unique(np.stack([self.run_item[which], begin - self.run_at[which], row[begin]], axis=1), axis=0)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(row, item id, cosine, common, answer) found in a block of rows, best per pair."""
        c, w = self.config, _words(data, offsets)
        h = w.hashes()
        if not len(h) or not self.scales:
            return []
        bucket = _bucket(h, c)
        # a row's first word begins a hop
        begin = np.zeros(len(h), bool)
        within = np.arange(len(h)) - w.first[w.row]
        begin[within % c.hop == 0] = True
        hop = np.flatnonzero(begin)
        hop_row, hop_no = w.row[hop], within[hop] // c.hop
        sums = np.empty((len(hop), self.table.shape[1]), np.float32)
        ends, none = w.first[hop_row + 1], len(self.table) - 1
        part = np.empty((2048, self.table.shape[1]), np.float32)
        for lo in range(0, len(hop), len(part)):
            some = hop[lo:lo + len(part)]
            own = sums[lo:lo + len(some)]
            np.take(self.table, bucket[some], axis=0, out=own, mode="clip")
            for k in range(1, c.hop):
                at = np.where(some + k < ends[lo:lo + len(some)], bucket[np.minimum(some + k, len(h) - 1)], none)
                own += np.take(self.table, at, axis=0, out=part[:len(some)], mode="clip")
        best: dict = {}
        for x, place, row in self._by_runs(h, w.row).tolist():
            n = len(self.lost[x].words)
            words = h[max(int(w.first[row]), place - n // 4):min(int(w.first[row + 1]), place + n + n // 4)]
            common, answer, found = verdict(self.lost[x], self.lost_masks[x], words.tolist(), c)
            if found:
                near = self.table[_bucket(words, c)].sum(axis=0)
                own = self.table[_bucket(self.lost[x].words, c)].sum(axis=0)
                cosine = float(near @ own / max(1e-9, np.linalg.norm(near) * np.linalg.norm(own)))
                key, value = (row, self.lost[x].item_id), (common, answer, cosine)
                if key not in best or best[key] < value:
                    best[key] = value
        span, reach = sums, 1
        slot = _slot(h)
        for scale in self.scales:
            while reach * c.hop < scale.size:          # windows of twice the hops
                longer = np.empty_like(span)
                np.add(span[:-reach], span[reach:], out=longer[:-reach])
                longer[-reach:] = span[-reach:]
                span, reach = longer, reach * 2
            starts = np.flatnonzero(hop_no % max(1, reach // 4) == 0)
            for lo in range(0, len(starts), 8192):
                some = starts[lo:lo + 8192]
                near = span[some]
                dots = near @ scale.at.T
                i, j = np.divmod(np.flatnonzero(dots >= c.least_share * scale.mass), len(scale.items))
                norm, hit = np.zeros(len(some), np.float32), np.unique(i)
                norm[hit] = np.linalg.norm(near[hit], axis=1)
                close = dots[i, j] >= c.least_cosine * norm[i]
                i, j = i[close], j[close]
                if not len(i):
                    continue
                hit, window = np.unique(i, return_inverse=True)
                row, first = hop_row[some[hit]], hop[some[hit]]
                lead = np.maximum(w.first[row], first - scale.size // 4)
                stop = np.minimum(w.first[row + 1], first + scale.size + scale.size // 4)
                likely = scale.sharing(slot, lead, stop, window, j)
                for k, x in zip(window[likely].tolist(), j[likely].tolist()):
                    item = scale.items[x]
                    common, answer, found = verdict(item, scale.masks[x], h[lead[k]:stop[k]].tolist(), c)
                    if found:
                        key = (int(row[k]), item.item_id)
                        value = (common, answer, float(dots[hit[k], x] / max(norm[hit[k]], 1e-9)))
                        if key not in best or best[key] < value:
                            best[key] = value
        return [(row, item, cos, common, answer) for (row, item), (common, answer, cos) in sorted(best.items(), key=lambda t: t[0][0])]


class Retriever:
    """The fitted weights and basis, one searcher per block of items."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text",
                 config: Config | None = None):
        self.config = c = config or Config()
        src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
        ws = Workspace(docs.sparkSession, "decontaminate")
        self.item_type = benchmark.schema[item_col].dataType
        bench = benchmark.select(benchmark[item_col].alias("item"), benchmark[item_text].alias("text")).where("text is not null")
        n_items = bench.count()
        self.blocks = max(1, -(-n_items // c.block_items)) if n_items <= c.block_items else -(-2 * n_items // c.block_items)
        self.bench = bench
        tokens = ws.put("tokens", _tokens(src, c))
        df, n_docs, n_corpus = _frequencies(tokens, c)
        idf = np.log((n_docs + 1.0) / (df + 1.0)).clip(0.05).astype(np.float32)

        def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    own = [_bucket(x.words, c) for x in _passages([(None, text)], c)]
                    if own:
                        size = np.array([len(x) for x in own])
                        rows = list(_pieces(np.concatenate(own), size, c.piece_words))
                        yield pa.RecordBatch.from_arrays([pa.array([len(own)] + [0] * (len(rows) - 1), pa.int64()),
                                                          *(pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))], names=["n", "buckets", "sizes"])

        # items of all blocks, together as heavy as all of the corpus
        items = ws.put("items", bench.select("text").mapInArrow(passages, f"n bigint, {_PIECES}"))
        n_passages = items.agg(F.sum("n")).first()[0] or 0
        weight = max(1.0, n_corpus / max(1, n_passages))
        tasks = min(1 << 12, max(8, -(-n_corpus // c.task_passages)))
        corpus = tokens.where("part is null").select(F.lit(1.0).alias("weight"), "buckets", "sizes").coalesce(tasks)
        both = corpus.unionByName(items.select(F.lit(float(weight)).alias("weight"), "buckets", "sizes").coalesce(8))
        self.basis, self.idf = _basis(both, idf, c), idf
        ws.drop("tokens", "items")
        tx.release()

    def _items(self, block: int) -> list[Item]:
        rows = self.bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(self.blocks)) == block).collect()
        return _passages([(r["item"], r["text"]) for r in rows], self.config)

    def searcher(self, block: int) -> Searcher:
        return Searcher(self._items(block), self.basis, self.idf, self.config)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", config: Config | None = None) -> DataFrame:
    """(id, item, cosine, common, answer) for each document that contains a benchmark passage."""
    fitted = Retriever(docs, benchmark, id_col, text_col, item_col, item_text, config)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind, item_kind = src.schema["id"].dataType.simpleString(), fitted.item_type.simpleString()
    parts = []
    for block in range(fitted.blocks):
        sent = share(docs.sparkSession, fitted.searcher(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = unpack(sent)
            for batch in batches:
                for a, _, data, offsets in tx.text_blocks(batch.column(1), SEARCH_BYTES):
                    got = searcher.search(data, offsets)
                    if got:
                        row, item, *rest = zip(*got)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([a + r for r in row])), pa.array(item), *map(pa.array, rest)],
                                                         names=["id", "item", "cosine", "common", "answer"])

        parts.append(src.mapInArrow(run, f"id {kind}, item {item_kind}, cosine double, common double, answer double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    best = F.max(F.struct("common", "answer", "cosine")).alias("best")
    return (out.groupBy("id", "item").agg(best)
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.cosine", "best.common", "best.answer"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark passage, all columns unchanged."""
    fitted = Retriever(docs, benchmark, text_col=text_col, **names)
    at = docs.columns.index(text_col)
    for block in range(fitted.blocks):
        sent = share(docs.sparkSession, fitted.searcher(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = unpack(sent)
            for batch in batches:
                for a, b, data, offsets in tx.text_blocks(batch.column(at), SEARCH_BYTES):
                    clean = np.ones(b - a, bool)
                    clean[[r for r, *_ in searcher.search(data, offsets)]] = False
                    yield batch.slice(a, b - a).filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
