"""Language identification (operator 4).

Averaged hashed subword embeddings with a linear softmax: every byte n-gram of
a text (ASCII lower-cased, ASCII non-letters as one blank symbol) hashes to an
embedding, a text is the mean of its embeddings, a linear layer gives the
languages.  The model is trained by stochastic gradient descent in numpy on all
labelled rows, whole texts: rows are dealt by a hash of id and text to tasks of
about ``TASK_ROWS`` rows, every task descends from the same start over its rows
in the hash's order, and the tasks' weights are averaged in whole numbers, so
neither files nor the order of rows or tasks matter.  Texts of more than
``PIECE_BYTES`` are learned in pieces; small tables are gone over several times.
Prediction reads whole texts in one map without a shuffle.

Calibrated rejection: a fifth of the rows (of labels with ``HELD_ROWS`` rows or
more) is kept out of the training.  The temperature is fitted on all of these;
a text is rejected when its calibrated confidence is below the threshold that
would reject ``Config.reject_rate`` of all of these (counted in steps of
1/65536, never above ``Config.max_threshold``), or when it has no letter at all.

Defined results: null text or no letter: ``und`` with score 0, rejected.  No
labelled rows at all: every text is ``und``.  Of more labels than ``sample_rows`` the
most frequent are learned.  Rows of rare labels weigh more, at most ``MOST_WEIGHT``.
Of equally likely languages the
first in sorted order wins.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.shared import share, unpack

UNKNOWN = "und"
BLOCK_BYTES = 1 << 17        # text predicted at once; a byte takes some 100 bytes of memory meanwhile
HOLD_BYTES = 1 << 21         # text whose n-grams a trainer holds at once
PIECE_BYTES = 1 << 13        # a longer text is learned in pieces
TASK_ROWS = 8192             # rows that a task trains on, about
HELD_ROWS = 10               # labels with fewer rows are all trained on
MOST_WEIGHT = 16.0
BINS = 1 << 16               # of confidences, for the threshold
CHUNK = 256                  # weights in a row while they are averaged
UNIT = 1 << 24               # weights are averaged as multiples of 1 / UNIT
LOSS_UNIT = 1 << 20
TEMPERATURES = np.exp(np.linspace(np.log(0.3), np.log(20), 60))
_SYMBOL = np.arange(256, dtype=np.uint32)
_SYMBOL[:128] = 0x20
_SYMBOL[0x61:0x7B] = np.arange(0x61, 0x7B)
_SYMBOL[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


@dataclass(frozen=True)
class Config:
    sample_rows: int = 4000          # most labels learned
    orders: tuple = (2, 3, 4)
    buckets_log2: int = 16
    dim: int = 16
    steps: int = 350             # least gradient steps, however few rows there are
    batch: int = 64
    rate: float = 4.0
    largest: float = 30.0        # bound of every embedding and weight, so that training stays finite
    reject_rate: float = 0.002
    max_threshold: float = 0.5
    seed: int = 11


@dataclass
class Model:
    languages: list
    table: np.ndarray        # per bucket: embedding, or its scores when there are few languages
    weights: np.ndarray | None
    bias: np.ndarray
    temperature: float
    threshold: float
    config: Config


def grams(data: np.ndarray, offsets: np.ndarray, config: Config) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: bucket of every n-gram inside a row, and n-grams before each row's start."""
    sym = _SYMBOL[data]
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    code = np.zeros(len(sym), np.uint32)
    done = 0
    for n in sorted(config.orders):
        k = len(sym) - n + 1
        if k <= 0:
            yield np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
            continue
        while done < n:
            code = code[:len(sym) - done] * np.uint32(257) + sym[done:]
            done += 1
        at = np.flatnonzero((np.arange(k) + n <= row_end[:k]) & ((sym[:k] != 0x20) | (sym[1:k + 1] != 0x20) if n > 1 else sym[:k] != 0x20))
        bucket = ((code[at] + np.uint32(n)) * np.uint32(2654435769)) >> np.uint32(32 - config.buckets_log2)
        yield bucket.astype(np.int64), np.searchsorted(at, offsets)


def _sums(table: np.ndarray, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, table.shape[1]), np.float32)
    some = np.flatnonzero(first[1:] > first[:-1])
    if len(some):
        out[some] = np.add.reduceat(table[bucket], first[some], axis=0)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(data: np.ndarray, offsets: np.ndarray, config: Config) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every text's n-grams, each with its count, one text after the other, and the texts' ranges."""
    kind = np.uint16 if config.buckets_log2 <= 16 else np.uint32
    buckets, counts, size = [], [], []
    for lo, hi in tx.row_blocks(offsets, BLOCK_BYTES):
        parts = list(grams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], config))
        for i in range(hi - lo):
            own, n = np.unique(np.concatenate([bucket[first[i]:first[i + 1]].astype(kind) for bucket, first in parts]), return_counts=True)
            buckets.append(own)
            counts.append(n.astype(np.float32))
            size.append(len(own))
    first = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return np.concatenate([np.empty(0, kind), *buckets]), np.concatenate([np.empty(0, np.float32), *counts]), first


class Trainer:
    """Stochastic gradient descent over blocks of rows."""

    def __init__(self, labels: int, config: Config, seed: int = 0):
        self.config = config
        rng = np.random.default_rng(config.seed)       # the same start in every task
        self.emb = rng.uniform(-1 / config.dim, 1 / config.dim, (1 << config.buckets_log2, config.dim)).astype(np.float32)
        self.w, self.b = np.zeros((labels, config.dim), np.float32), np.zeros(labels, np.float32)
        self.rng = np.random.default_rng([config.seed, seed])
        self.seen = 0.0          # rows, a row gone over twice counts once

    def learn(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray, weight: np.ndarray, expected: float, epochs: int = 1) -> None:
        """Go ``epochs`` times over a block: each text, and a short piece of it.
        The rate falls as ``seen`` nears ``expected``."""
        c, size = self.config, np.diff(offsets)
        # pieces of whole texts, then short ones
        per = np.maximum(1, -(-size // PIECE_BYTES))
        of = np.repeat(np.arange(len(size)), per)
        begin = offsets[of] + (np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)) * PIECE_BYTES
        whole = _features(data, np.append(begin, offsets[-1]), c)
        length = np.minimum(size, self.rng.integers(12, 120, len(size)))
        place = offsets[:-1] + (self.rng.random(len(size)) * (size - length + 1)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(length)])
        short = _features(data[np.repeat(place - ends[:-1], length) + np.arange(ends[-1])], ends, c)
        feats, counts = np.concatenate([whole[0], short[0]]), np.concatenate([whole[1], short[1]])
        at = np.concatenate([whole[2], whole[2][-1] + short[2][1:]])
        of = np.concatenate([of, np.arange(len(size))])
        y, weight = label[of], weight[of].astype(np.float32)
        total = np.add.reduceat(np.append(counts, np.float32(0)), np.minimum(at[:-1], len(counts)))
        use = np.flatnonzero(np.diff(at))
        if len(use):
            for _ in range(epochs):
                order = self.rng.permutation(use)
                for lo in range(0, len(order), c.batch):
                    pick = order[lo:lo + c.batch]
                    done = self.seen / max(1.0, expected)
                    self._step(feats, counts, at, pick, y[pick], weight[pick], total[pick], c.rate * max(0.02, 1 - done))
                    self.seen += len(size) * len(pick) / len(order) / epochs
        else:
            self.seen += len(size)

    def _step(self, feats, counts, at, pick, y, weight, total, rate: float) -> None:
        c, sizes = self.config, at[pick + 1] - at[pick]
        spot = np.repeat(at[pick] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        f, n = feats[spot], counts[spot]
        first = np.cumsum(sizes) - sizes
        h = np.add.reduceat(self.emb[f] * n[:, None], first, axis=0) / total[:, None]
        g = _softmax(h @ self.w.T + self.b)
        g[np.arange(len(pick)), y] -= 1
        g *= weight[:, None]
        rate /= len(pick)
        back = (g @ self.w) / total[:, None] * np.float32(rate * c.dim)
        self.w = np.clip(self.w - np.float32(rate) * (g.T @ h), -c.largest, c.largest)
        self.b = np.clip(self.b - np.float32(0.1 * rate) * g.sum(axis=0), -c.largest, c.largest)
        by = np.argsort(f, kind="stable")
        run = np.flatnonzero(np.concatenate([[True], f[by][1:] != f[by][:-1]]))
        owner = np.repeat(np.arange(len(pick)), sizes)[by]
        rows = f[by][run]
        self.emb[rows] = np.clip(self.emb[rows] - np.add.reduceat(back[owner] * n[by][:, None], run, axis=0), -c.largest, c.largest)

    def flat(self) -> np.ndarray:
        """All weights, one after the other, filled up to whole chunks."""
        all_ = np.concatenate([self.emb.ravel(), self.w.ravel(), self.b])
        return np.append(all_, np.zeros(-len(all_) % CHUNK, np.float32))

    def load(self, flat: np.ndarray) -> None:
        a, b = self.emb.size, self.emb.size + self.w.size
        self.emb, self.w, self.b = flat[:a].reshape(self.emb.shape), flat[a:b].reshape(self.w.shape), flat[b:b + self.b.size]

    def model(self, languages: list) -> Model:
        """Neither calibrated nor rejecting."""
        few = len(languages) <= self.config.dim
        return Model(languages, self.emb @ self.w.T if few else self.emb, None if few else self.w, self.b, 1.0, 0.0, self.config)


def _epochs(rows: int, config: Config) -> int:
    """Times to go over the rows: each row gives two examples or more."""
    return max(1, -(-config.steps * config.batch // (2 * max(1, rows))))


def _weights(counts: dict, rows: int) -> dict:
    """Per label, the weight of its rows: labels above an equal share of the rows count as that share; 1 on average."""
    equal = max(1.0, rows / len(counts))
    mean = sum(min(n, equal) for n in counts.values()) / rows
    return {lang: min(MOST_WEIGHT, min(1.0, equal / n) / mean) for lang, n in counts.items()}


def train(rows: list[tuple[str, str]], config: Config) -> Model | None:
    """Fit on (language, text) rows at hand; None without rows."""
    rng = np.random.default_rng(config.seed)
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held, use = (rows[:len(rows) // 5], rows[len(rows) // 5:]) if len(rows) >= 50 else (rows, rows)
    counts = {lang: sum(r[0] == lang for r in use) for lang in languages}
    weights = _weights({lang: max(1, n) for lang, n in counts.items()}, len(use))

    def arrays(some):
        data, offsets = tx.column_bytes(pa.array([t for _, t in some], pa.large_string()))
        return data, offsets, np.array([languages.index(lang) for lang, _ in some], np.int64)

    trainer = Trainer(len(languages), config)
    data, offsets, y = arrays(use)
    trainer.learn(data, offsets, y, np.array([weights[lang] for lang, _ in use]), len(use), _epochs(len(use), config))
    model = trainer.model(languages)
    z, y = (lambda data, offsets, y: (logits(model, data, offsets), y))(*arrays(held))
    model.temperature = float(TEMPERATURES[int(np.argmin(_losses(z, y)))])
    bins = np.bincount(_bins(model, z), minlength=BINS + 1)
    model.threshold = _threshold(dict(enumerate(bins.tolist())), len(y), config)
    return model


def _losses(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each temperature: the rows' loss, a whole number of 1 / LOSS_UNIT."""
    return np.array([np.rint(-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-9)) * LOSS_UNIT).sum() for t in TEMPERATURES]).astype(np.int64)


def _bins(model: Model, z: np.ndarray) -> np.ndarray:
    return (_softmax(z / model.temperature).max(axis=1).astype(np.float64) * BINS).astype(np.int64)


def _threshold(bins: dict[int, int], rows: int, config: Config) -> float:
    """The lower end of the bin of confidences in which the quantile lies."""
    rank, seen = int(config.reject_rate * max(0, rows - 1)), 0
    for k in sorted(bins):
        seen += bins[k]
        if seen > rank:
            return min(k / BINS, config.max_threshold)
    return config.max_threshold


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros((len(offsets) - 1, model.table.shape[1]), np.float32)
    count = np.zeros(len(offsets) - 1, np.int64)
    for bucket, first in grams(data, offsets, model.config):
        total += _sums(model.table, bucket, first)
        count += np.diff(first)
    mean = total / np.maximum(count, 1)[:, None]
    return (mean if model.weights is None else mean @ model.weights.T) + model.bias


def predict(model: Model | None, column) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """(first row, end row, language, score, rejected) over blocks of a text column."""
    for a, b, data, offsets in tx.text_blocks(column, BLOCK_BYTES):
        n = b - a
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        some = letters[offsets[1:]] > letters[offsets[:-1]]
        for i in np.flatnonzero(~some & (np.diff(offsets) > 0)):
            some[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")))
        if model is None:
            yield a, b, [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            continue
        p = _softmax(logits(model, data, offsets) / model.temperature)
        best, score = p.argmax(axis=1), p.max(axis=1).astype(np.float64)
        names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, some)]
        yield a, b, names, np.where(some, score, 0.0), ~some | (score < model.threshold)


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        config: Config | None = None) -> Model | None:
    """Train on the rows of ``docs`` (all are taken as training rows)."""
    config = config or Config()
    src = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    src = src.where("lang is not null and length(text) > 0")
    counts = src.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(config.sample_rows).collect()
    if not counts:
        return None
    counts = {r["lang"]: r["n"] for r in counts}
    languages, rows = sorted(counts), sum(counts.values())
    weights = _weights(counts, rows)
    named = docs.sparkSession.createDataFrame(
        [(lang, k, float(weights[lang]), rows >= 50 and counts[lang] >= HELD_ROWS) for k, lang in enumerate(languages)],
        src.select("lang", F.lit(0).alias("label"), F.lit(0.0).alias("weight"), F.lit(False).alias("large")).schema)
    # the hash decides which rows are held out
    src = (src.join(F.broadcast(named), "lang").withColumn("held", F.expr("large and pmod(xxhash64(id, text, 7), 5) = 0"))
           .select("id", "text", "label", "weight", "held"))
    trainer = Trainer(len(languages), config)
    many = sum(n for n in counts.values() if n >= HELD_ROWS) if rows >= 50 else 0
    if many:
        trainer.load(_average(src.where("not held"), rows - many // 5, len(languages), config))
        model, held = trainer.model(languages), src.where("held")
        if _calibrate(model, held):
            return model
    else:
        trainer.load(_average(src, rows, len(languages), config))
        model = trainer.model(languages)
    _calibrate(model, src)
    return model


def _average(src: DataFrame, rows: int, labels: int, config: Config) -> np.ndarray:
    """The weights that the tasks learn from (id, text, label, weight), averaged by their rows."""
    tasks = max(1, rows // TASK_ROWS)
    expected, epochs = rows / tasks, _epochs(rows, config)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        trainer, held, size = None, [], 0

        def block():
            data, offsets = tx.column_bytes(pa.concat_arrays([x.column(0).cast(pa.large_string()) for x in held]))
            label, weight = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (1, 2))
            trainer.learn(data, offsets, label, weight, expected, epochs)

        for batch in batches:
            sizes = np.diff(tx.column_bytes(batch.column(0))[1])
            a = 0
            while a < batch.num_rows:
                trainer = trainer or Trainer(labels, config, TaskContext.get().partitionId())
                b = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:]), HOLD_BYTES - size, side="right")))
                held.append(batch.slice(a, b - a))
                size += int(sizes[a:b].sum())
                if size >= HOLD_BYTES or b < batch.num_rows:
                    block()
                    held, size = [], 0
                a = b
        if held:
            block()
        if trainer:
            flat = np.rint(trainer.flat() * np.float64(UNIT)).astype("<i4").reshape(-1, CHUNK)
            n = round(trainer.seen)
            for lo in range(0, len(flat), 1024):
                some = flat[lo:lo + 1024]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, lo + len(some), dtype=np.int32)), pa.array(np.full(len(some), n, np.int64)), pa.array([x.tobytes() for x in some], pa.binary())],
                                                 names=["chunk", "n", "sums"])
        tx.release()

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        of: dict[int, int] = {}
        for batch in batches:
            for chunk, n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                x = np.frombuffer(x.as_buffer(), "<i4").astype(np.int64) * n
                if chunk in sums:
                    sums[chunk] += x
                else:
                    sums[chunk] = x
                of[chunk] = of.get(chunk, 0) + n
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(sums[k] / (of[k] * UNIT)).astype("<f4").tobytes() for k in sums], pa.binary())],
                                             names=["chunk", "value"])

    # dealt and sorted by a hash: labels are mixed, and neither files nor their order matter
    key = F.xxhash64("id", "text", F.lit(3))
    dealt = (src.withColumn("key", key).repartitionById(tasks, F.pmod("key", F.lit(tasks)).cast("int"))
             .sortWithinPartitions("key", "id", "text", "label").select("text", "label", "weight"))
    got = (dealt.mapInArrow(learn, "chunk int, n bigint, sums binary").repartition(min(64, max(4, tasks // 4)), "chunk")
           .mapInArrow(average, "chunk int, value binary").collect())
    if not got:
        return Trainer(labels, config).flat()
    return np.concatenate([np.frombuffer(bytes(r["value"]), "<f4") for r in sorted(got, key=lambda r: r["chunk"])])


def _calibrate(model: Model, held: DataFrame) -> bool:
    """Temperature and threshold from all rows (text, label); False without rows."""
    spark = held.sparkSession

    def over(sent, measure, many: int) -> dict[int, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, total = unpack(sent), np.zeros(many, np.int64)
            for batch in batches:
                label = batch.column(1).to_numpy()
                for a, b, data, offsets in tx.text_blocks(batch.column(0), BLOCK_BYTES):
                    total += measure(model, logits(model, data, offsets), label[a:b])
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["k", "n"])

        got = held.select("text", "label").mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
        sent.unpersist()
        return {r["k"]: r["n"] for r in got}

    losses = over(share(spark, model), lambda model, z, y: np.append(_losses(z, y), len(y)), len(TEMPERATURES) + 1)
    rows = losses.pop(len(TEMPERATURES), 0)
    if not rows:
        return False
    model.temperature = float(TEMPERATURES[min(range(len(TEMPERATURES)), key=lambda k: losses.get(k, 0))])
    bins = over(share(spark, model), lambda model, z, y: np.bincount(_bins(model, z), minlength=BINS + 1), BINS + 1)
    model.threshold = _threshold(bins, rows, model.config)
    return True


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, ``rejected``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, names, score, rejected in predict(model, batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                                                 names=["id", "lang_pred", "score", "rejected"])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, all columns unchanged."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _, rejected in predict(model, batch.column(at)):
                yield batch.slice(a, b - a).filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
