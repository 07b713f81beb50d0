"""Order-preserving packing by dynamic programming (operator 6).

Each task streams its rows in their order: a document is its ids and an end id;
the concatenated ids are cut into windows of at most ``length``.  Cuts may fall
at document ends (free), sentence ends (``sentence_cost``) and, inside long
sentences, every ``stride`` ids (``hard_cost``).  A window of n ids costs its
padding, none when n is a power of two (such sequences aren't padded), plus
``sequence_cost``.  The cheapest cut list is found by dynamic programming: the
padded transitions take the minimum of cost + position over a sliding range,
kept in a monotone queue; the few power-of-two lengths are looked up by
position.  Work is done in blocks of ``block`` ids; what follows a block's best
last cut moves on to the next block, so memory is bounded and only the last
window of a task is padded without choice.

No shuffle: the order kept is the input's.  ``sequence_id`` is the task's
partition in the upper half and a counter in the lower.

Defined results: a null or empty text is its end id alone.  Repeated rows are
packed as often as they occur.  Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import text as tx
from millrace.llm.shared import forget
from millrace.llm.subword import coder, per_process
from millrace.llm.unit_coder import BLOCK_BYTES


@dataclass(frozen=True)
class Config:
    length: int = 1024
    end_id: int = 0
    sentence_cost: int = 4
    hard_cost: int = 48
    sequence_cost: int = 8
    stride: int = 256
    least_power: int = 128       # shorter powers of two are padded like the rest
    block: int = 1 << 17
    tokenizer: str | None = None
    memo_bytes: int | None = None    # kept of met units by a worker (memory only); default: the coder's
    text_bytes: int = BLOCK_BYTES    # text coded at once, about (memory only)


def cut(position: np.ndarray, penalty: np.ndarray, config: Config, last: bool) -> list[int]:
    """Cut positions (indices into ``position``) of the cheapest windows.

    ``position`` ascends from 0, steps are at most ``config.length``.  With
    ``last`` the final position is a cut; otherwise the cheapest cut among the
    final window's positions ends the list."""
    size, per = config.length, config.sequence_cost
    powers = [p for p in (1 << k for k in range(size.bit_length())) if config.least_power <= p <= size]
    pos, pen = position.tolist(), penalty.tolist()
    exact: dict[int, list[int]] = {}     # windows of an unpadded length, by their end
    for n in powers:
        start = np.searchsorted(position, position - n)
        for k in np.flatnonzero(position[start] == position - n).tolist():
            exact.setdefault(k, []).append(int(start[k]))
    cost, back = [0] * len(pos), [0] * len(pos)
    low = [0] * len(pos)                 # cost + position
    queue: deque[int] = deque([0])       # candidates, cost + position ascending
    low[0] = pos[0]
    for i in range(1, len(pos)):
        p = pos[i]
        while pos[queue[0]] < p - size:
            queue.popleft()
        j = queue[0]
        best = low[j] + size - p
        if i in exact:
            for k in exact[i]:
                if cost[k] < best:
                    best, j = cost[k], k
        cost[i] = best = best + pen[i] + per
        back[i] = j
        low[i] = v = best + p
        while queue and low[queue[-1]] >= v:
            queue.pop()
        queue.append(i)
    i = len(pos) - 1
    if not last:
        reach = int(np.searchsorted(position, pos[-1] - size, side="right"))
        i = min(range(max(reach, 1), len(pos)), key=lambda k: (cost[k] - pen[k], -k), default=i)
    out = [i]
    while i:
        i = back[i]
        out.append(i)
    return out[::-1]


def _sentence_ends(library) -> np.ndarray:
    """Ids whose text ends a sentence: it has a line feed, or ends in . ! or ?"""
    vocabulary = library.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for piece, i in vocabulary.items():
        ends[i] = "Ċ" in piece or piece[-1:] in (".", "!", "?")
    return ends


class Packer:
    """Streams documents of one task into pieces."""

    def __init__(self, config: Config, first_sequence: int):
        self.config, self.sequence = config, first_sequence
        self.coder = coder(config.tokenizer)
        self.coder.limit = config.memo_bytes
        self.ends = per_process(f"sentence_ends:{config.tokenizer}", lambda: _sentence_ends(self.coder.library))
        self.ids: list[np.ndarray] = []      # documents of the block, the first perhaps begun before
        self.docs: list[tuple[int, int, int]] = []   # id, ids before this part, all its ids
        self.held = 0

    def texts(self, doc_ids: list, column) -> Iterator[tuple]:
        """Adds texts, a block at a time."""
        for a, b, data, offsets in tx.text_blocks(column, self.config.text_bytes):
            ids, first = self.coder.encode(data, offsets)
            for k in range(b - a):
                yield from self.add(doc_ids[a + k], ids[first[k]:first[k + 1]])

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        ids = np.append(ids, np.uint32(self.config.end_id)).astype("<u4", copy=False)
        self.docs.append((doc_id, 0, len(ids)))
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.config.block:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.held:
            return
        c, stream = self.config, np.concatenate(self.ids)
        stop = np.cumsum([len(x) for x in self.ids])
        begin = stop - [len(x) for x in self.ids]
        sentence = np.flatnonzero(self.ends[stream]) + 1
        border = np.zeros(len(stream) + 1, bool)
        border[0] = border[sentence] = border[stop] = True
        known = np.flatnonzero(border)
        wide = np.flatnonzero(np.diff(known) > c.stride)
        for k in wide:
            border[known[k] + c.stride:known[k + 1]:c.stride] = True
        position = np.flatnonzero(border)
        penalty = np.full(len(position), c.hard_cost)
        penalty[np.searchsorted(position, sentence)] = c.sentence_cost
        penalty[np.searchsorted(position, stop)] = 0
        penalty[0] = 0
        cuts = position[cut(position, penalty, c, last)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lo = int(np.searchsorted(stop, a, side="right"))
            hi = int(np.searchsorted(begin, b, side="left"))
            for d in range(lo, hi):
                x, y = max(a, int(begin[d])), min(b, int(stop[d]))
                doc_id, before, total = self.docs[d]
                yield (doc_id, before + x - int(begin[d]), y - x, zlib.crc32(stream[x:y].tobytes()), total, self.sequence, x - a, stream[x:y])
            self.sequence += 1
        done = int(cuts[-1])
        d = int(np.searchsorted(stop, done, side="right"))
        if d < len(self.docs):
            doc_id, before, total = self.docs[d]
            self.docs = [(doc_id, before + done - int(begin[d]), total), *self.docs[d + 1:]]
            self.ids = [stream[done:int(stop[d])].copy(), *self.ids[d + 1:]]
        else:
            self.docs, self.ids = [], []
        self.held = len(stream) - done


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence; ``with_ids`` adds its ids."""
    config = config or Config()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext
        forget()            # workers outlive stages
        packer = Packer(config, TaskContext.get().partitionId() << 32)
        for batch in batches:
            yield from packer.texts(batch.column(0).to_pylist(), batch.column(1))
        yield from packer.flush(last=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch():
            cols = list(zip(*held))
            arrays = [pa.array(cols[0], id_type), *(pa.array(x, pa.int64()) for x in cols[1:7])]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in cols[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS, "ids"][:len(arrays)])

        for row in rows(batches):
            held.append(row if with_ids else row[:7])
            if len(held) >= 8192:
                yield batch()
                held = []
        if held:
            yield batch()

    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = to_arrow_type(src.schema["id"].dataType)
    schema = f"doc_id {src.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in COLUMNS[1:])
    return src.mapInArrow(run, schema + (", ids array<int>" if with_ids else "")).withColumnRenamed("doc_id", id_col)
