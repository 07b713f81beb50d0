"""Byte-level BPE encoding and decoding by a table of ranks (operator 12).

The ranks (bytes -> rank, one ``base64 rank`` line each) become a vocabulary
and merges of the tokenizers library on the driver: an entry of several bytes
is split once, into the two parts that merging by lower ranks leaves of it.
No other split can stand beside each other when its rank is due, so the
library's merges give what merging any adjacent pair by rank gives.  The
library's model goes to the workers as one string (bounded by the vocabulary).

Encoding works on Arrow batches (:mod:`millrace.llm.unit_coder`).  A token's
bytes are known, so byte positions are running sums and a prefix count of code
points maps them to characters: ``begins`` and ``ends`` are the first and one
past the last character the token touches (a character that is split between
tokens belongs to all of them).  Decoding turns the byte alphabet round: ids
become bytes by one gather, and only the joined bytes are read as UTF-8, so
split characters come back whole; an incomplete one becomes U+FFFD in ``text``.

Defined results: a null or empty text has no ids and decodes to no bytes; a
null list of ids decodes to no bytes.  An id outside the vocabulary is an
error.  Repeated rows are coded alike; other columns are not read.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import text as tx
from millrace.llm.subword import per_process
from millrace.llm.unit_coder import BLOCK_BYTES, UnitCoder, byte_symbols, gather

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_IDS = 1 << 18         # ids decoded at once (memory only)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def split_of(entry: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What merging by ranks below the entry's own leaves of it."""
    parts, own = [entry[i:i + 1] for i in range(len(entry))], ranks[entry]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= own:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def library_of(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizers library's model (JSON) that codes by these ranks."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers
    symbols = byte_symbols()

    def spell(b: bytes) -> str:
        return "".join(symbols[x] for x in b)

    if missing := [i for i in range(256) if bytes([i]) not in ranks]:
        raise ValueError(f"ranks lack the bytes {missing[:5]}")
    merges = []
    for entry in sorted((e for e in ranks if len(e) > 1), key=ranks.get):
        parts = split_of(entry, ranks)
        if len(parts) == 2:          # others are met as whole pieces only
            merges.append((spell(parts[0]), spell(parts[1])))
    model = models.BPE(vocab={spell(b): r for b, r in ranks.items()}, merges=merges, ignore_merges=True)
    library = Tokenizer(model)
    library.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    library.decoder = decoders.ByteLevel()
    return library.to_str()


@cache
def _model(path: str, pattern: str) -> str:
    return library_of(read_ranks(path), pattern)


def model(path: str | None = None, pattern: str | None = None) -> str:
    import public_tokenizers
    return _model(path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN)


class ByteTable:
    """Bytes of every id of a model string."""

    def __init__(self, spec: str):
        back = {s: b for b, s in byte_symbols().items()}
        vocabulary = sorted(json.loads(spec)["model"]["vocab"].items(), key=lambda e: e[1])
        self.size = np.zeros(vocabulary[-1][1] + 1, np.int64)
        self.size[[i for _, i in vocabulary]] = [len(s) for s, _ in vocabulary]
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(bytes(back[c] for s, _ in vocabulary for c in s), np.uint8)

    def spans(self, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character of each token, counted in its row."""
        stop = np.cumsum(self.size[ids])
        seen = tx.heads(data)
        owner = np.repeat(seen[offsets[:-1]], np.diff(first))
        return seen[stop - self.size[ids] + 1] - 1 - owner, seen[stop] - owner

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows and their offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id is outside the vocabulary")
        size = self.size[ids]
        return gather(self.bytes, self.start[ids], size), np.concatenate([[0], np.cumsum(size)])[first]


def coder_of(spec: str) -> UnitCoder:
    from tokenizers import Tokenizer
    return UnitCoder(Tokenizer.from_str(spec))


def _once(kind, shared):
    return per_process(f"{kind.__name__}:{hash(shared.value)}", lambda: kind(shared.value))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: str | None = None, spans: bool = False) -> DataFrame:
    """One row per input row: id and ``ids``; ``spans`` adds ``begins`` and ``ends`` (characters)."""
    shared = docs.sparkSession.sparkContext.broadcast(spec or model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _once(coder_of, shared)
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1), BLOCK_BYTES):
                ids, first = coder.encode(data, offsets)
                values = [ids, *(_once(ByteTable, shared).spans(ids, first, data, offsets) if spans else ())]
                lists = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(v.astype(np.int32))) for v in values]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists], names=["id", "ids", "begins", "ends"][:1 + len(lists)])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, ids array<int>"
    return src.mapInArrow(run, schema + (", begins array<int>, ends array<int>" if spans else "")).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ids_col: str = "ids", spec: str | None = None, text: bool = False) -> DataFrame:
    """``coded`` with its ids replaced by ``decoded`` (bytes), and ``text`` if asked for."""
    shared = coded.sparkSession.sparkContext.broadcast(spec or model())
    keep = [c for c in coded.columns if c != ids_col]
    if clash := {"decoded", *(["text"] if text else [])} & set(keep):
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _once(ByteTable, shared)
        for batch in batches:
            lists = batch.column(len(keep))
            filled = lists.fill_null([]) if lists.null_count else lists
            first = filled.offsets.to_numpy().astype(np.int64)
            for a, b in tx.row_blocks(first, BLOCK_IDS):
                ids = filled.values.slice(first[a], first[b] - first[a]).to_numpy(zero_copy_only=False)
                data, offsets = table.decode(ids, first[a:b + 1] - first[a])
                made = [pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(data)])]
                if text:
                    made.append(pa.array([x.as_py().decode("utf-8", "replace") for x in made[0]], pa.string()))
                made[0] = made[0].cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(keep))), *made], names=names)
            tx.release()

    out = coded.select(*keep, ids_col)
    fields = [f"`{c.replace('`', '``')}` {out.schema[c].dataType.simpleString()}" for c in keep]
    names = [*keep, "decoded", *(["text"] if text else [])]
    return out.mapInArrow(run, ", ".join([*fields, "decoded binary", *(["text string"] if text else [])]))
