"""Words and hashes of Arrow text columns, straight from their byte buffers.

Texts are cut into words ``[^\\x20\\x09-\\x0D]+`` (ASCII blanks only, so cutting
UTF-8 bytes equals cutting characters) and spans are hashed to 64 bits with a
polynomial over random byte weights.  All of it is numpy over one block of
whole rows; a block holds ``BLOCK_BYTES`` of text or one longer row, whose
hashing again runs in pieces, so memory stays near a small multiple of the
text itself.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20          # text worked on at once (memory only, no effect on results)
PIECE_BYTES = 1 << 16          # hashed at once
_BASE = 0x9E3779B97F4A7C15     # odd: invertible modulo 2**64
_MASK = (1 << 64) - 1
_WEIGHT = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# also ASCII punctuation and controls
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_HEAD = (np.arange(256) & 0xC0) != 0x80      # first byte of a code point


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def column_bytes(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_large_string(arr.type) or pa.types.is_string(arr.type)):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    _, offsets, data = arr.buffers()
    if len(arr) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return raw, off - off[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``limit`` bytes, at least one row each."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend and don't overlap."""
    out = np.empty(len(start), np.uint64)
    if not len(start):
        return out
    reach = max(PIECE_BYTES, int((end - start).max())) + 1
    power = np.cumprod(np.full(reach, _BASE, np.uint64))
    back = np.cumprod(np.full(reach, pow(_BASE, -1, 1 << 64), np.uint64))
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE_BYTES, side="right")))
        a, b = int(start[i]), int(end[j - 1])
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_WEIGHT[data[a:b]] * power[:b - a], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * back[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


@dataclass
class Words:
    """Words of a block of rows: byte spans, owner row, word range per row."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool, blank: np.ndarray = _BLANK) -> Words:
    data = _LOWER[data] if lower else data
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~blank[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    first = np.searchsorted(start, offsets)
    first[-1] = len(start)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, row, first)


def windows(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-word window that lies in one row, and its first word."""
    k = len(h) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(row[:k] == row[n - 1:])
    acc = np.full(len(at), n, np.uint64)
    for j in range(n):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[at + j]
    return mix(acc), at


def heads(data: np.ndarray) -> np.ndarray:
    """Prefix counts of code points over the bytes."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_HEAD[data], out=out[1:])
    return out


def release() -> None:
    """Give memory that is free back to the system (worker processes live on
    between tasks, and the driver goes on too)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
    if trim is not None:
        trim(0)


def text_blocks(column, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over blocks of whole rows."""
    data, offsets = column_bytes(column)
    for a, b in row_blocks(offsets, limit):
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
    release()
