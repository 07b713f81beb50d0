"""Byte-level BPE ids of blocks of texts with the tokenizers library.

A block's bytes are cut where the byte-level pattern always ends a piece,
whatever stands around; the units between cuts are dictionary-encoded by Arrow
and only distinct units that the process hasn't met lately go to the library,
many in one call.  The ids of the block are then gathered by numpy.  When the
memory for units is full, those met in most blocks are kept.

Cuts (the pattern looks behind nowhere, and ahead only after blanks):

* before a space that a non-blank follows: the space opens the next piece;
* between a Latin letter and ASCII punctuation or an ASCII blank: letters end;
* after a line feed between two ASCII non-blanks: alone, it is a piece.

Texts that hold the string of a special token aren't cut.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 22       # text coded at once, about
ASK_UNITS = 1 << 13         # units that go to the library in a call
MEMO_BYTES = 64 << 20       # what a process remembers of units, about
LONG_UNIT = 200             # longer units (bytes) are not remembered
_COST = 180                 # bytes of one remembered unit beside its own (string, dictionary entry, place)

_BYTE = np.arange(256)
_ASCII_LETTER = ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
_ASCII_BLANK = np.isin(_BYTE, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_ASCII_SEEN = (_BYTE > 0x20) & (_BYTE < 0x7F)
_ASCII_MARK = _ASCII_SEEN & ~_ASCII_LETTER & ~((_BYTE >= 0x30) & (_BYTE <= 0x39))
# first bytes that begin no Unicode blank (those begin with C2, E1, E2 or E3)
_SOLID = _ASCII_SEEN | ((_BYTE >= 0xC3) & (_BYTE < 0xF5) & ~np.isin(_BYTE, [0xE1, 0xE2, 0xE3]))
_ASCII_LETTERS = re.compile(" ?[A-Za-z]+").fullmatch
_LETTERS_ONLY = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch      # one piece of the pattern


def byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return table


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mask over len(data) + 1 positions: a unit may begin there."""
    out = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        left, right = data[:-1], data[1:]
        out[:-2] |= (left == 0x20) & _SOLID[right]
        out[1:-1] |= _ASCII_LETTER[left] & (_ASCII_MARK | _ASCII_BLANK)[right]
    if len(data) > 2:
        out[2:-1] |= (data[1:-1] == 0x0A) & _ASCII_SEEN[data[:-2]] & _ASCII_SEEN[data[2:]]
    out[offsets] = True
    return out


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces flat[start:start + size], one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


class UnitCoder:
    """``encode(bytes, row offsets)`` -> (ids, first id of each row)."""

    def __init__(self, library):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        self.library = library
        library.no_padding()
        library.no_truncation()
        spec = json.loads(library.to_str())
        pre = spec["pre_tokenizer"] or {}
        steps = pre.get("pretokenizers", [pre])
        # cuts and single pieces hold for the plain byte-level pattern only
        self.plain = spec["normalizer"] is None and steps[-1].get("type") == "ByteLevel" and not steps[-1]["add_prefix_space"] \
            and (steps[-1]["use_regex"] if len(steps) == 1 else [s["type"] for s in steps] == ["Split", "ByteLevel"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pieces = Tokenizer(library.model)          # the same model, without a pattern
        self.symbols = byte_symbols()
        self.limit: int | None = None       # of MEMO_BYTES, when a caller has less room
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.held, self.units, self.used = 0, 0, 0
        self.flat = np.empty(1 << 16, np.uint32)
        self.start = np.empty(1 << 14, np.int64)
        self.size = np.empty(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int64)      # blocks in which a unit occurred

    def _thin(self) -> None:
        """Keep the units met in most blocks, up to half of the memory."""
        names, place = list(self.memo), np.fromiter(self.memo.values(), np.int64, len(self.memo))
        met, size = self.met[place], self.size[place]
        cost = 4 * size + np.fromiter(map(len, names), np.int64, len(names)) + _COST
        order = np.argsort(-met, kind="stable")
        order = order[:int(np.searchsorted(np.cumsum(cost[order]), (self.limit or MEMO_BYTES) // 2, side="right"))]
        order = order[met[order] > 1]
        ids, place, size, met = gather(self.flat, self.start[place[order]], size[order]), np.arange(len(order)), size[order], met[order]
        self._forget()
        self._keep([names[k] for k in order.tolist()], ids, size)
        self.met[place] = met // 2

    def _ask(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit; single pieces need no pattern, and as ASCII only their blank needs a symbol."""
        blank, symbols, words, rest, single = self.symbols[0x20], self.symbols, [], [], []
        for u in units:
            if _ASCII_LETTERS(u):
                words.append(blank + u[1:] if u[0] == " " else u)
                single.append(True)
            elif _LETTERS_ONLY(u):
                words.append(u.encode().decode("latin-1").translate(symbols))
                single.append(True)
            else:
                rest.append(u)
                single.append(False)
        a = iter(self.pieces.encode_batch_fast(words, add_special_tokens=False))
        b = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [next(a if s else b).ids for s in single]

    def _learn(self, units: list[str]) -> np.ndarray:
        """Places of new units' ids."""
        out = []
        for lo in range(0, len(units), ASK_UNITS):
            some = units[lo:lo + ASK_UNITS]
            got = self._ask(some) if self.plain else [e.ids for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
            size = np.fromiter(map(len, got), np.int64, len(got))
            out.append(self._keep(some, np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum())), size))
        return np.concatenate(out)

    def _keep(self, units: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Remember units with their ids, one after the other; their places."""
        total, place = len(ids), np.arange(self.units, self.units + len(units))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.units + len(units) > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.size = np.concatenate([self.size, np.empty_like(self.size)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.flat[self.used:self.used + total] = ids
        self.start[place], self.size[place] = self.used + np.cumsum(size) - size, size
        self.used, self.units = self.used + total, self.units + len(units)
        self.memo.update((u, p) for u, p in zip(units, place.tolist()) if len(u) <= LONG_UNIT)
        self.held += 4 * total + sum(map(len, units)) + _COST * len(units)
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.plain:
            begins = np.zeros(len(data) + 1, bool)
            begins[offsets] = True
        else:
            begins = cuts(data, offsets)
            whole = pa.array(data, pa.uint8()).buffers()[1].to_pybytes() if self.special else b""
            for token in self.special:
                at = whole.find(token.encode())
                while at >= 0:
                    row = int(np.searchsorted(offsets, at, side="right")) - 1
                    begins[offsets[row] + 1:offsets[row + 1]] = False
                    at = whole.find(token.encode(), at + 1)
        at = np.flatnonzero(begins)
        if len(at) < 2:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        data = np.ascontiguousarray(data)
        units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        distinct = units.dictionary.to_pylist()
        if self.held > (self.limit or MEMO_BYTES):
            self._thin()
        get = self.memo.get
        place = np.array([get(u, -1) for u in distinct], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = self._learn([distinct[i] for i in new.tolist()])
        self.met[place] += 1
        place = place[units.indices.to_numpy()]
        size = self.size[place]
        ids = gather(self.flat, self.start[place], size)
        ends = np.concatenate([[0], np.cumsum(size)])
        return ids, ends[np.searchsorted(at, offsets)]
