"""Quality rules by repetition coverage (operator 10).

For every text, rolling hashes of word n-grams of several lengths and of whole
lines find repeats inside that text; what counts is how many characters (of
words) lie in windows that occurred before.  One narrow map over the text
column: no shuffle, no state across rows.

Defined results: a null or empty text has no words, so every count is 0 and it
fails the base rule (fewer than ``min_words`` words).  Ties and repeated rows
don't matter (each row is judged alone); other columns, whatever their names,
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import text as tx
from millrace.llm.shared import forget
from millrace.llm.subword import put_away

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


@dataclass(frozen=True)
class Rules:
    """Thresholds; percentages are of ``word_chars`` (lines: of the lines with words)."""

    min_words: int = 50
    max_repeat_words_pct: int = 50
    gram_pct: dict = field(default_factory=lambda: {5: 15, 7: 13, 10: 10})
    max_line_pct: int = 30
    max_line_chars_pct: int = 20


def _group_keys(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return tx.mix(h ^ (row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: equal to an earlier key; equal to any other key."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    few = np.flatnonzero(any_)           # only repeated keys need their order of appearance
    order = few[np.argsort(key[few], kind="stable")]
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    return later, any_


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside the windows that begin at ``at``."""
    edge = np.zeros(size + 1, np.int32)
    if not len(at):
        return np.zeros(size, bool)
    edge[at] += 1            # the windows' first words are distinct
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """Counts of one block of rows, as columns."""
    w = tx.words(data, offsets, lower=False)
    cp = tx.heads(data)
    chars = cp[w.end] - cp[w.start]
    out = {"n_words": w.count(), "word_chars": _per_row(chars, w.first)}
    out["n_symbols"] = _per_row(_SYMBOL[data], offsets)
    # lines: between row edges and line feeds; only those with a word count
    feed = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], feed + 1]), kind="stable")
    stop = np.sort(np.concatenate([feed, offsets[1:]]), kind="stable")
    line_row = np.searchsorted(offsets, begin, side="right") - 1
    # a line that begins at a row's end (after a last line feed, or of an empty row) is empty
    line_row = np.minimum(line_row, max(len(offsets) - 2, 0))
    lo, hi = np.searchsorted(w.start, begin), np.searchsorted(w.start, stop)
    real = hi > lo
    begin, stop, lo, hi = begin[real], stop[real], lo[real], hi[real]
    line_row = w.row[lo]
    later, _ = _repeats(_group_keys(tx.hash_spans(data, begin, stop), line_row))
    rows = len(offsets) - 1
    total = np.concatenate([[0], np.cumsum(chars)])
    out["n_lines"] = np.bincount(line_row, minlength=rows).astype(np.int64)
    out["n_dup_lines"] = np.bincount(line_row, weights=later, minlength=rows).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_row, weights=later * (total[hi] - total[lo]), minlength=rows).astype(np.int64)
    h = w.hashes()
    key, at = tx.windows(h, w.row, 3)
    _, any_ = _repeats(_group_keys(key, w.row[at]))
    out["n_repeat_words"] = _per_row(_covered(at[any_], 3, len(h)), w.first)
    for n in rules.gram_pct:
        key, at = tx.windows(h, w.row, n)
        later, _ = _repeats(_group_keys(key, w.row[at]))
        out[f"dup_chars_{n}"] = _per_row(chars * _covered(at[later], n, len(h)), w.first)
    out["base_failed"] = (out["n_words"] < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_words_pct * out["n_words"])
    bad = out["base_failed"].copy()
    for n, pct in rules.gram_pct.items():
        bad |= 100 * out[f"dup_chars_{n}"] > pct * out["word_chars"]
    bad |= 100 * out["n_dup_lines"] > rules.max_line_pct * out["n_lines"]
    bad |= 100 * out["dup_line_chars"] > rules.max_line_chars_pct * out["word_chars"]
    out["kept"] = ~bad
    return out


def _columns(rules: Rules) -> list[str]:
    return ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "n_lines", "dup_line_chars", *(f"dup_chars_{n}" for n in rules.gram_pct)]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """One row per input row: id, the counts, ``base_failed`` and ``kept``."""
    rules = rules or Rules()
    names = _columns(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(1)):
                got = measure(data, offsets, rules)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(got[c]) for c in names)],
                                                 names=["id", *names])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kinds = ", ".join(f"{c} {'boolean' if c in ('base_failed', 'kept') else 'bigint'}" for c in names)
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {kinds}")
    return out.withColumnRenamed("id", id_col)


#: Text that :func:`keep_good` judges at once (memory only, no effect on results).
JUDGE_BYTES = 1 << 18


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged."""
    rules = rules or Rules()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put_away()          # workers outlive stages
        forget()
        for batch in batches:
            for a, b, data, offsets in tx.text_blocks(batch.column(at), JUDGE_BYTES):
                yield batch.slice(a, b - a).filter(pa.array(measure(data, offsets, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
