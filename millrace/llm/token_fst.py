"""Exact token counts by a finite-state tokenizer (operator 8).

A BPE piece model is compiled, as far as texts need it, into a deterministic
transducer over characters.  A state holds what later characters can depend
on: the longest suffix read that begins some piece, and for each place in it
from which a piece may go on the last token of the text up to there, with token
counts relative to now.  A
transition reads one character and is annotated with the change in the number
of tokens.  The last token of a longer prefix is the one suffix piece that is
compatible with the last token before it, i.e. the pair tokenizes to itself;
that decides every transition.  Characters outside the pieces fall back to
their UTF-8 bytes.

No piece of the model crosses from a non-blank to a blank, so a blank after a
non-blank brings the transducer into one known state.  A text is cut anywhere
into segments; a segment's state map is its head (up to the first such place,
open to any entry state), a count, and its tail.  Maps compose associatively,
and a text's count is their reduction, pairwise like a parallel prefix scan;
``prefix_counts`` gives the running counts.  Counts of stretches between blanks
are kept per process.

Model support: BPE pieces with byte fallback, identity normalisation, a dummy
prefix and no user-defined pieces; anything else raises ValueError.

Defined results: a null or empty text has 0 tokens.  Strings of control pieces
in a text are ordinary text, as in the library.  Repeated rows are counted one
by one.  Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.subword import per_process, tokenizer_path

PIECE_MODEL = "piece_bpe_32k.model"
SEGMENT = 1 << 16            # characters per state map
STATES = 400_000             # compiled states kept; beyond, compilation starts again
STRETCHES = 400_000          # memoised stretches
_STRETCH = re.compile(" +[^ ]*")
_HEAD = re.compile(" *[^ ]*")


class Transducer:
    """Lazily compiled; ``count`` runs a string that begins in the blank state."""

    def __init__(self, path: str | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        path = path or tokenizer_path(PIECE_MODEL)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n, t = spec.normalizer_spec, spec.trainer_spec
        kinds = {p.type for p in spec.pieces}
        if not (t.model_type == t.BPE and t.byte_fallback and n.add_dummy_prefix and not n.remove_extra_whitespaces
                and not n.precompiled_charsmap and not t.treat_whitespace_as_suffix and kinds <= {1, 2, 3, 6}):
            raise ValueError("this piece model isn't supported")
        self.score = {p.piece.replace("▁", " "): p.score for p in spec.pieces if p.type == 1}
        if any(" " in p.lstrip(" ") for p in self.score):
            raise ValueError("a piece crosses from a non-blank to a blank")
        self.prefixes = {p[:k] for p in self.score for k in range(1, len(p) + 1)}
        self.touch = {p[k:k + 2] for p in self.score for k in range(len(p) - 1)}
        self.pairs: dict = {}
        self.shapes: dict = {}
        self.memo: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.index: dict = {}
        self.keys: list = []
        self.moves: list[dict] = []
        self.start = self._state(("", (None,), (0,)))

    def _live(self, suffix: str) -> list[int]:
        """Places in a suffix from which a piece may go on, and its end."""
        return [k for k in range(len(suffix)) if suffix[k:] in self.prefixes] + [len(suffix)]

    def _shape(self, suffix: str, ch: str) -> tuple:
        """What reading ``ch`` behind a suffix means whatever came before: the
        pieces that may end here (place, piece; longest first), the next suffix,
        the places it keeps, and whether what is before them still matters."""
        got = self.shapes.get((suffix, ch))
        if got is None:
            if len(self.shapes) >= STRETCHES:
                self.shapes.clear()
            read, at = suffix + ch, {k: i for i, k in enumerate(self._live(suffix))}
            ends = [(at[k], read[k:]) for k in range(len(read)) if read[k:] in self.score]
            keep = next((k for k in range(len(read)) if read[k:] in self.prefixes), len(read))
            take = [at[keep + k] for k in self._live(read[keep:])[:-1]]
            cut = 0 < keep < len(read) and read[keep - 1:keep + 1] not in self.touch
            got = self.shapes[suffix, ch] = (ends, read[keep:], take, cut)
        return got

    def _state(self, key: tuple) -> int:
        got = self.index.get(key)
        if got is None:
            got = self.index[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
        return got

    def merges(self, text: str) -> list[str]:
        """Tokens of a short text by the merge rule: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, before: str | None, piece: str) -> bool:
        if before is None or before[-1] + piece[0] not in self.touch:
            return True
        got = self.pairs.get((before, piece))
        if got is None:
            if len(self.pairs) >= STRETCHES:
                self.pairs.clear()
            got = self.pairs[before, piece] = self.merges(before + piece) == [before, piece]
        return got

    def _compile(self, state: int, ch: str) -> tuple[int, int]:
        suffix, last, count = self.keys[state]
        if suffix and suffix[-1] + ch not in self.touch:
            # nothing before can matter any more
            suffix, last, count = "", (None,), (0,)
        ends, after, take, cut = self._shape(suffix, ch)
        for i, piece in ends:
            if self._compatible(last[i], piece):
                token, value = piece, count[i] + 1
                break
        else:
            # a character without a piece: its bytes, and nothing merges with it
            token, value = None, count[-1] + len(ch.encode("utf-8", "surrogatepass"))
        if after:
            last = (*[last[i] for i in take], token)
            if cut:
                last = (None, *last[1:])
            key = (after, last, (*[count[i] - value for i in take], 0))
        else:
            key = ("", (None,), (0,))
        moves = self.moves[state]
        moves[ch] = got = (self._state(key), value)
        return got

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(state after, tokens added) for a text read in a state."""
        moves, total = self.moves, 0
        for ch in text:
            got = moves[state].get(ch)
            if got is None:
                got = self._compile(state, ch)
            state, d = got
            total += d
        return state, total

    def count(self, text: str) -> int:
        """Tokens of a stretch read from the blank state."""
        got = self.memo.get(text)
        if got is None:
            if len(self.keys) > STATES:
                self._reset()
            got = self.run(self.start, text)[1]
            if len(text) <= 64:
                if len(self.memo) >= STRETCHES:
                    self.memo.clear()
                self.memo[text] = got
        return got

    # ------------------------------------------------ state maps of segments
    def state_map(self, segment: str) -> tuple[str, int, str | None]:
        """(head, tokens between, tail); no place in a known state: tail is None."""
        head = _HEAD.match(segment).group()
        rest = _STRETCH.findall(segment, len(head))
        if not rest:
            return head, 0, None
        return head, sum(map(self.count, rest[:-1])), rest[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        joined = a[2] + b[0]
        if b[2] is None:
            return a[0], a[1], joined
        return a[0], a[1] + self.count(joined) + b[1], b[2]

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        text = " " + text.replace("▁", " ")
        maps = [self.state_map(text[k:k + SEGMENT]) for k in range(0, len(text), SEGMENT)]
        while len(maps) > 1:
            maps = [self.compose(*maps[k:k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        head, inner, tail = maps[0]
        # the text begins with the dummy blank: its head is read from the blank state
        return self.count(head) + inner + (self.count(tail) if tail is not None else 0)

    def prefix_counts(self, text: str) -> list[tuple[int, int]]:
        """(characters, tokens) up to each place in a known state, and the end."""
        out, chars, total = [], -1, 0
        for stretch in _STRETCH.findall(" " + text.replace("▁", " ")) if text else []:
            chars, total = chars + len(stretch), total + self.count(stretch)
            out.append((chars, total))
        return out


def transducer(path: str | None = None) -> Transducer:
    return per_process(f"transducer:{path}", lambda: Transducer(path))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, model: str | None = None) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            tokens, size = [], []
            for x in batch.column(1):
                text = x.as_py()
                tokens.append(machine.tokens(text))
                size.append(len(text.encode()) if text else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()),
                                              pa.array([n > limit for n in tokens], pa.bool_())],
                                             names=["id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
