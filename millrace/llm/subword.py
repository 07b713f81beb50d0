"""Objects that a worker process keeps, and the coder of a tokenizer file."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from millrace.llm.unit_coder import UnitCoder

BYTE_BPE = "byte_bpe_50k.json"


def per_process(name: str, make: Callable):
    """One object per worker process, kept over tasks (functions are shipped by
    value, so their module globals last only for a task).  Workers outlive
    stages: what is kept must be bounded in bytes."""
    shelf = sys.modules.setdefault("_millrace_process_shelf", types.ModuleType("_millrace_process_shelf"))
    if not hasattr(shelf, name):
        setattr(shelf, name, make())
    return getattr(shelf, name)


def put_away() -> None:
    """Drop the process's tokenizers: stages that code no text need the room, and
    :func:`coder` loads them again."""
    shelf = vars(sys.modules.get("_millrace_process_shelf", types.SimpleNamespace()))
    for name in [n for n in shelf if n.startswith(("coder:", "sentence_ends:"))]:
        del shelf[name]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _load(path: str) -> UnitCoder:
    from tokenizers import Tokenizer
    return UnitCoder(Tokenizer.from_file(path))


def coder(path: str | None = None) -> UnitCoder:
    """The coder of a tokenizers file (default: the public byte-level BPE)."""
    return per_process(f"coder:{path}", lambda: _load(path or tokenizer_path(BYTE_BPE)))
