"""Byte-level BPE by ranks (operator 12) against the tiktoken and tokenizers libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from millrace.llm import byte_codec as bc
from millrace.llm import queries, unit_coder
from millrace.llm import text as tx
from tests.llm import data as d

PIECES = [" ", "  ", "\n", "\n\n", "\t", "a", "B", "é", "ß", "中", "😀", "'s", "'", "'ll", ".", "..", "12", "٣", " ", "　", "\x85",
          "x y", "<|endoftext|>", "\x1c", "é", "ɏ", "ﬁ", "\r\n", "-", ' "', "\x00", "the", "The", " \n", " ", "﻿"]


def fuzz(seed, count, size=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(size))) for _ in range(count)]


@pytest.fixture(scope="module")
def tikt():
    ranks = bc.read_ranks(public_tokenizers.path(bc.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(coder, texts):
    data, offsets = tx.column_bytes(pa.array(texts, pa.string()))
    ids, first = coder.encode(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])], ids, first, data, offsets


def test_ids_equal_tiktoken_and_decode_back(tikt):
    coder, table = bc.coder_of(bc.model()), bc.ByteTable(bc.model())
    texts = fuzz(1, 3000) + [r[1] or "" for r in d.rows()] + [b.decode("utf-8", "ignore") * 3 for b in list(bc.read_ranks(public_tokenizers.path(bc.RANKS)))[::37]]
    for part in (texts[:1], texts[1:50], texts[50:]):      # cold and warm memo
        got, ids, first, data, offsets = coded(coder, part)
        assert got == [tikt.encode_ordinary(t) for t in part]
        back, at = table.decode(ids, first)
        assert (back == data).all() and (at == offsets).all()


def test_a_small_memo_changes_nothing(tikt, monkeypatch):
    monkeypatch.setattr(unit_coder, "MEMO_BYTES", 2000)
    coder, texts = bc.coder_of(bc.model()), fuzz(2, 400)
    for i in range(0, 400, 40):
        assert coded(coder, texts[i:i + 40])[0] == [tikt.encode_ordinary(t) for t in texts[i:i + 40]]


def test_a_full_memo_keeps_the_units_met_most(tikt, monkeypatch):
    monkeypatch.setattr(unit_coder, "MEMO_BYTES", 20_000)
    coder, asked = bc.coder_of(bc.model()), []
    ask = coder._ask
    monkeypatch.setattr(coder, "_ask", lambda units: asked.extend(units) or ask(units))
    for i in range(40):
        text = " usual words" + "".join(f" r{i}x{k}" for k in range(30))
        assert coded(coder, [text])[0] == [tikt.encode_ordinary(text)]
        assert coder.held < 2 * 20_000
    assert asked.count(" usual") == asked.count(" words") == 1 and len(asked) > 1200


def test_spans_are_the_librarys_offsets():
    coder, table, library = bc.coder_of(bc.model()), bc.ByteTable(bc.model()), Tokenizer.from_str(bc.model())
    for text in fuzz(3, 300) + ["a\U0001f9ff中文ünï"]:
        _, ids, first, data, offsets = coded(coder, ["é pad", text])
        begin, end = table.spans(ids, first, data, offsets)
        want = library.encode(text, add_special_tokens=False).offsets
        assert list(zip(begin[first[1]:].tolist(), end[first[1]:].tolist())) == want


def test_merges_of_ranks_without_training_order():
    """Entries that no two lower entries make are met as whole pieces only."""
    ranks = {bytes([i]): i for i in range(256)}
    for e in (b"ab", b"bc", b"abc", b"xyz", b"aa", b"aaa", b"aaaa"):
        ranks[e] = len(ranks)
    pattern = public_tokenizers.PATTERN
    ref = tiktoken.Encoding("small", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coder, rng = bc.coder_of(bc.library_of(ranks, pattern)), random.Random(4)
    texts = ["".join(rng.choice("abcxyz ") for _ in range(rng.randrange(12))) for _ in range(800)] + ["a" * n for n in range(40)] + ["xyz", " xyz"]
    assert coded(coder, texts)[0] == [ref.encode_ordinary(t) for t in texts]
    with pytest.raises(ValueError):
        bc.library_of({b"a": 0}, pattern)


def test_unit_coder_equals_the_library_with_special_tokens():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder = unit_coder.UnitCoder(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    texts = fuzz(5, 2000)
    assert coder.plain and coder.special == ["<|endoftext|>"]
    assert coded(coder, texts)[0] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    other = unit_coder.UnitCoder(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.plain
    assert coded(other, texts[:200])[0] == [library.encode(t, add_special_tokens=False).ids for t in texts[:200]]


def test_decode_reads_joined_bytes(spark):
    ranks = bc.read_ranks(public_tokenizers.path(bc.RANKS))
    ids = [ranks[bytes([b])] for b in "中".encode()]
    rows = [(1, ids), (2, ids[:2]), (3, []), (4, None)]
    got = {r.key: r for r in bc.decode(spark.createDataFrame(rows, "key int, ids array<int>"), text=True).collect()}
    assert (got[1].text, bytes(got[1].decoded)) == ("中", "中".encode())
    assert got[2].text == "�" and bytes(got[2].decoded) == "中".encode()[:2]
    assert got[3].text == got[4].text == ""
    with pytest.raises(Exception, match="outside the vocabulary"):
        bc.decode(spark.createDataFrame([(1, [10 ** 8])], "key int, ids array<int>")).collect()
    with pytest.raises(ValueError, match="exist already"):
        bc.decode(spark.createDataFrame([(1, [1])], "decoded int, ids array<int>"))


def test_operator_and_query(spark, tmp_root, tikt):
    rows = d.rows() + [(None, "no id", *d.rows()[0][2:]), d.rows()[3]]
    docs = d.frame(spark, rows)
    got = bc.encode(docs, spans=True).collect()
    key = lambda t: (t[0] is None, t[0] or 0, t[1])        # noqa: E731
    assert sorted(((g.doc_id, list(g.ids)) for g in got), key=key) == sorted(((r[0], tikt.encode_ordinary(r[1] or "")) for r in rows), key=key)
    assert all(len(g.ids) == len(g.begins) == len(g.ends) for g in got)
    assert bc.encode(docs.limit(0)).count() == 0
    docs.write.parquet(f"{tmp_root}/documents.parquet")
    got = {g.doc_id: g for g in queries.op12_byte_bpe(spark, tmp_root).collect()}
    for r in rows:
        ids, text = tikt.encode_ordinary(r[1] or ""), (r[1] or "").encode()
        g = got[r[0]]
        assert g.n_tokens == len(ids) and g.decoded_sha256 == hashlib.sha256(text).hexdigest()
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert np.sum([g.n_tokens for g in got.values()]) > 10000
