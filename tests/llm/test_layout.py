"""Sharding, packing, chat formatting, token files, and the pipeline."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import chat_format, kd_shards, packing, token_files
from millrace.llm import text as tx
from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.subword import BYTE_BPE, coder, tokenizer_path
from tests.llm import data as d
from tests.llm.test_pairs import brute_components
from tests.oracle_check import compare, duck_connection


@pytest.fixture(scope="module")
def ids():
    """The library's ids of a whole text."""
    library = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


def check_shards(rows, texts, count, near=0.02):
    by = collections.defaultdict(list)
    for r in rows:
        t = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 1, zlib.crc32(t), "bytes")
        by[r["shard"]].append(r)
    assert len(rows) == len(texts)
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    size = [sum(r["size"] for r in by[s]) for s in range(count)]
    largest = max(r["size"] for r in rows)
    assert max(size) - min(size) <= near * sum(size) / count + 2 * largest
    return by


def test_shards_are_even_and_gapless(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by = check_shards(kd_shards.shards(docs).collect(), texts, 16)
    where = collections.defaultdict(set)
    for s, v in by.items():
        for r in v:
            where[texts[r["doc_id"]]].add(s)
    assert sum(len(s) > 1 for s in where.values()) <= 3     # equal texts stay together


def test_shards_of_awkward_tables(spark):
    # one text holds most rows: the group is cut by id
    rows = [(i, "same words in all of these rows", "en", None, None, "x", 1, 0.5, "y", "z", "s", "n", i, "c") for i in range(400)]
    rows += [(1000 + r[0], *r[1:]) for r in d.rows() if r[1] is None or len(r[1]) < 400]
    check_shards(kd_shards.shards(d.frame(spark, rows), 8).collect(), {r[0]: r[1] for r in rows}, 8)
    assert kd_shards.shards(d.frame(spark).limit(0)).count() == 0
    assert kd_shards.shards(d.frame(spark, [(None, None, *rows[0][2:])])).count() == 1


def test_pieces_hold_every_id_once(spark, ids):
    config = packing.Config(length=128, block=4000, stride=32)
    got = packing.pack(d.frame(spark), config=config, with_ids=True).collect()
    seq, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
    for v in seq.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 128
    for r in d.rows():
        whole = [*ids(r[1]), 0]
        assert [x for _, part, _ in sorted(docs[r[0]]) for x in part] == whole
        assert {t for _, _, t in docs[r[0]]} == {len(whole)}
    assert packing.pack(d.frame(spark).limit(0)).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(5)
    c = packing.Config(length=64, least_power=8)
    pad = lambda n: 0 if n >= 8 and n & (n - 1) == 0 else 64 - n
    for _ in range(150):
        pos = np.concatenate([[0], np.cumsum(rng.integers(1, 30, rng.integers(1, 50)))])
        pen = rng.integers(0, 9, len(pos))
        cost = [0.0] + [np.inf] * (len(pos) - 1)
        for i in range(1, len(pos)):
            cost[i] = min(cost[j] + pad(int(pos[i] - pos[j])) + pen[i] + c.sequence_cost for j in range(i) if pos[i] - pos[j] <= 64)
        cuts = packing.cut(pos, pen, c, True)
        assert sum(pad(int(pos[b] - pos[a])) + pen[b] + c.sequence_cost for a, b in zip(cuts[:-1], cuts[1:])) == cost[-1]


def test_packing_pads_little(spark):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)).groupBy("sequence_id").sum("length").collect()
    size = np.array([r[1] for r in rows])
    pad = np.where(size & (size - 1) == 0, 0, 1024 - size).sum()
    assert size.max() <= 1024 and pad <= 0.04 * size.sum()


def test_memo_gives_the_library_ids(ids):
    rng = random.Random(2)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "\u00a0", "\u3000", ".", ",", "'s", "12", "\x1c", "\x85", "<|endoftext|>", "中", "\r\n", "\u0300"]
    texts = [r[1] for r in d.rows()] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for a in range(0, len(texts), 700):                  # later blocks find most units in the memo
        data, offsets = tx.column_bytes(pa.array(texts[a:a + 700], pa.string()))
        got, first = coder().encode(data, offsets)
        for i, t in enumerate(texts[a:a + 700]):
            assert got[first[i]:first[i + 1]].tolist() == ids(t), repr(t)


def test_pieces_are_the_same_with_little_memory(spark):
    docs = d.frame(spark).coalesce(1)
    want = packing.pack(docs).collect()
    got = packing.pack(docs, config=packing.Config(memo_bytes=2000)).collect()
    assert got == want and packing.Packer(packing.Config(memo_bytes=2000), 0).coder.limit == 2000
    assert packing.Packer(packing.Config(), 0).coder.limit is None


def test_chats_come_back_identical(spark):
    bad = ["", "</s>", "~", "a~", "\\b", "\\", "<\\l", "[INST] user\n", "</", "<", "x\n~\n", "</s", "\n", "é</s>[", "\\o[", None]
    rows = [(i, j, r, t, "x") for i, r in enumerate([*bad, "assistant", "user"]) for j, t in enumerate(bad)]
    rows += [(None, 0, "user", "a", "x"), (None, None, "assistant", "b", "x"), (500, 0, "user", "same", "x"), (500, 0, "user", "same", "x")]
    rng = random.Random(2)
    marks = ["<", "/", "s", ">", "[", "\\", "b", "l", "~", "\n", "INST", "]", " ", "<|"]
    rows += [(1000 + k, j, rng.choice(["user", "assistant", "".join(rng.choices(marks, k=3))]), "".join(rng.choices(marks, k=rng.randint(0, 12))), "x")
             for k in range(60) for j in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    chats = chat_format.format_chats(df)
    parsed = chats.select("conv_id", chat_format.parse(chats["formatted"]).alias("t"), "formatted", "spans").collect()
    want = collections.defaultdict(list)
    for c, j, r, t, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want[c].append((r or "", t or ""))
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in parsed} == dict(want)
    for r in parsed:                     # spans lead to the contents
        at = 0
        for turn, span in zip(r["t"], r["spans"]):
            at += span["skip"]
            assert r["formatted"][at:at + span["length"]] == turn["content"] and span["learned"] == (turn["role"] == "assistant")
            at += span["length"] + len(chat_format.END)
        assert at == len(r["formatted"])
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).count() == 0


def test_control_strings_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "fine")], "conv_id long, turn long, role string, text string")
    shown = chat_format.format_chats(df).first()["formatted"]
    assert shown == "[INST] user~\n\\l/s>\\oINST] ok \\o/INST]</s>[/INST] assistant\nfine</s>"


def test_chat_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck_connection(sf), "op7_chat", QUERIES["op7_chat"], ORACLES["op7_chat"], sf)["status"] == "ok"


def test_token_files_read_back(spark, ids):
    config = token_files.Config(length=64, batch=4)
    rows = d.rows() + [(None, "null id", *d.rows()[0][2:])]
    got = token_files.token_files(d.frame(spark, rows), config=config).collect()
    at = 0
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        whole = np.array([*ids(r[1]), 2], "<u4")
        assert (by_id[r[0]]["start"], by_id[r[0]]["n_tokens"], by_id[r[0]]["ids_crc32"]) == (at, len(whole), zlib.crc32(whole.tobytes()))
        at += len(whole)
    assert token_files.token_files(d.frame(spark).limit(0)).count() == 0


def test_sequences_are_fixed_size_with_masks(spark, tmp_root, ids):
    config = token_files.Config(length=64, batch=4)
    docs = d.frame(spark)
    parts = token_files.write_tokens(docs, tmp_root, config=config, partitions=2).orderBy("part").collect()
    stream = np.concatenate([[*ids(r[1]), 2] for r in d.rows()])
    at = 0
    for p in parts:
        reader = token_files.Reader(tmp_root, p["name"])
        own = stream[at:at + p["n_tokens"]]
        n = -(-len(own) // 64)
        for k in range(n):
            seq, mask = reader.sequence(k)
            assert len(seq) == len(mask) == 64
            assert (seq[mask] == own[64 * k:64 * k + 64]).all() and mask.sum() == min(64, len(own) - 64 * k)
        at += p["n_tokens"]
    assert at == len(stream)


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], sf)
        out = spark.createDataFrame(out.collect(), out.schema)
        if name != "pack_sequences":
            assert out.schema == docs.schema and 0 < out.count() <= seen[-1].count()
        seen.append(out)
    quality, language, dedup, clean = ({r["doc_id"]: r["text"] for r in x.collect()} for x in seen[1:5])
    # near-duplicates: one document of each group of the stage's input
    assert set(dedup) == {i for i, c in brute_components(language).items() if i == c}
    # decontamination: no document that holds a benchmark text whole, no other lost without a match
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if len(r["text"].split()) >= 8]
    assert not [i for i, t in clean.items() if any(x in t for x in items)]
    gone = set(dedup) - set(clean)
    assert len([i for i in gone if any(x in dedup[i] for x in items)]) >= 0.8 * len(gone)
    run = corpus_pipeline.run(spark, sf)
    assert run.columns == packing.COLUMNS
    # windows depend on how rows lie in tasks; documents and tokens don't
    tokens = lambda x: {r["doc_id"]: r["n"] for r in x.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert tokens(run) == tokens(seen[-1]) and set(tokens(run)) == set(clean)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_packing_in_small_blocks_of_text_gives_the_same_pieces(spark):
    docs = d.frame(spark).coalesce(1)
    whole = packing.pack(docs).collect()
    assert packing.pack(docs, config=packing.Config(text_bytes=2000)).collect() == whole


def test_stages_work_on_small_pieces_of_text_and_keep_no_tokenizer():
    """Workers hold what a block of text takes; tokenizers only while texts are coded."""
    from types import SimpleNamespace

    from pyspark import cloudpickle

    from millrace.llm import decontaminate, repetition, shared, subword
    assert max(decontaminate.SEARCH_BYTES, repetition.JUDGE_BYTES) <= 1 << 18
    first = subword.per_process("coder:x", object)
    assert subword.per_process("coder:x", object) is first
    assert shared.unpack(SimpleNamespace(value=cloudpickle.dumps([7]))) == [7]
    assert subword.per_process("coder:x", object) is not first
    subword.put_away()
    shared.forget()
