"""Operators that judge rows one by one: quality rules, language, token counts."""

import math
import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import language, repetition, token_fst
from millrace.llm import text as tx
from tests.llm import data as d


def brute_quality(text):
    t = text or ""
    w = d.WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if d.WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    marked = {k for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(t.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup,
           "n_repeat_words": len(marked)}
    for n in (5, 7, 10):
        grams, cover = set(), set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                cover |= set(range(i, i + n))
            grams.add(tuple(w[i:i + n]))
        out[f"dup_chars_{n}"] = sum(len(w[i]) for i in cover)
    out["base_failed"] = len(w) < 50 or 100 * len(marked) > 50 * len(w)
    return out


def test_quality_matches_brute_force(spark):
    docs = d.frame(spark)
    got = {r["doc_id"]: r.asDict() for r in repetition.quality(docs).collect()}
    assert len(got) == len(d.rows())
    for r in d.rows():
        for k, v in brute_quality(r[1]).items():
            assert got[r[0]][k] == v, (r[0], k)
    kept = {r["doc_id"] for r in repetition.keep_good(docs).collect()}
    assert kept == {k for k, r in got.items() if r["kept"]}
    assert repetition.keep_good(docs).schema == docs.schema
    repeated = next(r[0] for r in d.rows() if (r[1] or "").startswith("same line"))
    assert repeated not in kept and kept
    assert repetition.quality(docs.limit(0)).count() == 0


def test_repeated_rows_are_judged_alike(spark):
    r = d.rows()[15]
    got = repetition.quality(d.frame(spark, [r, r])).collect()
    assert len(got) == 2 and got[0] == got[1]


def test_span_hashes_are_equal_for_equal_bytes_only():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    data, offsets = tx.column_bytes(pa.array(texts))
    w = tx.words(data, offsets, lower=True)
    got = collections.defaultdict(set)
    for h, a, b in zip(w.hashes().tolist(), w.start, w.end):
        got[h].add(bytes(w.data[a:b]))
    flat = [x.encode() for t in texts for x in d.words(t)]
    assert all(len(v) == 1 for v in got.values()) and len(got) == len(set(flat))
    assert [bytes(w.data[a:b]) for a, b in zip(w.start, w.end)] == flat


def test_column_bytes_of_slices_and_nulls():
    arr = pa.array(["ab", None, "", "cdé"])[1:]
    data, offsets = tx.column_bytes(arr)
    assert bytes(data) == "cdé".encode() and offsets.tolist() == [0, 0, 0, 4]


def test_language_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.remainder(docs["doc_id"], 3) == 1
    model = language.fit(docs.where(~held))
    got = language.identify(docs.where(held), model).join(docs, "doc_id").select("lang", "lang_pred", "score", "rejected").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert sum(r["rejected"] for r in got) <= 0.02 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    edge = {r["doc_id"]: r for r in language.identify(d.frame(spark), model).collect()}
    for i in (0, 1, 2):
        assert (edge[i]["lang_pred"], edge[i]["score"], edge[i]["rejected"]) == ("und", 0.0, True)
    assert edge[9]["lang_pred"] in model.languages
    assert {r["doc_id"] for r in language.keep_identified(d.frame(spark), model).collect()} == {k for k, r in edge.items() if not r["rejected"]}
    assert language.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in language.identify(d.frame(spark), None).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_predictions_come_in_small_blocks(spark, monkeypatch):
    model = language.train([(r[2], r[1]) for r in d.rows() if r[2] and r[1]], language.Config(steps=20))
    texts = pa.array([r[1] for r in d.rows()], pa.string())
    whole = list(language.predict(model, texts))
    monkeypatch.setattr(language, "BLOCK_BYTES", 1000)
    small = list(language.predict(model, texts))
    assert len(small) > 20 and [n for x in small for n in x[2]] == [n for x in whole for n in x[2]]
    assert np.allclose(np.concatenate([x[3] for x in small]), np.concatenate([x[3] for x in whole]), atol=1e-4)


def test_remainder_is_crc32_of_the_decimal_text(spark):
    ids = spark.range(50)
    got = ids.select("id", language.remainder(ids["id"], 10).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 10 for r in got)


@pytest.fixture(scope="module")
def machine():
    return token_fst.Transducer()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from millrace.llm.subword import tokenizer_path
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(token_fst.PIECE_MODEL))


def test_transducer_counts_equal_the_library(machine, library, monkeypatch):
    texts = [r[1] or "" for r in d.rows()]
    assert [machine.tokens(t) for t in texts] == [len(x) for x in library.encode(texts)]
    monkeypatch.setattr(token_fst, "SEGMENT", 7)      # cuts anywhere
    rng = random.Random(5)
    parts = ["a", "the", "ing", " ", "  ", "\n", "é", "▁", "</s>", "<0x0A>", "中", "😀", "==", "1", "tion", "​"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert machine.tokens(t) == len(library.encode(t)), repr(t)


def test_state_maps_compose_associatively(machine):
    maps = [machine.state_map(s) for s in (" the wa", "ter", " and", "  oth", "er x ")]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine.compose(m, right)
    assert left == right


def test_compiled_states_may_be_dropped(machine, library, monkeypatch):
    monkeypatch.setattr(token_fst, "STATES", 50)
    machine.memo.clear()
    t = d.prose(random.Random(8), 400)
    assert machine.tokens(t) == len(library.encode(t))
    assert machine.prefix_counts(t)[-1] == (len(t), len(library.encode(t)))


def test_token_counts_query(spark, library):
    got = {r["doc_id"]: r for r in token_fst.count_tokens(d.frame(spark), limit=100).collect()}
    for r in d.rows():
        n = len(library.encode(r[1] or ""))
        assert (got[r[0]]["n_tokens"], got[r[0]]["n_bytes"], got[r[0]]["over_limit"]) == (n, len((r[1] or "").encode()), n > 100)
    assert token_fst.count_tokens(d.frame(spark).limit(0)).count() == 0


def test_signed_columns_survive_hashing():
    assert tx.mix(np.array([0, 1], np.uint64)).dtype == np.uint64


def test_language_scores_are_finite_whatever_the_labels(spark):
    rng = random.Random(5)
    # two large labels without signal, many labels of one row each
    rows = [(i, d.prose(rng, 60), f"l{i % 2}") for i in range(600)] + [(1000 + i, f"only{i} " * 20, f"rare{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(docs, config=language.Config(sample_rows=800))
    assert {f"rare{i}" for i in range(300)} <= set(model.languages)
    assert np.isfinite(model.table).all() and math.isfinite(model.threshold) and math.isfinite(model.temperature)
    assert all(0 <= r["score"] <= 1 for r in language.identify(docs, model).collect())


def test_language_learns_from_every_row_however_they_are_dealt(spark):
    rng = random.Random(8)
    rows = [(i, d.prose(rng, 40, lang), lang) for i, lang in enumerate(list(d.LEX) * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    config = language.Config(sample_rows=10, steps=30)
    whole = language.fit(docs, config=config)
    again = language.fit(docs.orderBy("lang").coalesce(1), config=config)
    assert (whole.table == again.table).all() and (whole.temperature, whole.threshold) == (again.temperature, again.threshold)
    for gone in (0, 7, 20, 33):
        assert (language.fit(docs.where(docs["doc_id"] != gone), config=config).table != whole.table).any()


def test_language_trains_in_tasks_and_calibrates_on_all_held_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "TASK_ROWS", 100)
    rng = random.Random(9)
    rows = [(i, d.prose(rng, 40, lang), lang) for i, lang in enumerate(list(d.LEX) * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = language.identify(docs, model).join(docs, "doc_id").select("doc_id", "text", "lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    held = {r["doc_id"] for r in docs.where("pmod(xxhash64(cast(doc_id as string), text, 7), 5) = 0").select("doc_id").collect()}
    scores = sorted(r["score"] for r in got if r["doc_id"] in held)
    want = min(0.5, scores[int(model.config.reject_rate * (len(scores) - 1))])
    assert want - 1e-3 <= model.threshold <= want + 1e-6


def test_language_learns_long_texts_whole(spark):
    # what tells the languages apart is in the last 3000 of 40,000 characters, a training piece
    trainer = language.Trainer(2, language.Config())
    seen = []
    trainer._step = lambda feats, counts, at, pick, y, weight, total, rate: seen.extend(total.tolist())
    data, offsets = tx.column_bytes(pa.array(["ab " * 13000 + "zz" * 1500, "cd"], pa.large_string()))
    trainer.learn(data, offsets, np.array([0, 1]), np.ones(2), 2)
    assert sum(seen) > 2 * len(data) and len(seen) == 6 + 1 + 2


def test_language_scores_match_a_plain_softmax(spark):
    rng = random.Random(6)
    rows = [(i, d.prose(rng, 50, lang), lang) for i, lang in enumerate(list(d.LEX) * 30)]
    rows += [(900, "x", "en"), (901, "Ünï 12 cödé", "de"), (902, None, None), (903, "12 # 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.where("doc_id < 900"))
    c = model.config
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    for i, text, _ in rows:
        sym = [b if b > 127 else (b | 32) if chr(b).isalpha() else 32 for b in (text or "").encode()]
        if not any(ch.isalpha() for ch in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
            continue
        total, count = np.zeros(len(model.languages)), 0
        for n in c.orders:
            for at in range(len(sym) - n + 1):
                if sym[at] == 32 and (n == 1 or sym[at + 1] == 32):
                    continue
                code = 0
                for b in sym[at:at + n]:
                    code = (code * 257 + b) % (1 << 32)
                total += model.table[((code + n) * 2654435769 % (1 << 32)) >> (32 - c.buckets_log2)]
                count += 1
        z = (total / max(1, count) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[i]["lang_pred"] == model.languages[int(p.argmax())] and math.isclose(got[i]["score"], p.max(), rel_tol=1e-3)
