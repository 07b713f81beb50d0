"""Operators on pairs and on the whole corpus: near-duplicates, decontamination, scoring."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import bloom, decontaminate, lm_bloom, near_dups
from millrace.llm import text as tx
from tests.llm import data as d


def shingle_set(text):
    w = d.words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_components(texts: dict) -> dict:
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def family(seed: int, size: int, edits: int) -> list[str]:
    """Copies of one text with many edits: some pairs link, some only through others."""
    rng = random.Random(seed)
    base = d.prose(rng, 120).split(" ")
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(1, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_match_brute_force(spark):
    texts = {r[0]: r[1] for r in d.rows()}
    for k, t in enumerate(family(1, 40, 6) + family(2, 25, 4)):
        texts[1000 + k] = t
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, component_id string").repartition(3)
    got = {r["doc_id"]: r for r in near_dups.near_duplicates(docs).collect()}
    want = brute_components(texts)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (want[i] == i) and r["n_shingles"] == len(shingle_set(texts[i])) for i, r in got.items())


def test_small_blocks_find_the_same_links(spark):
    texts = dict(enumerate(family(3, 60, 7)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, config=near_dups.Config(block=16)).collect()}
    assert got == brute_components(texts)


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    rng = __import__("random").Random(6)
    a, b, c = (d.prose(rng, 80) for _ in range(3))
    near = a.replace(a.split(" ")[40], "changed", 1)
    rest = d.rows()[0][2:]
    for rows, texts in (([(1, a), (2, a), (2, b)], {a: 1, b: 1}),                  # a unique text under a repeated id
                        ([(1, near), (2, a), (2, b)], {a: 1, b: 1}),               # linked through one text of the id only
                        ([(2, a), (2, a), (2, b), (3, b), (3, c)], {a: 1, b: 1, c: 1}),
                        ([(7, ""), (7, ""), (8, None)], {"": 2})):
        docs = spark.createDataFrame([(i, t, *rest) for i, t in rows], d.SCHEMA).withColumnsRenamed({"component": "row", "serial": "met"})
        kept = near_dups.keep_one(docs.repartition(2))
        assert kept.schema == docs.schema
        got = {}
        for r in kept.collect():
            t = a if r.text == near else r.text or ""
            got[t] = got.get(t, 0) + 1
        assert got == texts


def test_keep_one_per_class_with_repeated_rows_and_null_ids(spark):
    rows = d.rows()
    extra = [rows[30], rows[30], (None, rows[31][1], *rows[31][2:]), (None, None, *rows[31][2:])]
    docs = d.frame(spark, rows + extra)
    kept = near_dups.keep_one(docs)
    assert kept.schema == docs.schema
    got = collections.Counter(r["doc_id"] for r in kept.collect())
    want = brute_components({r[0]: r[1] for r in rows})
    assert got.pop(None) == 2
    assert got == {i: 1 for i, c in want.items() if i == c}
    assert near_dups.near_duplicates(docs.limit(0)).count() == 0 and near_dups.keep_one(docs.limit(0)).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.int64)
    bits = bloom.build(spark.createDataFrame([(int(k),) for k in keys], "key long"), 3, 4)
    assert bloom.contains(bits, keys.view(np.uint64), 4).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.int64)
    assert bloom.contains(bits, other.view(np.uint64), 4).mean() < 0.01


def bench(spark):
    rng = random.Random(77)
    items = [(i, d.prose(random.Random(500 + i), n) + f" answer word{i} shown{i}.") for i, n in enumerate([14, 30, 45, 60, 100, 220])]
    items += [(90, None), (91, ""), (92, "too short"), (93, "Only six words are in here."), (3, items[3][1])]
    docs, want = [], set()
    for k in range(60):
        docs.append((k, d.prose(rng, 150)))
    for i, t in items[:6]:
        docs.append((100 + i, d.prose(rng, 70) + "\n" + t + " " + d.prose(rng, 33)))     # verbatim
        w = t.split(" ")
        for p in range(3, len(w), 5):
            w[p] = "other" + w[p]
        docs.append((200 + i, d.prose(rng, 50) + " " + " ".join(w).upper()))              # paraphrase
        want |= {(100 + i, i), (200 + i, i)}
    docs += [(300, "x y only six words are in here z"), (301, "only six other words are in here"), (302, None), (303, "")]
    want.add((300, 93))
    return (spark.createDataFrame([(*r, "a") for r in docs], "doc_id long, text string, cosine string"),
            spark.createDataFrame([(*r, "b") for r in items], "item_id long, text string, common string"), want)


def test_leaks_are_found_and_clean_documents_left(spark):
    docs, items, want = bench(spark)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert got == want
    clean = decontaminate.keep_clean(docs, items)
    assert clean.schema == docs.schema
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {i for i, _ in want}


def test_leaks_in_blocks_and_empty_tables(spark):
    docs, items, want = bench(spark)
    small = decontaminate.Config(block_items=4)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items, config=small).collect()} == want
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.keep_clean(docs, items.limit(0)).count() == docs.count()


def test_items_of_their_own_vocabulary_are_found_whatever_the_basis(spark):
    rng = random.Random(12)
    items = [(i, " ".join(f"w{rng.randrange(10**9):x}" for _ in range(30))) for i in range(150)]
    docs = [(i, d.prose(rng, 80) + " " + t + " " + d.prose(rng, 80)) for i, t in items] + [(1000 + i, d.prose(rng, 200)) for i in range(60)]
    c = decontaminate.Config(rank=8, sample_passages=40, block_items=20)       # many blocks, a basis too small for the items
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                              spark.createDataFrame(items, "item_id long, text string"), config=c).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i, _ in items}


def test_basis_is_fitted_on_every_passage(spark):
    c = decontaminate.Config(rank=130)
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(4) for _ in range(64))) for i in range(30)]        # four passages of a word each
    fitted = decontaminate.Retriever(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                     spark.createDataFrame([(1, "another item of six words")], "item_id long, text string"), config=c)
    words = [f"w{i}x{k}" for i in range(30) for k in range(4)]
    w = decontaminate._words(*tx.column_bytes(pa.array(words, pa.string())))
    kept = np.linalg.norm(fitted.basis[decontaminate._bucket(w.hashes(), c)], axis=1)
    assert len(kept) == 120 and kept.min() > 0.99


def test_given_leaks_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if len(t.split()) >= 8 and t in r["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert want and len(want & got) >= 0.99 * len(want) and len(got - want) <= 0.1 * len(want)


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        item = decontaminate.Item(0, np.array(a, np.uint64), set())
        assert decontaminate.common_subsequence(decontaminate._masks(item), len(a), b) == best[-1][-1]


def check_scores(docs, rows, config=None):
    count = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            count.update(d.words(t) + ["\n"])
    total, types = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in lm_bloom.score_documents(docs, config=config).collect()}
    assert len(got) == len(rows)
    sums = [0.0, 0.0]
    for i, t in rows:
        tokens, r = d.words(t) + ["\n"], got[i]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[w] > 0 for w in tokens), total)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0) and r["score"] < 0
        if r["held_out"]:
            sums[0] += r["score"]
            sums[1] += base
    return sums


def test_scores_match_brute_force_and_beat_the_base(spark):
    rows = [(r[0], r[1]) for r in d.rows()]
    check_scores(d.frame(spark), rows)
    # many segments, probed where they are built
    check_scores(d.frame(spark), rows, lm_bloom.Config(capacity=500, segment_bytes=9000, block_bytes=3000))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    score, base = check_scores(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert score > base


def test_scores_without_training_rows(spark):
    empty = d.frame(spark).limit(0)
    assert lm_bloom.score_documents(empty).count() == 0
    # doc_id 7: held out, nothing to learn from
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm_bloom.score_documents(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0)


def test_filter_levels_are_those_of_the_counts(spark):
    ws = lm_bloom.Workspace(spark, "test-levels")
    c = lm_bloom.Config()
    model = lm_bloom.fit(d.frame(spark), ws, config=c)
    got = model.filter.probe(model.word_key, 1)
    want = np.array([1 + math.floor(math.log(n) / math.log(c.base) + 1e-9) for n in model.word_count])
    assert len(got) and (got >= want).all() and (got == want).mean() > 0.98


SMALL = lm_bloom.Config(capacity=500, segment_bytes=9000, block_bytes=3000)     # many segments, none broadcast


def test_every_block_of_texts_is_a_row_group(spark):
    """A reader decodes a row group at once: it must not hold more with more blocks in a file."""
    docs, ws = d.frame(spark).coalesce(1), lm_bloom.Workspace(spark, "test-blocks")
    lm_bloom.score_with(docs, ~lm_bloom.held_out(docs["doc_id"]), ws, config=SMALL).count()
    assert len(d.row_groups(f"{ws.path}/blocks")) > 3 and set(d.row_groups(f"{ws.path}/blocks")) == {1}


def test_every_gram_stays_in_the_filter_and_segments_score_alike(spark):
    docs, texts, c = d.frame(spark), [r[1] for r in d.rows() if zlib.crc32(str(r[0]).encode()) % 10], SMALL
    seqs = [["\n", *d.words(t), "\n"] for t in texts]
    # an n-gram of level q is q entries, so a single one that is missing shows
    counts = [collections.Counter(tuple(s[i:i + n]) for s in seqs for i in range((n == 1), len(s) - n + 1)) for n in (1, 2, 3)]
    entries = [sum(1 + math.floor(math.log(k) / math.log(c.base) + 1e-9) for k in x.values()) for x in counts]
    ws = lm_bloom.Workspace(spark, "test-grams")
    lm_bloom.score_with(docs, ~lm_bloom.held_out(docs["doc_id"]), ws, config=c).count()
    about = [r for r in ws.get("told").collect() if r["block"] == -1]
    assert len(about) > 8 and [sum(r["entries"][n] for r in about) for n in range(3)] == entries
    with pytest.raises(ValueError, match="score_with"):
        lm_bloom.fit(docs, ws, config=c)
    whole = {r["doc_id"]: r for r in lm_bloom.score_documents(docs).collect()}
    parts = {r["doc_id"]: r for r in lm_bloom.score_documents(docs, config=c).collect()}
    assert whole.keys() == parts.keys() and len(whole) == docs.count()
    assert all(whole[i]["n_known"] == parts[i]["n_known"] for i in whole)
    # segments of other sizes have other false positives: rare, and of the lowest levels
    assert sum(math.isclose(whole[i]["score"], parts[i]["score"], rel_tol=0.02) for i in whole) == len(whole)


def brute_score(tokens, counts, total, types, c):
    """The interpolated model over exactly quantised counts, token by token."""
    def level(n):
        return 1 + math.floor(math.log(n) / math.log(c.base) + 1e-9) if n else 0

    by_level = collections.defaultdict(list)
    for n in counts[0].values():
        by_level[level(n)].append(n)
    sums, whole = 0.0, ["\n", *tokens]
    floor = total + c.smooth * (types + 1)
    for i in range(1, len(whole)):
        of = by_level[level(counts[0][tuple(whole[i:i + 1])])]
        p = (sum(of) / len(of) if counts[0][tuple(whole[i:i + 1])] else c.smooth) / floor
        for n in (2, 3):
            if i - n + 1 < 0:
                continue
            gram, context = tuple(whole[i - n + 1:i + 1]), tuple(whole[i - n + 1:i])
            q, held = level(counts[n - 1][gram]), level(counts[n - 2][context])
            if held:
                low = math.ceil(c.base ** (q - 1) - 1e-6) if q else 0
                most = math.ceil(c.base ** held - 1e-6) - 1
                p = (1 - c.weights[n - 2]) * p + c.weights[n - 2] * min(1, max(0, low - c.discount) / max(1, most))
        sums += math.log10(p)
    return sums


@pytest.mark.parametrize("capacity", [1 << 22, 500])
def test_scores_are_those_of_exactly_quantised_counts(spark, capacity):
    # filters with room enough to have no false positive
    c = lm_bloom.Config(capacity=capacity, segment_bytes=9000, block_bytes=3000, bits_per_entry=60, probes=16)
    rows = [(r[0], r[1]) for r in d.rows()]
    seqs = [["\n", *d.words(t), "\n"] for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    counts = [collections.Counter(tuple(s[i:i + n]) for s in seqs for i in range((n == 1), len(s) - n + 1)) for n in (1, 2, 3)]
    got = {r["doc_id"]: r["score"] for r in lm_bloom.score_documents(d.frame(spark), config=c).collect()}
    for i, t in rows:
        want = brute_score([*d.words(t), "\n"], counts, sum(counts[0].values()), len(counts[0]), c)
        assert math.isclose(got[i], want, rel_tol=1e-9), (i, got[i], want)


def test_repeated_texts_score_above_single_ones(spark):
    rng = random.Random(8)
    texts = [d.prose(rng, 200) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:10])], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in lm_bloom.score_documents(docs).collect()}
    taught = [i for i in got if zlib.crc32(str(i).encode()) % 10]
    twice = [got[i] for i in taught if i < 10 and i + 60 in taught]
    assert min(twice) > max(got[i] for i in taught if 10 <= i < 60)


def test_leaks_prune_keeps_every_pair_that_verification_accepts():
    config, rng = decontaminate.Config(), np.random.default_rng(5)
    vocabulary = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    items = [decontaminate.Item(k, vocabulary[rng.integers(0, 60, rng.integers(5, 33))], set()) for k in range(40)]
    for x in items:
        x.answer = set(x.words[-5:].tolist())
    scale = decontaminate.Scale(32, items, np.ones((1 << config.buckets_log2, 2), np.float32), config)
    h = np.concatenate([x.words[rng.random(len(x.words)) < keep] for keep in (1.0, 0.7, 0.5, 0.0) for x in items])
    lead = np.arange(0, len(h), 7)
    stop = np.minimum(lead + 40, len(h))
    window, item = (x.ravel() for x in np.meshgrid(np.arange(len(lead)), np.arange(len(items)), indexing="ij"))
    likely = scale.sharing(decontaminate._slot(h), lead, stop, window, item)
    accepted = np.array([decontaminate.verdict(items[x], scale.masks[x], h[lead[k]:stop[k]].tolist(), config)[2]
                         for k, x in zip(window, item)])
    assert accepted.sum() > 50 and not (accepted & ~likely).any() and (~likely).any()
