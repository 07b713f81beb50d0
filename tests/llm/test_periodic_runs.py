"""Periodic runs (operator 11) against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import periodic_runs as pr
from millrace.llm import queries
from millrace.llm import text as tx
from tests.llm import data as d


def brute(x, least=12):
    """Every stretch of every period, kept when no smaller period fits it."""
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q) and not any(
                    all(x[t] == x[t + p] for t in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(x, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def sequences(seed, count):
    rng = random.Random(seed)
    fib = ["0", "01"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    for _ in range(count):
        n, letters = rng.choice((0, 5, 11, 12, 13, 60, 200, 400)), rng.choice((1, 2, 3, 900))
        x = [str(rng.randrange(letters)) for _ in range(n)]
        kind = rng.randrange(5)
        if kind == 1 and n:          # periodic to the end
            p, s = rng.randint(1, max(1, n // 3)), rng.randrange(n)
            x[s:] = [x[s + i % min(p, n - s)] for i in range(n - s)]
        elif kind == 2 and n:        # periodic with a few changes
            p = rng.randint(1, max(1, n // 3))
            x = [x[i % p] for i in range(n)]
            for _ in range(rng.randrange(4)):
                x[rng.randrange(n)] = "z"
        elif kind == 3:
            x = list(fib[-1][:n])
        elif kind == 4:
            x = [str(bin(i).count("1") % 2) for i in range(n)]
        yield x


def stitched(fragments, least):
    by = {}
    for row, q, u, v in sorted(fragments):
        parts = by.setdefault((row, q), [])
        if parts and u <= parts[-1][1]:
            parts[-1][1] = max(parts[-1][1], v)
        else:
            parts.append([u, v])
    return sorted((row, u, v - u + q, q) for (row, q), parts in by.items() for u, v in parts if v - u >= max(q, least - q))


@pytest.mark.parametrize("config", [pr.Config(), pr.Config(core=8), pr.Config(min_length=2, core=16)])
def test_tiles_solved_alone_give_all_runs(config):
    docs = list(sequences(5, 60))
    data, offsets = tx.column_bytes(pa.array([" ".join(x) for x in docs]))
    w = tx.words(data, offsets, lower=False)
    found = []
    for row, low, first, more, code, bounds in pr._tile_rows(w, w.hashes(), config):
        o = pr.octave(low.bit_length() - 1, config)
        assert len(code) <= o.core + 2 * o.reach + o.high
        found += [(row, q, first + u, first + v) for q, u, v in pr.solve(code, bounds.astype(np.int64), o, config, first > 0, more)]
    want = sorted((row, *r) for row, x in enumerate(docs) for r in brute(x, config.min_length))
    assert stitched(found, config.min_length) == want and len(want) > 100


def test_z_functions():
    rng = random.Random(2)
    for _ in range(200):
        x = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        b, o = rng.randrange(len(x)), pr.octave(rng.randrange(4), pr.Config())
        before, after, lo, hi = pr.reach_at(np.array(x), b, o)
        for j in range(1, o.high):
            r = 0
            while b + j + r < hi and x[b + r] == x[b + j + r]:
                r += 1
            f = 0
            while b + j <= len(x) and b - 1 - f >= lo and x[b - 1 - f] == x[b + j - 1 - f]:
                f += 1
            assert (before[j], after[j]) == (f, r)


def test_operator_on_awkward_rows(spark):
    rows = d.rows()
    extra = [" ".join(x) for x in sequences(9, 25)] + ["a  b\n" * 700, "x" * 9]
    rows += [(1000 + i, t, *rows[0][2:]) for i, t in enumerate(extra)]
    rows += [(None, "w " * 30, *rows[0][2:]), rows[-3], rows[-3]]        # no id; one row three times
    got = pr.periodic_runs(d.frame(spark, rows), config=pr.Config(core=64)).collect()
    assert len(got) == len(rows)
    want = []
    for r in rows:
        x = d.WORD.findall(r[1] or "")
        runs = brute(x) if len(x) < 3000 else []          # the one very long text is prose
        want.append((r[0], [tuple(q) for q in runs], collapsed(x, runs)))
    key = lambda t: (t[0] is None, t[0] or 0, t[2])        # noqa: E731
    assert sorted(((g.doc_id, [tuple(q) for q in g.runs], g.collapsed) for g in got), key=key) == sorted(want, key=key)
    assert pr.periodic_runs(d.frame(spark, rows).limit(0)).count() == 0


def test_query_rewrites_and_digests(spark, tmp_root):
    rows = [(i, t) for i, t in enumerate(" ".join(x) for x in sequences(11, 40))] + [(50, None), (51, ""), (52, " \n")]
    rows += [(i, " ".join(f"w{j}" for j in range(60))) for i in range(60, 120)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_root}/documents.parquet")
    got = {g.doc_id: g for g in queries.op11_periodic_runs(spark, tmp_root).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        w, h = d.WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = brute(w), got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert (r.n_runs, r.start, r.length, r.period) == ((len(runs), *best) if best else (0, None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 5
