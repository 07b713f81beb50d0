"""Filter interaction audit (operator 13) against brute force."""

import collections
from itertools import permutations

import duckdb
import pytest

from millrace.llm import filter_audit as fa
from millrace.llm import queries
from tests.llm import data as d

SMALL = fa.Config(block_bytes=3000, bucket_bytes=2000)


def table_rows():
    rows = d.rows()
    long = rows[-1]
    shout = (500, "LOUD Words here " * 30, "en", "s1", *rows[0][4:])
    money = (501, "price $ " + d.prose(__import__("random").Random(8), 80), "en", None, *rows[0][4:])
    return rows + [shout, money, (502, money[1], "en", "", *rows[0][4:]), (None, money[1], *rows[0][2:]), (None, None, *rows[0][2:]),
                   (7, shout[1], "en", "s1", *rows[0][4:]), (500, *shout[1:]), (600, long[1], *long[2:])]


def labels_rows():
    return [(0, 1, 0), (0, 0, 0), (11, 0, 1), (12, 1, 1), (40, 1, 0), (500, 1, 0), (500, 0, 1), (501, None, 1), (77777, 1, 1)]


def words(t):
    return d.WORD.findall(t or "")


def brute(rows, labels):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(r[0], least.get(r[1] or "", r[0]))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out = collections.defaultdict(lambda: [0] * 6)
    share = collections.Counter()
    for r in rows:
        t, part = r[1] or "", r[3] or ""
        w = words(t)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
               "D": any(c in "#$%&*|" for c in t), "E": r[0] is not None and least[t] < r[0]}
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                v = out[part, "".join(order), step]
                removed = bad[f] and not gone
                v[0] += not gone and not bad[f]
                v[1] += removed
                v[2] += bad[f] and gone
                v[3] += bad[f] and sum(bad.values()) == 1
                v[4] += removed and r[0] in good
                v[5] += removed and r[0] in toxic
                share[part, f] += removed
                gone = gone or bad[f]
    return {(p, o, s): (*v, share[p, o[s - 1]]) for (p, o, s), v in out.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return d.frame(spark, table_rows()).cache()


def test_audit_matches_brute_force(spark, docs):
    labels = spark.createDataFrame(labels_rows(), "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in fa.filter_audit(docs, labels, config=SMALL).collect()}
    want = brute(table_rows(), labels_rows())
    assert got == want and len(got) == 600 * 4
    assert all(sum(v[i] for v in want.values()) for i in range(7))
    none = labels.limit(0)
    assert {k: v[:4] for k, v in want.items()} == {tuple(r)[:3]: tuple(r)[3:7] for r in fa.filter_audit(docs, none).collect()}
    assert fa.filter_audit(docs.limit(0), labels).count() == 0


def test_matrix_is_the_document_term_matrix(docs):
    for config in (SMALL, fa.Config()):
        shards, dictionary = fa.matrix(docs, config=config)
        word = {r.column: r.word for r in dictionary.collect()}
        got = []
        for s in shards.collect():
            assert len(s.pointers) == len(s.ids) + 1 and s.pointers[-1] == len(s.columns) == len(s.counts)
            for i, k in enumerate(s.ids):
                a, b = s.pointers[i], s.pointers[i + 1]
                assert len(set(s.columns[a:b])) == b - a
                got.append((k, sorted((word[c], n) for c, n in zip(s.columns[a:b], s.counts[a:b]))))
        want = [(r[0], sorted(collections.Counter(words(r[1])).items())) for r in table_rows()]
        key = lambda x: (x[0] is None, x[0] or 0, x[1])        # noqa: E731
        assert sorted(got, key=key) == sorted(want, key=key)
        used = {w for r in table_rows() for w in words(r[1])}
        assert set(word.values()) == used and len(word) == len(used)        # one column a word


def test_words_travel_once_a_block(spark):
    """A frequent word is one entry of a block, and rows sent never outnumber words."""
    rows = [(i, "the the the common " + "w%d" % i, *d.rows()[0][2:]) for i in range(400)]
    src = d.frame(spark, rows).selectExpr("doc_id AS id", "'' AS part", "unhex('00') AS key", "text")
    blocks = fa._blocks(src, 5, fa.Rules(), fa.Config(block_bytes=1500)).collect()
    assert sum(len(b.docs) for b in blocks) == 400
    for b in blocks:
        sent = [w for s in b.sent for w in s.words]
        assert len(sent) == len(set(sent)) and sent.count("the") == 1
        assert len(b.sent) <= min(5, len(sent)) and all(s.words for s in b.sent)


def test_every_block_is_a_row_group(spark):
    """A reader decodes a row group at once: it must not hold more with more blocks in a file."""
    encoded, _ = fa._encoded(d.frame(spark).coalesce(1), "doc_id", "text", "source", fa.Rules(), SMALL)
    folder = next(f.rsplit("/", 1)[0] for f in encoded.inputFiles() if "/blocks/" in f)
    assert len(d.row_groups(folder)) > 3 and set(d.row_groups(folder)) == {1}


def test_query_matches_its_sql(spark, docs, tmp_root):
    labels = spark.createDataFrame([r for r in labels_rows()], "doc_id long, quality int, toxic int")
    plain = docs.where("doc_id is not null")
    plain.write.parquet(f"{tmp_root}/documents.parquet")
    labels.write.parquet(f"{tmp_root}/labels.parquet")
    got = queries.op13_filter_audit(spark, tmp_root)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_root}/{t}.parquet/*.parquet')")
    want = con.execute(queries.ORACLES["op13_filter_audit"])
    assert [c[0] for c in want.description] == got.columns
    assert sorted(want.fetchall()) == sorted(map(tuple, got.collect()))
