"""AvailableNow file-stream ingest: every file once, restarts add nothing."""

import os

from millrace.plans.ledger import Ledger
from millrace.store import TableStore
from millrace.streaming.ingest import stream_ingest


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_stream_ingest_exactly_once(spark, tmp_root):
    src = f"{tmp_root}/in"
    _write(f"{src}/a.csv", "customer_id,customer_name\n1,Ada\n2,Bo\n")
    store = TableStore(spark, f"{tmp_root}/wh")
    ledger = Ledger(spark, store)
    ledger.initialize()
    ckpt = f"{tmp_root}/ckpt"
    first = stream_ingest(spark, store, ledger, "customer", src, "bronze.customer", ckpt)
    assert len(first) == 1 and store.read("bronze.customer").count() == 2
    assert stream_ingest(spark, store, ledger, "customer", src, "bronze.customer", ckpt) == []
    _write(f"{src}/b.csv", "customer_id,customer_name\n3,Cy\n")
    stream_ingest(spark, store, ledger, "customer", src, "bronze.customer", ckpt)
    rows = sorted((r.customer_id, r.customer_name, os.path.basename(r._source_file))
                  for r in store.read("bronze.customer").collect())
    assert rows == [("1", "Ada", "a.csv"), ("2", "Bo", "a.csv"), ("3", "Cy", "b.csv")]
    hist = ledger.raw("metadata.file_history")
    assert sorted(r.row_count for r in hist.collect()) == [1, 2]


def test_stream_takes_hidden_names_and_patterns_with_folders(spark, tmp_root):
    src = f"{tmp_root}/in[1]"
    for k, name in enumerate(("a/x.csv", "b/_y.csv", "b/.z.csv", "b/w.csv", "top.csv", "b/no.txt")):
        _write(f"{src}/{name}", f"customer_id,customer_name\n{k},n{k}\n")
    store = TableStore(spark, f"{tmp_root}/wh")
    ledger = Ledger(spark, store)
    ledger.initialize()
    for times in range(2):
        ids = stream_ingest(spark, store, ledger, "customer", src, "bronze.customer", f"{tmp_root}/ckpt", pattern="*/*.csv")
        assert bool(ids) == (times == 0)
        got = sorted((r.customer_id, r._source_file) for r in store.read("bronze.customer").collect())
        assert got == [(str(k), f"{src}/{n}") for k, n in enumerate(("a/x.csv", "b/_y.csv", "b/.z.csv", "b/w.csv"))]
    assert sorted(r.source_file for r in ledger.raw("metadata.file_history").collect()) == sorted(x for _, x in got)
