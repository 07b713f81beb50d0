"""Rows are dealt over tasks before wide text columns are derived from them; a stream carries paths only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.plans import catalog
from millrace.plans.fixtures import ERP_SOURCE_COLUMNS, bronze
from millrace.streaming.ingest import path_stream


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(1995, 1, 3)
    lines = [(o, n, 10 * o + n, n, 5.0, 100.25 + n, 0.04, day) for o in range(1, 60) for n in (1, 2)] + [(7, 1, 71, 1, 5.0, 101.25, 0.04, day)]
    orders = [(o, o % 9, "OFP"[o % 3], 10.5 * o, day, "1-URGENT") for o in range(1, 60)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                                 "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                  "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_wide_rows_are_not_shuffled(spark, tables):
    df = bronze(spark, tables, "erp", spread=True).select(*ERP_SOURCE_COLUMNS)
    lines = _plan(df).splitlines()
    shuffle = next(i for i, x in enumerate(lines) if "RepartitionByExpression" in x)
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert join < shuffle and "ERP_RECORD_ID" in lines[0]            # below the join, so before the text columns
    assert df.exceptAll(bronze(spark, tables, "erp").select(*ERP_SOURCE_COLUMNS)).count() == 0
    assert df.count() == 119


def test_files_are_sorted_before_the_text_is_derived(spark, tables, monkeypatch):
    seen = []
    real = catalog.src_files.discover
    monkeypatch.setattr(catalog.src_files, "discover", lambda spark, folder, pattern, **k: seen.append(folder) or real(spark, folder, pattern, **k))
    files = catalog._erp_files(spark, tables, f"{tables}/out").collect()
    assert len(files) == 1 and files[0].path.startswith(f"{tables}/out/erp/file=0/")
    text = spark.read.option("multiLine", "true").option("header", "true").option("escape", '"').csv(files[0].path)
    ids = [r[0] for r in text.select("ERP_RECORD_ID").collect()]
    assert len(ids) == 119 and ids == sorted(ids)
    assert text.where(F.col("REGION").endswith("\nx")).count() == 119


def test_lineage_doesnt_shuffle_the_rows(spark, tmp_path):
    store, ledger = catalog._store(spark, str(tmp_path))
    spark.createDataFrame([("a", "/in/f.csv", "r"), ("b", "/in/f.csv", "r")], "x string, _source_file string, _run_id string").write.parquet(
        f"{store.root}/bronze/t/_batch=one")
    rows = catalog._lineage(store, ledger, "bronze.t")
    assert sorted((r.x, r.source_folder, r.in_history) for r in rows.collect()) == [("a", "in", False), ("b", "in", False)]
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "rightHint=(strategy=broadcast)" in _plan(catalog._lineage(store, ledger, "bronze.t"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_the_stream_carries_one_row_per_file(spark, tmp_path):
    folder = tmp_path / "in 5%+ [x]"
    folder.mkdir()
    for n in range(3):
        (folder / f"f {n}+%.csv").write_text("a,b\n" + "1,2\n" * 50)
    query = (path_stream(spark, str(folder), "*.csv").writeStream.format("memory").queryName("paths_seen")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert {r.path for r in spark.table("paths_seen").collect()} == {f"{folder}/f {n}+%.csv" for n in range(3)}
    assert query.lastProgress.numInputRows < 20         # of files, not of their 150 lines
