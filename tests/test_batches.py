"""Committed reads, change tracking of derived batches, marts merged from partial aggregates."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import bronze as bronze_ops
from millrace.operators import marts
from millrace.plans import ledger as L
from millrace.plans import models
from millrace.plans.fixtures import ERP_SOURCE_COLUMNS, FIXTURE_AS_OF, WORKFLOW_SOURCE_COLUMNS, bronze
from millrace.plans.pipeline import load_files
from millrace.store import TableStore
from tests.conftest import SF_SMALL


@pytest.fixture()
def wh(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    ledger = L.Ledger(spark, store)
    ledger.initialize()
    return store, ledger


def _record(ledger, pipeline, run_id, status="SUCCESS"):
    row = (pipeline, f"/src/{run_id}.csv", "h", 1, None, L.now(), run_id, 1, status, None)
    ledger.append_frame("metadata.file_history", ledger.spark.createDataFrame([row], L.FILE_HISTORY))


def _land(store, run_id, ids, replace=False, pipeline="erp"):
    df = store.spark.createDataFrame([(f"S{i}", f"I{i}", "1.50") for i in ids], "SUPPLIER_ID string, INVOICE_NUMBER string, UNIT_PRICE string")
    df = df.withColumn("_source_file", F.lit(f"/src/{run_id}.csv"))
    bronze_ops.land(store, "bronze.erp", [(df.columns[:-1], df)], run_id, L.now(), replace=replace, batch_id=f"{pipeline}.{run_id}")


def _ids(store, table="bronze.erp", col="SUPPLIER_ID"):
    return sorted(r[0] for r in store.read(table).select(col).collect())


def test_rows_of_an_unrecorded_run_are_not_visible(wh):
    store, ledger = wh
    _land(store, "r1", [1])
    assert not store.exists("bronze.erp") and store.committed("bronze.erp") == []
    with pytest.raises(RuntimeError, match="has not been loaded"):
        models.build(store, "stg_erp")
    _record(ledger, "erp", "r1")
    _land(store, "r2", [2, 3])
    _record(ledger, "erp", "r2", status="FAILED")
    _record(ledger, "other", "r2")                       # another pipeline's run of that name
    before = store.read("bronze.erp")
    assert _ids(store) == ["S1"]
    models.build(store, "stg_erp dim_invoice fact_invoice erp", FIXTURE_AS_OF)
    for table in ("silver.erp", "mart.erp", "mart.dim_invoice", "mart.fact_invoice"):
        assert _ids(store, table, "supplier_id") == ["S1"]
    _record(ledger, "erp", "r2")
    assert _ids(store) == ["S1", "S2", "S3"]
    assert before.count() == 1                           # a reader keeps the state it began with
    models.build(store, "erp", FIXTURE_AS_OF)            # Silver wasn't brought up yet
    assert _ids(store, "mart.erp", "supplier_id") == ["S1"]
    models.build(store, "+erp", FIXTURE_AS_OF)
    assert _ids(store, "mart.erp", "supplier_id") == ["S1", "S2", "S3"]


def test_batches_written_outside_a_pipeline_count_at_once(wh):
    store, _ = wh
    df = store.spark.createDataFrame([("a",)], "customer_id string")
    bronze_ops.append_dataframe(store, "bronze.customer", df, "/src/a.csv", "run-1", L.now())
    assert store.read("bronze.customer").count() == 1
    for odd in ("7", "x y%+", "[q]*?{z}"):               # ids that look like numbers, escapes or patterns
        store.write_batch("bronze.odd", df, odd)
    assert store.read("bronze.odd").count() == 3 and store.read_batch("bronze.odd", "[q]*?{z}").count() == 1
    assert set(store.marks("bronze.odd", "_id-")) == {"7", "x y%+", "[q]*?{z}"}


def test_a_replace_load_counts_when_it_is_recorded(wh):
    store, ledger = wh
    for r in ("r1", "r2"):
        _land(store, r, [int(r[1])])
        _record(ledger, "erp", r)
    store.write_batch("bronze.erp", store.read_batch("bronze.erp", "erp.r1"), "by-hand")
    _land(store, "r3", [8, 9], replace=True)
    assert _ids(store) == ["S1", "S1", "S2"]             # as before: the run isn't recorded
    _record(ledger, "erp", "r3")
    assert _ids(store) == ["S8", "S9"]                   # from here on, cleaned up or not
    _land(store, "r4", [10])                             # the next load cleans up
    assert sorted(store.batches("bronze.erp")) == ["erp.r3", "erp.r4"] and _ids(store) == ["S8", "S9"]
    _record(ledger, "erp", "r4")
    assert _ids(store) == ["S10", "S8", "S9"]
    store.write_batch("bronze.erp", store.read_batch("bronze.erp", "erp.r4"), "by-hand")
    assert _ids(store) == ["S10", "S10", "S8", "S9"]


def test_an_unrecorded_replace_load_loses_nothing(wh):
    store, ledger = wh
    _land(store, "r1", [1])
    _record(ledger, "erp", "r1")
    _land(store, "lost", [5], replace=True)
    _land(store, "r2", [2])
    _record(ledger, "erp", "r2")
    assert _ids(store) == ["S1", "S2"]


def test_a_run_that_fails_before_its_history_leaves_no_rows(spark, wh, tmp_root, monkeypatch):
    store, ledger = wh
    os.makedirs(f"{tmp_root}/src")
    cfg = {"source_folder": "src", "source_pattern": "*.csv", "bronze_table": "bronze.erp"}

    def load(run):
        return load_files(spark, store, ledger, "erp", cfg, tmp_root, run, L.now())
    for n, run in ((1, "r1"), (2, "r2")):
        with open(f"{tmp_root}/src/{n}.csv", "w") as fh:
            fh.write(f"SUPPLIER_ID,INVOICE_NUMBER\nS{n},I{n}\n")
        if run == "r2":
            with monkeypatch.context() as m:
                m.setattr(L.Ledger, "record_files", lambda *a: (_ for _ in ()).throw(OSError("down")))
                with pytest.raises(OSError):
                    load("crashed")
            assert "erp.crashed" in store.batches("bronze.erp") and _ids(store) == ["S1"]
            models.build(store, "stg_erp")
            assert _ids(store, "silver.erp", "supplier_id") == ["S1"]
        load(run)
    assert _ids(store) == ["S1", "S2"] and sorted(store.batches("bronze.erp")) == ["erp.r1", "erp.r2"]
    load_files(spark, store, ledger, "erp", {**cfg, "append": False}, tmp_root, "full", L.now())
    assert store.batches("bronze.erp") == ["erp.full"] and _ids(store) == ["S1", "S2"]


def _part_files(store, table):
    root = store.path(table)
    return {n: sorted(os.listdir(f"{root}/{n}")) for n in os.listdir(root) if n.startswith("_batch=")}


def test_a_rewritten_batch_rebuilds_exactly_what_follows_it(wh, monkeypatch):
    store, ledger = wh
    for r, ids in (("r1", [1]), ("r2", [2])):
        _land(store, r, ids)
        _record(ledger, "erp", r)
    models.build(store, "+erp", FIXTURE_AS_OF)
    tables = ("silver.erp", "mart.fact_invoice", "state.invoice")
    first = {t: _part_files(store, t) for t in tables}
    models.build(store, "+erp", FIXTURE_AS_OF)
    assert {t: _part_files(store, t) for t in tables} == first                # nothing changed, nothing written
    _land(store, "r2", [2, 4, 4])                                             # the run lands its batch again
    models.build(store, "+erp", FIXTURE_AS_OF)
    again = {t: _part_files(store, t) for t in tables}
    for t in tables:
        assert again[t]["_batch=erp.r1"] == first[t]["_batch=erp.r1"] and again[t]["_batch=erp.r2"] != first[t]["_batch=erp.r2"]
    assert _ids(store, "silver.erp", "supplier_id") == ["S1", "S2", "S4", "S4"]
    got = {r.supplier_id: r.source_row_count for r in store.read("mart.erp").collect()}
    assert got == {"S1": 1, "S2": 1, "S4": 2}
    # changed column specs or casts rebuild Silver and so what follows it; changed aggregates don't touch Silver
    real = models.rules_digest
    monkeypatch.setattr(models, "rules_digest", lambda m: real(m) + ("x" if m is models.MART_RULES else ""))
    models.build(store, "+erp", FIXTURE_AS_OF)
    marts_only = {t: _part_files(store, t) for t in tables}
    assert marts_only["silver.erp"] == again["silver.erp"]
    assert all(marts_only[t][b] != again[t][b] for t in tables[1:] for b in again[t])
    monkeypatch.setattr(models, "rules_digest", lambda m: real(m) + "y")
    models.build(store, "stg_erp", FIXTURE_AS_OF)
    assert all(_part_files(store, "silver.erp")[b] != again["silver.erp"][b] for b in again["silver.erp"])


def test_rules_digest_follows_the_code():
    assert models.rules_digest(models.SILVER_RULES) == models.rules_digest(models.SILVER_RULES)
    assert models.rules_digest(models.SILVER_RULES) != models.rules_digest(models.MART_RULES)


def _batches_of(spark, name, columns, key, n):
    df = bronze(spark, SF_SMALL, name).select(*columns, "_source_file", "_loaded_at", "_run_id")
    return [df.where(F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(n)) == i) for i in range(n)]


def test_merged_marts_equal_a_full_rebuild_and_read_one_new_batch(spark, wh, monkeypatch):
    store, _ = wh
    erp = _batches_of(spark, "erp", ERP_SOURCE_COLUMNS, "ERP_RECORD_ID", 3)
    flow = _batches_of(spark, "workflow", WORKFLOW_SOURCE_COLUMNS, "WORKFLOW_EVENT_ID", 3)
    whole, single = TableStore.read, TableStore.read_batch
    seen = []

    def read(self, table):
        assert table not in ("silver.erp", "silver.workflow", "bronze.erp", "bronze.workflow") or not seen, f"{table} was read whole"
        return whole(self, table)

    def read_batch(self, table, batch):
        seen.append((table, batch))
        return single(self, table, batch)

    def compare():
        lines, events = whole(store, "silver.erp"), whole(store, "silver.workflow")
        for table, want in (("mart.erp", marts.mart_erp(lines, FIXTURE_AS_OF)), ("mart.dim_invoice", marts.dim_invoice(lines)),
                            ("mart.workflow", marts.mart_workflow(events, marts.dim_invoice(lines))),
                            ("mart.fact_invoice", marts.fact_invoice(lines)), ("mart.fact_workflow_event", marts.fact_workflow_event(events))):
            got = whole(store, table)
            assert got.dtypes == want.dtypes, table
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, table

    models_of_all = "+tag:workflow tag:erp"
    for i in range(2):
        store.write_batch("bronze.erp", erp[i], f"b{i}")
        store.write_batch("bronze.workflow", flow[i], f"b{i}")
    models.build(store, models_of_all, FIXTURE_AS_OF)
    compare()
    store.write_batch("bronze.erp", erp[2], "b2")
    store.write_batch("bronze.workflow", flow[2], "b2")
    from millrace.operators import quality
    with monkeypatch.context() as m:
        m.setattr(TableStore, "read", read)
        m.setattr(TableStore, "read_batch", read_batch)
        m.setattr(quality, "run_tests", lambda df, name: [])
        m.setattr(quality, "assert_passing", lambda report: None)
        seen.append(("start", ""))
        # counting the report's rows reads Silver once more; the models themselves must not
        for model in models.select(models_of_all):
            derived = model.per_batch or model.partial
            models.follow(store, derived, model.name if model.per_batch else None)
            if model.merge:
                store.overwrite(model.table, model.merge(store.read(derived.table), store, FIXTURE_AS_OF))
    assert {b for t, b in seen[1:]} == {"b2"} and len(seen) == 1 + 6
    compare()
    store.drop_batch("bronze.erp", "b1")
    store.drop_batch("bronze.workflow", "b0")
    models.build(store, models_of_all, FIXTURE_AS_OF)
    compare()
    assert {len(store.batches(t)) for t in ("state.invoice", "state.invoice_flow", "mart.fact_invoice", "silver.workflow")} == {2}


def test_partials_merge_to_the_same_rows_however_events_are_cut(spark):
    rng, base = random.Random(4), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        rows.append((f"S{rng.randrange(3)}", f"I{rng.randrange(4)}", f"e{i}", f"w{i % 5}", rng.choice([None, "1", "2", "10"]),
                     rng.choice([None, "A", "B", "C"]), rng.choice([None, "open", "paid"]),
                     None if rng.random() < .2 else base + dt.timedelta(hours=rng.randrange(5)), rng.choice([None, "late"]),
                     None if rng.random() < .2 else rng.randrange(9)))
    rows.append(("S9", "I9", "solo", "w", None, None, None, None, None, None))
    df = spark.createDataFrame(rows, "supplier_id string, invoice_number string, workflow_event_id string, workflow_id string, "
                                     "event_sequence string, workflow_stage string, current_status string, event_timestamp timestamp_ntz, "
                                     "exception_reason string, invoice_amount_usd int")
    df = df.withColumn("invoice_amount_usd", F.col("invoice_amount_usd").cast("decimal(18,2)"))
    want = marts.workflow_totals(df)
    for n in (1, 2, 7):
        part = F.pmod(F.crc32(F.col("workflow_event_id").cast("binary")), F.lit(n))
        parts = marts.workflow_partial(df.where(part == 0))
        for i in range(1, n):
            parts = parts.unionByName(marts.workflow_partial(df.where(part == i)))
        got = marts.merge_workflow(parts)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("single", [False, True])
def test_an_export_is_whole_or_as_before(spark, wh, tmp_root, monkeypatch, single):
    from millrace.plans.export import export_tables
    from millrace.store import HadoopFS
    store, _ = wh
    out = f"{tmp_root}/out/mart_t.parquet"

    def export(n):
        store.overwrite("mart.t", spark.range(n))
        return export_tables(store, ["mart.t"], f"{tmp_root}/out", csv=True, single_file=single)
    assert export(3)[0] == out and os.path.isfile(out) == single
    assert spark.read.parquet(out).count() == 3 and sorted(os.listdir(f"{tmp_root}/out"))[0] != ".__tmp"
    real, before = HadoopFS.rename, []

    def watched(self, src, dst):
        if src == out:                   # the last moment before the new one takes its place
            before.append(spark.read.parquet(out).count())
        if dst == out and ".__tmp" in src and len(before) == 2:
            return False                 # the move fails
        return real(self, src, dst)
    monkeypatch.setattr(HadoopFS, "rename", watched)
    export(5)
    assert before == [3] and spark.read.parquet(out).count() == 5
    with pytest.raises(RuntimeError, match="could not rename"):
        export(7)
    assert before == [3, 5] and spark.read.parquet(out).count() == 5


def _files(store, table):
    return [n for n in store.fs.list_names(store.path(table)) if not n.startswith((".", "_"))]


def test_ledger_files_stay_bounded_and_no_record_is_lost(wh):
    store, ledger = wh
    history = "metadata.file_history"
    for run in range(5):
        for part in range(3):
            _record(ledger, "erp", f"r{run}-{part}")
        before = store.read(history)
        ledger.fold(keep=4)
        assert before.distinct().count() == 3 * run + 3              # a reader that began before the fold
        assert ledger.raw(history).count() == 3 * run + 3
        assert ledger.latest(history).count() == 3 * run + 3
        assert len(_files(store, history)) <= 2 * (4 + 3) + 1        # the live ones and those of the last fold
    assert ledger.raw("metadata.watermark").count() == 0


def test_a_fold_that_crashes_leaves_every_record_once(wh, monkeypatch):
    store, ledger = wh
    history = "metadata.file_history"
    for run in range(6):
        _record(ledger, "erp", f"r{run}")
    _land(store, "r5", [1])
    move = TableStore._move
    for failing in range(3):                  # the folded file's move, the note's, the note's over an earlier one
        calls = iter(range(100))

        def breaks(self, src, dst, failing=failing, calls=calls):
            if next(calls) == failing:
                raise RuntimeError("lost")
            move(self, src, dst)

        with monkeypatch.context() as m:
            m.setattr(TableStore, "_move", breaks)
            try:
                ledger.fold(keep=2)
            except RuntimeError:
                pass
        assert sorted(r.run_id for r in ledger.raw(history).collect()) == [f"r{k}" for k in range(6)]
        assert _ids(store) == ["S1"]
        for again in range(3):
            _record(ledger, "erp", "r0")      # more files; another record of a known run
        assert ledger.latest(history).where("run_id = 'r0'").count() == 1
        assert sorted({r.run_id for r in ledger.raw(history).collect()}) == [f"r{k}" for k in range(6)]
        monkeypatch.undo()
        ledger.fold(keep=2)
        assert sorted({r.run_id for r in ledger.raw(history).collect()}) == [f"r{k}" for k in range(6)]
        store.drop(history)
        ledger.initialize()
        for run in range(6):
            _record(ledger, "erp", f"r{run}")


def test_batches_are_written_without_dictionaries(wh, spark):
    """Dictionaries cost wide text more time, when written and when read, than they save."""
    import pyarrow.parquet as pq
    store, _ = wh
    rows = bronze(spark, SF_SMALL, "erp").select(*ERP_SOURCE_COLUMNS, "_source_file", "_loaded_at", "_run_id")
    store.write_batch("bronze.erp", rows, "one")
    models.build(store, "stg_erp")
    assert store.read("silver.erp").count() > 0
    for table in ("bronze.erp", "silver.erp"):
        metas = [pq.ParquetFile(p[len("file:"):]).metadata for p, _, _ in store.fs.glob(f"{store.path(table)}/_batch=one/*.parquet")]
        used = {e for m in metas for i in range(m.num_row_groups) for c in range(m.num_columns) for e in m.row_group(i).column(c).encodings}
        assert "PLAIN" in used and not used & {"RLE_DICTIONARY", "PLAIN_DICTIONARY"}
