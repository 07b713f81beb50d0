"""The reference's unit behaviours, on the Spark implementation."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import bronze as bronze_ops
from millrace.plans import ledger as L
from millrace.plans.export import export_tables
from millrace.sources import files as S
from millrace.sources.csv import scan_profiled
from millrace.sources.excel import scan_excel, stage_excel, write_workbook
from millrace.store import TableStore, check_table_name


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_read_config_yaml(tmp_root):
    from millrace.plans.config import read_config
    path = f"{tmp_root}/settings.yml"
    _write(path, "enabled: true\nitems:\n  - customer\n")
    assert read_config(path) == {"enabled": True, "items": ["customer"]}


def test_file_hash_is_sha256(spark, tmp_root):
    contents = "customer_id,customer_name\n1,Ada\n"
    _write(f"{tmp_root}/in/source.csv", contents)
    prof = S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv")).first()
    assert prof.file_hash == hashlib.sha256(contents.encode()).hexdigest()
    assert prof.sep == "," and list(prof.columns) == ["customer_id", "customer_name"]


def test_csv_values_stay_strings(spark, tmp_root):
    _write(f"{tmp_root}/in/source.csv", "customer_id,customer_name\n001,Ada\n")
    prof = S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv"))
    cols, df = scan_profiled(spark, prof)[0]
    assert cols == ["customer_id", "customer_name"]
    assert df.first().customer_id == "001"


def test_unsupported_extension_rejected(spark, tmp_root):
    _write(f"{tmp_root}/in/source.txt", "not a supported table")
    with pytest.raises(ValueError, match="Unsupported file"):
        S.raise_if_unsupported(S.discover(spark, f"{tmp_root}/in"))


def test_append_adds_lineage_and_loaded_check(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    ledger = L.Ledger(spark, store)
    ledger.initialize()
    df = spark.createDataFrame([("1", "Ada")], "customer_id string, customer_name string")
    n = bronze_ops.append_dataframe(store, "bronze.customer", df, "/src/source.csv", "run-1", L.now())
    row = store.read("bronze.customer").first()
    assert n == 1
    assert (row.customer_id, row.customer_name, row._source_file, row._run_id) == \
        ("1", "Ada", "/src/source.csv", "run-1")
    probe = spark.createDataFrame([("/src/source.csv", "abc")], "path string, file_hash string")
    hist = ledger.raw("metadata.file_history")
    assert L.loaded_by_hash(probe, hist, "customer").count() == 0
    ledger.append_frame("metadata.file_history", spark.createDataFrame(
        [("customer", "/src/source.csv", "abc", "SUCCESS")],
        "pipeline_name string, source_file string, file_hash string, status string").select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in L.FILE_HISTORY.fields
               if f.name not in ("pipeline_name", "source_file", "file_hash", "status")]))
    assert L.loaded_by_hash(probe, ledger.raw("metadata.file_history"), "customer").count() == 1


def test_frames_of_one_run_are_all_kept(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    a, b = (spark.createDataFrame([(k, k)], "customer_id string, customer_name string") for k in "ab")
    assert bronze_ops.append_dataframe(store, "bronze.customer", a, "/src/a.csv", "run-1", L.now()) == 1
    for _ in range(2):                       # the second time is a retry
        assert bronze_ops.append_dataframe(store, "bronze.customer", b, "/src/b.csv", "run-1", L.now()) == 1
    bronze_ops.append_dataframe(store, "bronze.customer", a, "/src/b.csv", "run-1", L.now(), batch_id="more")
    got = sorted((r.customer_id, r._source_file, r._run_id) for r in store.read("bronze.customer").collect())
    assert got == [("a", "/src/a.csv", "run-1"), ("a", "/src/b.csv", "run-1"), ("b", "/src/b.csv", "run-1")]


def test_clear_removes_rows(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    df = spark.createDataFrame([("1", "Ada")], "customer_id string, customer_name string")
    bronze_ops.append_dataframe(store, "bronze.customer", df, "/src/a.csv", "run-1", L.now())
    bronze_ops.clear(store, "bronze.customer")
    assert store.exists("bronze.customer") and store.read("bronze.customer").count() == 0
    assert store.read("bronze.customer").columns[:2] == ["customer_id", "customer_name"]
    bronze_ops.clear(store, "bronze.absent")  # absent table: no-op
    assert not store.exists("bronze.absent")


def test_unchanged_file_detected_by_stat(spark, tmp_root):
    _write(f"{tmp_root}/in/source.csv", "customer_id,customer_name\n1,Ada\n")
    files = S.discover(spark, f"{tmp_root}/in", "*.csv")
    f = files.first()
    hist = spark.createDataFrame(
        [("customer", f.path, "h", f.file_size_bytes, f.file_modified_at, "SUCCESS")],
        "pipeline_name string, source_file string, file_hash string, file_size_bytes long, "
        "file_modified_at timestamp_ntz, status string")
    assert L.unchanged_files(files, hist, "customer").count() == 1
    assert L.new_or_changed_files(files, hist, "customer").count() == 0


def test_direct_csv_load_keeps_lineage(spark, tmp_root):
    from millrace.plans.pipeline import load_files
    _write(f"{tmp_root}/source/customer/source.csv", "customer_id,customer_name\n1,Ada\n")
    store = TableStore(spark, f"{tmp_root}/wh")
    ledger = L.Ledger(spark, store)
    ledger.initialize()
    cfg = {"source_folder": "source/customer", "bronze_table": "bronze.customer"}
    out = load_files(spark, store, ledger, "customer", cfg, tmp_root, "run-1", L.now())
    assert (out["done"], out["rows"]) == (1, 1)
    row = store.read("bronze.customer").first()
    assert (row.customer_id, row.customer_name, row._source_file, row._run_id) == \
        ("1", "Ada", f"{tmp_root}/source/customer/source.csv", "run-1")
    again = load_files(spark, store, ledger, "customer", cfg, tmp_root, "run-2", L.now())
    assert again["done"] == 0 and store.read("bronze.customer").count() == 1


def test_excel_to_parquet_staging(spark, tmp_root):
    path = f"{tmp_root}/xl/source.xlsx"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(write_workbook(["customer_id", "customer_name"], [("1", "Ada"), (2, "")]))
    staged = stage_excel(spark, [path], f"{tmp_root}/staging")
    rows = sorted(tuple(r) for r in staged[0][1].collect())
    assert rows == [("1", "Ada", path), ("2", "", path)]
    assert [n.startswith("workbook=source-") for n in os.listdir(f"{tmp_root}/staging") if "=" in n] == [True]


def test_export_parquet_and_csv(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    store.overwrite("mart.customer", spark.createDataFrame([(1, "Ada")], "customer_id int, customer_name string"))
    out = export_tables(store, ["mart.customer"], f"{tmp_root}/exports", parquet=True, csv=True,
                        single_file=True)
    assert {os.path.basename(p) for p in out} == {"mart_customer.parquet", "mart_customer.csv"}
    assert all(os.path.isfile(p) for p in out)
    assert spark.read.parquet(out[0]).collect()[0].customer_name == "Ada"


def test_unsafe_table_names_rejected(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    with pytest.raises(ValueError, match="Unsafe table"):
        export_tables(store, ["mart.customer; DROP TABLE metadata.audit_log"], f"{tmp_root}/x")
    for bad in ["customer", "mart.", "1mart.x", "mart.a.b"]:
        with pytest.raises(ValueError):
            check_table_name(bad)


def test_required_columns_reported_sorted(spark, tmp_root):
    _write(f"{tmp_root}/in/a.csv", "WORKFLOW_ID,X\n1,2\n")
    prof = S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv"))
    with pytest.raises(ValueError, match="Missing required column\\(s\\) in a.csv: SUPPLIER_ID"):
        S.raise_if_missing(prof, ["WORKFLOW_ID", "SUPPLIER_ID"])


def test_by_name_append_rejects_extra_columns(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    a = spark.createDataFrame([("1", "Ada")], "customer_id string, customer_name string")
    bronze_ops.append_dataframe(store, "bronze.customer", a, "/a.csv", "r1", L.now())
    b = spark.createDataFrame([("2", "x")], "CUSTOMER_ID string, extra string")
    with pytest.raises(ValueError, match="extra"):
        bronze_ops.append_dataframe(store, "bronze.customer", b, "/b.csv", "r2", L.now())
    c = spark.createDataFrame([("3",)], "CUSTOMER_ID string")
    bronze_ops.append_dataframe(store, "bronze.customer", c, "/c.csv", "r3", L.now())
    rows = sorted((r.customer_id, r.customer_name) for r in store.read("bronze.customer").collect())
    assert rows == [("1", "Ada"), ("3", None)]


def test_excel_date_styled_cells_read_as_datetimes():
    import io
    import zipfile
    from millrace.sources.excel import workbook_rows
    data = write_workbook(["d", "t", "n"], [(45296, 0.4375, 1.5)])
    zin, buf = zipfile.ZipFile(io.BytesIO(data)), io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zout:
        for item in zin.namelist():
            b = zin.read(item)
            if item == "xl/worksheets/sheet1.xml":
                b = b.replace(b'<c r="A2">', b'<c r="A2" s="1">').replace(b'<c r="B2">', b'<c r="B2" s="2">')
            zout.writestr(item, b)
        ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        zout.writestr("xl/styles.xml", f'<styleSheet xmlns="{ns}"><numFmts count="1"><numFmt numFmtId="164" '
                      'formatCode="yyyy\\-mm\\-dd"/></numFmts><cellXfs count="3"><xf numFmtId="0"/>'
                      '<xf numFmtId="164"/><xf numFmtId="21"/></cellXfs></styleSheet>')
    assert list(workbook_rows(buf.getvalue()))[1] == (1, ["2024-01-05 00:00:00", "10:30:00", "1.5"])


def test_profile_does_not_depend_on_block_size(spark, tmp_root, monkeypatch):
    contents = "\ufeffa;b;c\r\n1;2;3\n" + "x;y;z\n" * 1000
    _write(f"{tmp_root}/in/big.csv", contents)
    found = S.discover(spark, f"{tmp_root}/in", "*.csv")
    large = S.profile(spark, found).first()
    monkeypatch.setattr(S, "BLOCK", 3)
    small = S.profile(spark, found).first()
    assert small == large and large.file_hash == hashlib.sha256(contents.encode()).hexdigest()
    assert (large.sep, list(large.columns), large.quoted) == (";", ["a", "b", "c"], False)


def test_quoted_line_breaks_are_read_like_the_reference(spark, tmp_root, monkeypatch):
    _write(f"{tmp_root}/in/a.csv", 'id,note\n1,"two\nlines"\n2,"say ""hi"""\n')
    _write(f"{tmp_root}/in/b.csv", "id,note\n3,plain\n")
    prof = S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv"))
    assert {r.file_name: r.quoted for r in prof.collect()} == {"a.csv": True, "b.csv": False}
    monkeypatch.setattr(S, "BLOCK", 5)
    assert {r.file_name: r.quoted for r in S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv")).collect()} == \
        {"a.csv": True, "b.csv": False}
    monkeypatch.undo()
    frames = scan_profiled(spark, prof)
    assert len(frames) == 1
    rows = sorted((r.id, r.note) for r in frames[0][1].collect())
    assert rows == [("1", "two\nlines"), ("2", 'say "hi"'), ("3", "plain")]


def test_excel_workbooks_with_different_layouts(spark, tmp_root):
    folder = f"{tmp_root}/xl"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/a.xlsx", "wb") as fh:
        fh.write(write_workbook(["customer_id", "customer_name"], [("1", "Ada")]))
    with open(f"{folder}/b.xlsx", "wb") as fh:
        fh.write(write_workbook(["city", "customer_id"], [("Oslo", "2")]))
    staged = stage_excel(spark, [f"{folder}/a.xlsx", f"{folder}/b.xlsx"], f"{tmp_root}/staging")
    got = sorted(sorted((k, v) for k, v in r.asDict().items() if k != "_source_file")
                 for _, df in staged for r in df.collect())
    assert got == [[("city", "Oslo"), ("customer_id", "2")],
                   [("customer_id", "1"), ("customer_name", "Ada")]]


def _load(spark, root, cfg, run_id, name="p"):
    from millrace.plans.pipeline import load_files
    store = TableStore(spark, f"{root}/wh")
    ledger = L.Ledger(spark, store)
    ledger.initialize()
    return store, load_files(spark, store, ledger, name, {"source_folder": "src", "bronze_table": "bronze.t", **cfg}, root, run_id, L.now())


def test_awkward_file_names_load_with_their_own_path(spark, tmp_root):
    names = ["_jan.csv", ".feb.csv", "r[1].csv", "a b.csv", "50%.csv", "c+d.csv", "{x}*.csv"]
    for i, n in enumerate(names):
        _write(f"{tmp_root}/src/{n}", f"id,v\n{i},x\n")
    store, out = _load(spark, tmp_root, {}, "r1")
    assert (out["found"], out["done"], out["rows"]) == (len(names),) * 3
    got = {r["_source_file"]: r["id"] for r in store.read("bronze.t").collect()}
    assert got == {f"{tmp_root}/src/{n}": str(i) for i, n in enumerate(names)}
    history = L.Ledger(spark, store).raw("metadata.file_history").collect()
    assert {(r.source_file, r.row_count) for r in history} == {(f"{tmp_root}/src/{n}", 1) for n in names}
    assert _load(spark, tmp_root, {}, "r2")[1]["done"] == 0


def test_patterns_may_name_sub_folders(spark, tmp_root):
    _write(f"{tmp_root}/src/a/one.csv", "id\n1\n")
    _write(f"{tmp_root}/src/b/two.csv", "id\n2\n")
    store, out = _load(spark, tmp_root, {"source_pattern": "*/*.csv"}, "r1")
    assert out["rows"] == 2 and {r.id for r in store.read("bronze.t").collect()} == {"1", "2"}


def test_header_is_parsed_as_csv(spark, tmp_root):
    long = ",".join(f"column_number_{i}" for i in range(60000))       # over one block
    _write(f"{tmp_root}/in/quoted.csv", '"Amount, USD","say ""hi""",y\n1,2,3\n')
    _write(f"{tmp_root}/in/long.csv", long + "\n")
    prof = {r.file_name: r for r in S.profile(spark, S.discover(spark, f"{tmp_root}/in", "*.csv")).collect()}
    assert prof["quoted.csv"]["columns"] == ["Amount, USD", 'say "hi"', "y"] and prof["quoted.csv"].sep == ","
    assert len(prof["long.csv"]["columns"]) == 60000 and prof["long.csv"]["columns"][-1] == "column_number_59999"


def test_lone_carriage_return_in_quotes(spark, tmp_root):
    _write(f"{tmp_root}/src/a.csv", 'id,v\n1,"two\rparts"\n2,x\n')
    store, _ = _load(spark, tmp_root, {}, "r1")
    assert {(r.id, r.v) for r in store.read("bronze.t").collect()} == {("1", "two\rparts"), ("2", "x")}


def test_crash_before_the_ledger_does_not_duplicate_rows(spark, tmp_root, monkeypatch):
    _write(f"{tmp_root}/src/a.csv", "id\n1\n")

    def crash(self, loaded):
        raise RuntimeError("executor gone")

    monkeypatch.setattr(L.Ledger, "record_files", crash)
    with pytest.raises(RuntimeError, match="gone"):
        _load(spark, tmp_root, {}, "r1")
    monkeypatch.undo()
    _write(f"{tmp_root}/src/b.csv", "id\n2\n")
    store, out = _load(spark, tmp_root, {}, "r2")
    assert out["rows"] == 2 and sorted(r.id for r in store.read("bronze.t").collect()) == ["1", "2"]


def test_failed_first_load_can_be_repaired(spark, tmp_root):
    _write(f"{tmp_root}/src/a.csv", "id,v\n1,2\n3\n4,5,6\n")
    with pytest.raises(Exception):
        _load(spark, tmp_root, {}, "r1")
    assert not TableStore(spark, f"{tmp_root}/wh").exists("bronze.t")
    _write(f"{tmp_root}/src/a.csv", "id,v\n1,2\n")
    store, out = _load(spark, tmp_root, {}, "r2")
    assert out["rows"] == 1 and store.read("bronze.t").count() == 1


def test_failed_runs_keep_their_counters(spark, tmp_root):
    from millrace.plans.pipeline import run_all
    _write(f"{tmp_root}/src/a.csv", "id\n1\n2\n")
    out = run_all(spark, {"p": {"source_folder": "src", "bronze_table": "bronze.customer", "dbt_selector": "tag:none"}},
                  {"root": tmp_root, "warehouse": "wh"}).first()
    assert out.status == "FAILED"
    ledger = L.Ledger(spark, TableStore(spark, f"{tmp_root}/wh"))
    r = ledger.latest("metadata.elt_run_log").first()
    assert (r.status, r.files_found, r.files_loaded, r.rows_loaded) == ("FAILED", 1, 1, 2)
    assert [r.stage for r in ledger.raw("metadata.audit_log").orderBy("event_time").collect()] == ["DISCOVERY", "BRONZE", "PIPELINE"]


def test_empty_replace_leaves_an_empty_table(spark, tmp_root):
    _write(f"{tmp_root}/src/a.csv", "id,v\n1,2\n")
    _load(spark, tmp_root, {"append": False}, "r1")
    os.remove(f"{tmp_root}/src/a.csv")
    store, out = _load(spark, tmp_root, {"append": False}, "r2")
    assert out["rows"] == 0 and store.exists("bronze.t") and store.read("bronze.t").count() == 0
    assert "id" in store.read("bronze.t").columns


def test_typed_frames_are_cast_to_the_table(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    bronze_ops.append_dataframe(store, "bronze.t", spark.createDataFrame([("1", "a")], "id string, v string"), "/a", "r1", L.now())
    bronze_ops.append_dataframe(store, "bronze.t", spark.createDataFrame([(2, 5)], "id int, v int"), "/b", "r2", L.now())
    assert sorted((r.id, r.v) for r in store.read("bronze.t").collect()) == [("1", "a"), ("2", "5")]
    bronze_ops.append_dataframe(store, "bronze.n", spark.createDataFrame([(1,)], "id int"), "/a", "r1", L.now())
    with pytest.raises(Exception):
        bronze_ops.append_dataframe(store, "bronze.n", spark.createDataFrame([("x",)], "id string"), "/b", "r2", L.now())


def test_parquet_files_may_differ_and_are_checked(spark, tmp_root):
    spark.createDataFrame([(1, "a")], "id int, v string").coalesce(1).write.parquet(f"{tmp_root}/one")
    spark.createDataFrame([(2, 0.5)], "id int, w double").coalesce(1).write.parquet(f"{tmp_root}/two")
    os.makedirs(f"{tmp_root}/src")
    for n in ("one", "two"):
        part = next(f for f in os.listdir(f"{tmp_root}/{n}") if f.endswith(".parquet"))
        os.link(f"{tmp_root}/{n}/{part}", f"{tmp_root}/src/{n}.parquet")
    with pytest.raises(ValueError, match="two.parquet: v"):
        _load(spark, tmp_root, {"source_pattern": "*.parquet", "required_columns": ["id", "v"]}, "r1")
    store, out = _load(spark, tmp_root, {"source_pattern": "*.parquet"}, "r2")
    assert {(r.id, r.v, r.w) for r in store.read("bronze.t").collect()} == {(1, "a", None), (2, None, 0.5)} and out["rows"] == 2


def test_workbooks_of_one_stem_and_unnamed_columns(spark, tmp_root):
    os.makedirs(f"{tmp_root}/src")
    with open(f"{tmp_root}/src/a.xlsx", "wb") as fh:
        fh.write(write_workbook(["id", "", "id"], [("1", "x", "2", "y"), (), ("3",)]))
    with open(f"{tmp_root}/src/a.xlsm", "wb") as fh:
        fh.write(write_workbook(["other"], [("9",)]))
    staged = stage_excel(spark, [f"{tmp_root}/src/a.xlsx", f"{tmp_root}/src/a.xlsm"], f"{tmp_root}/st")
    got = {tuple(cols): sorted(tuple(r)[:-1] for r in df.collect()) for cols, df in staged}
    assert got == {("other",): [("9",)],
                   ("id", "Unnamed: 1", "id.1", "Unnamed: 3"): [("", "", "", ""), ("1", "x", "2", "y"), ("3", "", "", "")]}


def test_a_cut_swap_is_repaired(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    store.overwrite("mart.t", spark.createDataFrame([(1,)], "id int"))
    os.rename(f"{tmp_root}/wh/mart/t", f"{tmp_root}/wh/mart/t.__old_abc")
    assert store.exists("mart.t") and store.read("mart.t").count() == 1


def test_rank_keeps_rows_with_null_keys(spark):
    from millrace.operators.latest import rank_desc, rank_desc_window
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 3)], "k string, t int")
    got = sorted(map(str, rank_desc(df, ["k"], ["t"]).collect()))
    assert got == sorted(map(str, rank_desc_window(df, ["k"], ["t"]).collect()))


def test_silver_follows_bronze_batch_by_batch(spark, tmp_root):
    from millrace.plans.models import build
    _write(f"{tmp_root}/src/a.csv", "SUPPLIER_ID,INVOICE_NUMBER,UNIT_PRICE\nS1,I1,2.50\n,I2,1\n")
    cfg = {"bronze_table": "bronze.erp"}
    store, _ = _load(spark, tmp_root, cfg, "r1", "erp")
    assert build(store, "stg_erp")[0][2] == 1
    first = {n: os.listdir(f"{tmp_root}/wh/silver/erp/{n}") for n in os.listdir(f"{tmp_root}/wh/silver/erp") if "=" in n}
    _write(f"{tmp_root}/src/b.csv", "SUPPLIER_ID,INVOICE_NUMBER,UNIT_PRICE\nS2,I3,x\n")
    _load(spark, tmp_root, cfg, "r2", "erp")
    assert build(store, "stg_erp")[0][2] == 2
    after = {n: os.listdir(f"{tmp_root}/wh/silver/erp/{n}") for n in os.listdir(f"{tmp_root}/wh/silver/erp") if "=" in n}
    assert len(after) == 2 and {k: after[k] for k in first} == first       # the first batch wasn't written again
    # a replace load leaves one Bronze batch, so one of Silver
    _load(spark, tmp_root, {**cfg, "append": False}, "r3", "erp")
    assert build(store, "stg_erp")[0][2] == 2 and store.batches("silver.erp") == ["erp.r3"]
    assert {(r.supplier_id, str(r.unit_price)) for r in store.read("silver.erp").collect()} == {("S1", "2.50"), ("S2", "None")}
