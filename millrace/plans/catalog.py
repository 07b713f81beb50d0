"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles.

Every query reads the given test tables (through the derived Bronze inputs of
:mod:`millrace.plans.fixtures`) over their whole extent.  The groups follow the
blueprint: models, operators, metrics, quality, ingest, ledger, sinks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import casts as C
from millrace.functions.metrics import surrogate_key
from millrace.operators import bronze as bronze_ops
from millrace.operators import marts, quality, silver
from millrace.plans import ledger as ledger_ops
from millrace.plans import oracles as O
from millrace.plans.export import CSV_OPTIONS, export_tables
from millrace.plans.fixtures import (
    CUSTOMER_SOURCE_COLUMNS, ERP_SOURCE_COLUMNS, FIXTURE_AS_OF, WORKFLOW_SOURCE_COLUMNS,
    bronze, bronze_sql, erp_cell, erp_joined, probes,
)
from millrace.plans.pipeline import load_files, run_all, run_pipeline
from millrace.plans.scratch import SOURCE_CSV_OPTIONS, scratch, write_csv
from millrace.sources import files as src_files
from millrace.sources.csv import scan_profiled
from millrace.sources.parquet import read_table, scan_parquet
from millrace.store import TableStore


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ------------------------------------------------------------------ inputs

def silver_erp_df(spark, sf_dir):
    return silver.silver_erp(bronze(spark, sf_dir, "erp"))


def silver_workflow_df(spark, sf_dir):
    return silver.silver_workflow(bronze(spark, sf_dir, "workflow"))


def silver_customer_df(spark, sf_dir):
    return silver.silver_customer(bronze(spark, sf_dir, "customer"))


# ------------------------------------------------------------------ flagship marts

@register("mart_erp", O.MART_ERP)
def q_mart_erp(spark, sf_dir):
    return marts.mart_erp(silver_erp_df(spark, sf_dir), FIXTURE_AS_OF)


@register("mart_workflow", O.MART_WORKFLOW)
def q_mart_workflow(spark, sf_dir):
    dim = marts.dim_invoice(silver_erp_df(spark, sf_dir))
    return marts.mart_workflow(silver_workflow_df(spark, sf_dir), dim)


# ------------------------------------------------------------------ silver

@register("silver_erp", O.with_bronze("erp", O.SILVER_ERP))
def q_silver_erp(spark, sf_dir):
    return silver_erp_df(spark, sf_dir)


@register("silver_workflow", O.with_bronze("workflow", O.SILVER_WORKFLOW))
def q_silver_workflow(spark, sf_dir):
    return silver_workflow_df(spark, sf_dir)


@register("silver_customer", O.with_bronze("customer", O.SILVER_CUSTOMER))
def q_silver_customer(spark, sf_dir):
    return silver_customer_df(spark, sf_dir)


# ------------------------------------------------------------------ silver operators


@register("silver_key_filter", O.with_bronze("erp", """
SELECT ERP_RECORD_ID AS erp_record_id,
       NULLIF(TRIM(SUPPLIER_ID), '') AS supplier_id,
       NULLIF(TRIM(INVOICE_NUMBER), '') AS invoice_number
FROM bz
WHERE NULLIF(TRIM(SUPPLIER_ID), '') IS NOT NULL AND NULLIF(TRIM(INVOICE_NUMBER), '') IS NOT NULL"""))
def q_silver_key_filter(spark, sf_dir):
    kept = silver.key_filter(bronze(spark, sf_dir, "erp"))
    return kept.select(F.col("ERP_RECORD_ID").alias("erp_record_id"),
                       C.clean_text("SUPPLIER_ID").alias("supplier_id"),
                       C.clean_text("INVOICE_NUMBER").alias("invoice_number"))


_TEXT_COLS = ["SUPPLIER_ID", "INVOICE_ID", "INVOICE_NUMBER", "CURRENCY", "PAYMENT_STATUS",
              "DUE_DATE_RAW", "DQ_SCENARIO"]


@register("clean_text", O.with_bronze("erp", "SELECT ERP_RECORD_ID AS erp_record_id, " + ", ".join(
    f"NULLIF(TRIM(CAST({c} AS VARCHAR)), '') AS {c.lower()}" for c in _TEXT_COLS) + " FROM bz"))
def q_clean_text(spark, sf_dir):
    b = bronze(spark, sf_dir, "erp")
    return b.select(F.col("ERP_RECORD_ID").alias("erp_record_id"),
                    *[C.clean_text(c).alias(c.lower()) for c in _TEXT_COLS])


_NUM_PROBES = ["p_plain", "p_three_places", "p_negative_half", "p_half", "p_exponent",
               "p_underscore", "p_hex", "p_padded", "p_thousands", "p_overflow", "p_junk",
               "p_just_below_half", "p_just_over_half", "p_large_hex", "p_other_digits"]
_PROBE_ORACLE = "WITH pr AS ({probe}) SELECT {cols} FROM pr"


def _probe_oracle(name, keys, probes_, cast_sql):
    from millrace.plans.fixtures import bronze_sql
    cols = ", ".join(keys + [cast_sql.format(p=p) + f" AS {p}" for p in probes_])
    return _PROBE_ORACLE.format(probe=bronze_sql(name), cols=cols)


@register("lenient_decimal", _probe_oracle(
    "numbers", ["l_orderkey", "l_linenumber"], _NUM_PROBES,
    "TRY_CAST(NULLIF(TRIM({p}), '') AS DECIMAL(18,2))"))
def q_lenient_decimal(spark, sf_dir):
    p = probes(spark, sf_dir, "numbers")
    return p.select("l_orderkey", "l_linenumber",
                    *[C.to_decimal(C.clean_text(c), 18, 2).alias(c) for c in _NUM_PROBES])


@register("lenient_integer", _probe_oracle(
    "numbers", ["l_orderkey", "l_linenumber"], _NUM_PROBES,
    "TRY_CAST(NULLIF(TRIM({p}), '') AS BIGINT)"))
def q_lenient_integer(spark, sf_dir):
    p = probes(spark, sf_dir, "numbers")
    return p.select("l_orderkey", "l_linenumber",
                    *[C.to_bigint(C.clean_text(c)).alias(c) for c in _NUM_PROBES])


_DATE_PROBES = ["p_iso", "p_slash", "p_space", "p_unpadded", "p_with_time", "p_t_time",
                "p_midnight24", "p_zone_fraction", "p_bare_zone", "p_year_month",
                "p_trailing_word", "p_february", "p_hour_only", "p_backslash"]


@register("lenient_date", _probe_oracle(
    "dates", ["o_orderkey"], _DATE_PROBES, "TRY_CAST(NULLIF(TRIM({p}), '') AS DATE)"))
def q_lenient_date(spark, sf_dir):
    p = probes(spark, sf_dir, "dates")
    return p.select("o_orderkey", *[C.to_date(C.clean_text(c)).alias(c) for c in _DATE_PROBES])


@register("lenient_timestamp", _probe_oracle(
    "dates", ["o_orderkey"], _DATE_PROBES, "TRY_CAST(NULLIF(TRIM({p}), '') AS TIMESTAMP)"))
def q_lenient_timestamp(spark, sf_dir):
    p = probes(spark, sf_dir, "dates")
    return p.select("o_orderkey",
                    *[C.to_timestamp_ntz(C.clean_text(c)).alias(c) for c in _DATE_PROBES])


# ------------------------------------------------------------------ dimensional

@register("dim_invoice", O.with_erp(f"SELECT {O.DIM_COLUMNS} FROM inv"))
def q_dim_invoice(spark, sf_dir):
    return marts.dim_invoice(silver_erp_df(spark, sf_dir))


@register("fact_invoice", O.with_erp(O.FACT_INVOICE))
def q_fact_invoice(spark, sf_dir):
    return marts.fact_invoice(silver_erp_df(spark, sf_dir))


@register("fact_workflow_event", O.with_workflow(O.FACT_WORKFLOW))
def q_fact_workflow_event(spark, sf_dir):
    return marts.fact_workflow_event(silver_workflow_df(spark, sf_dir))


@register("mart_customer", O.with_bronze(
    "customer", f"SELECT customer_id, customer_name, city, modified_date FROM ({O.SILVER_CUSTOMER})"))
def q_mart_customer(spark, sf_dir):
    return marts.mart_customer(silver_customer_df(spark, sf_dir))


@register("surrogate_keys", O.with_erp("""
SELECT erp_record_id, md5(concat_ws('|', supplier_id, invoice_number)) AS invoice_key,
       md5(concat_ws('|', supplier_id, invoice_number, erp_record_id)) AS line_key,
       md5(concat_ws('|', supplier_id, invoice_number) || '|' || ifnull(invoice_id, '')) AS invoice_row_key
FROM lines"""))
def q_surrogate_keys(spark, sf_dir):
    s = silver_erp_df(spark, sf_dir)
    return s.select("erp_record_id",
                    surrogate_key("supplier_id", "invoice_number",
                                  F.coalesce("invoice_id", F.lit(""))).alias("invoice_row_key"),
                    surrogate_key("supplier_id", "invoice_number").alias("invoice_key"),
                    surrogate_key("supplier_id", "invoice_number", "erp_record_id").alias("line_key"))


# ------------------------------------------------------------------ aggregates / windows

@register("invoice_totals", O.with_erp(f"SELECT {O.TOTAL_COLUMNS} FROM inv"))
def q_invoice_totals(spark, sf_dir):
    return marts.invoice_totals(silver_erp_df(spark, sf_dir))


_WT_COLS = ["invoice_amount_usd", "first_workflow_event_timestamp", "last_workflow_event_timestamp",
            "workflow_event_count", "workflow_stage_count", "exception_event_count"]


def _workflow_totals(spark, sf_dir):
    t = marts.workflow_totals(silver_workflow_df(spark, sf_dir))
    return t.withColumn("invoice_key", surrogate_key(*marts.INVOICE_PAIR))


@register("workflow_totals", O.with_workflow(f"SELECT {O.WORKFLOW_TOTAL_COLUMNS} FROM flow"))
def q_workflow_totals(spark, sf_dir):
    return _workflow_totals(spark, sf_dir).select("invoice_key", *_WT_COLS)


@register("ranked_events", O.with_workflow(O.EVENT_RANKS))
def q_ranked_events(spark, sf_dir):
    fe = marts.fact_workflow_event(silver_workflow_df(spark, sf_dir))
    return marts.ranked_events(fe).select("workflow_event_key", "invoice_key", "event_timestamp",
                                          "event_sequence", "event_rank")


@register("latest_event_per_invoice", O.with_workflow("""
SELECT invoice_key, final.event AS workflow_event_id, final.flow AS current_workflow_id,
       final.stage AS current_workflow_stage, final.status AS current_workflow_status
FROM flow"""))
def q_latest_event_per_invoice(spark, sf_dir):
    fe = marts.fact_workflow_event(silver_workflow_df(spark, sf_dir))
    return marts.latest_event_per_invoice(fe)


# ------------------------------------------------------------------ metrics

def _erp_metrics(spark, sf_dir):
    return marts.mart_erp(silver_erp_df(spark, sf_dir), FIXTURE_AS_OF)


def _erp_metric_oracle(cols: str) -> str:
    return O.with_erp(f"SELECT invoice_key, {cols} FROM invm")


@register("invoice_variance", _erp_metric_oracle("line_amount_variance_doc, outstanding_amount_doc"))
def q_invoice_variance(spark, sf_dir):
    return _erp_metrics(spark, sf_dir).select("invoice_key", "line_amount_variance_doc",
                                              "outstanding_amount_doc")


@register("paid_percent", _erp_metric_oracle("invoice_amount_doc, amount_paid, paid_percent"))
def q_paid_percent(spark, sf_dir):
    return _erp_metrics(spark, sf_dir).select("invoice_key", "invoice_amount_doc", "amount_paid",
                                              "paid_percent")


@register("days_metrics", _erp_metric_oracle("days_to_pay, days_to_post, overdue_days"))
def q_days_metrics(spark, sf_dir):
    return _erp_metrics(spark, sf_dir).select("invoice_key", "days_to_pay", "days_to_post",
                                              "overdue_days")


@register("payment_timing", O.with_erp("SELECT payment_timing, count(*) AS invoice_count FROM invm GROUP BY ALL"))
def q_payment_timing(spark, sf_dir):
    return (_erp_metrics(spark, sf_dir).groupBy("payment_timing")
            .agg(F.count(F.lit(1)).alias("invoice_count")))


def _wf_metrics(spark, sf_dir):
    return marts.workflow_metrics(_workflow_totals(spark, sf_dir))


@register("exception_rate", O.with_workflow("""
SELECT invoice_key, exception_event_count, workflow_event_count, exception_rate_percent, has_exception FROM flowm"""))
def q_exception_rate(spark, sf_dir):
    return _wf_metrics(spark, sf_dir).select("invoice_key", "exception_event_count",
                                             "workflow_event_count", "exception_rate_percent",
                                             "has_exception")


@register("workflow_durations", O.with_workflow("""
SELECT invoice_key, first_workflow_event_timestamp, last_workflow_event_timestamp, workflow_duration_hours, average_event_gap_hours FROM flowm"""))
def q_workflow_durations(spark, sf_dir):
    return _wf_metrics(spark, sf_dir).select("invoice_key", "first_workflow_event_timestamp",
                                             "last_workflow_event_timestamp",
                                             "workflow_duration_hours", "average_event_gap_hours")


@register("workflow_complete_flag", O.with_workflow("""
SELECT invoice_key, final.status AS current_workflow_status, is_workflow_complete FROM flowm"""))
def q_workflow_complete_flag(spark, sf_dir):
    return _wf_metrics(spark, sf_dir).select(
        "invoice_key", F.col("latest.current_status").alias("current_workflow_status"),
        "is_workflow_complete")


# ------------------------------------------------------------------ quality

def _models_for_quality(spark, sf_dir):
    erp_silver = silver_erp_df(spark, sf_dir)
    cust = silver_customer_df(spark, sf_dir)
    return {
        "stg_customer": cust,
        "customer": marts.mart_customer(cust),
        "erp": marts.mart_erp(erp_silver, FIXTURE_AS_OF),
        "workflow": marts.mart_workflow(silver_workflow_df(spark, sf_dir),
                                        marts.dim_invoice(erp_silver)),
    }


def _dq(spark, sf_dir, kind):
    frames = [quality.run_tests(df, model, [kind])
              for model, df in _models_for_quality(spark, sf_dir).items()
              if kind in quality.TESTS.get(model, {})]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_MW = "(" + O.MART_WORKFLOW_BODY + ")"
_SC = "scu"
_DQ_CTES = f"bc AS ({O.bronze_sql('customer')}), scu AS ({O.silver_customer('bc')})"


def _dq_oracle(parts: list[str]) -> str:
    return O.with_erp_and_workflow("\nUNION ALL\n".join(parts), extra=_DQ_CTES)


def _nn(model, src, col):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {src} x")


def _uq(model, src, col):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'unique' AS test, "
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {src} x "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) d")


ORACLE_DQ_NOT_NULL = _dq_oracle(
    [_nn("stg_customer", _SC, "customer_id"), _nn("customer", _SC, "customer_id")]
    + [_nn("erp", "invm", c) for c in ("invoice_key", "supplier_id", "invoice_number")]
    + [_nn("workflow", _MW, c) for c in ("invoice_key", "supplier_id", "invoice_number")])
ORACLE_DQ_UNIQUE = _dq_oracle(
    [_uq("stg_customer", _SC, "customer_id"), _uq("customer", _SC, "customer_id"),
     _uq("erp", "invm", "invoice_key"), _uq("workflow", _MW, "invoice_key")])
ORACLE_DQ_ACCEPTED = _dq_oracle([
    "SELECT 'erp' AS model, 'payment_timing' AS column_name, 'accepted_values' AS test, "
    f"CAST(count(DISTINCT payment_timing) AS BIGINT) AS failures FROM invm x WHERE payment_timing IS NOT NULL "
    "AND payment_timing NOT IN ('UNKNOWN', 'OVERDUE', 'OPEN', 'ON_TIME', 'LATE')"])


@register("dq_not_null", ORACLE_DQ_NOT_NULL)
def q_dq_not_null(spark, sf_dir):
    return _dq(spark, sf_dir, "not_null")


@register("dq_unique", ORACLE_DQ_UNIQUE)
def q_dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, "unique")


@register("dq_accepted_values", ORACLE_DQ_ACCEPTED)
def q_dq_accepted_values(spark, sf_dir):
    return _dq(spark, sf_dir, "accepted_values")


# DuckDB's type names as Spark says them.
_SPARK_TYPE = """replace(replace(replace(replace(replace(lower(typeof(any_value({c}))), 'varchar', 'string'),
  'timestamp', 'timestamp_ntz'), 'hugeint', 'bigint'), 'integer', 'int'), ' ', '')"""


def _contract_oracle() -> str:
    sources = {"erp": "invm", "workflow": _MW, "customer": "scu", "stg_customer": "scu"}
    parts = []
    for model, contract in quality.CONTRACTS.items():
        for f in contract.fields:
            parts.append(f"SELECT '{model}' AS model, '{f.name}' AS column_name, {_SPARK_TYPE.format(c=f.name)} AS actual_type, "
                         f"TRUE AS matches, count({f.name}) AS filled_rows FROM {sources[model]} x")
    return _dq_oracle(parts)


@register("contract_report", _contract_oracle())
def q_contract_report(spark, sf_dir):
    """The written marts against their contracts: per column the type it was
    written with, whether that is the contract's, and its filled rows."""
    store, _ = _store(spark, scratch(spark, "contract"))
    models = _models_for_quality(spark, sf_dir)
    out = None
    for model, contract in quality.CONTRACTS.items():
        table = f"mart.{model}"
        store.overwrite(table, models[model])
        written = store.read(table)
        actual = {f.name: f.dataType.simpleString() for f in written.schema.fields}
        counts = written.agg(*[F.count(f.name).alias(f.name) for f in contract.fields])
        rows = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(actual.get(f.name)).alias("actual_type"),
                                            F.lit(actual.get(f.name) == f.dataType.simpleString()).alias("matches"),
                                            F.col(f.name).alias("filled_rows")) for f in contract.fields]))
        part = counts.select(F.lit(model).alias("model"), rows.alias("r")).select("model", "r.*")
        out = part if out is None else out.unionByName(part)
    return out


# Checks that must fail: blank and repeated values of the raw lines.
@register("dq_failures", O.with_bronze("erp", """
SELECT 'raw' AS model, 'supplier_id' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE trim(SUPPLIER_ID) = '') AS failures FROM bz
UNION ALL SELECT 'raw', 'due_date_raw', 'not_null', count(*) - count(nullif(trim(DUE_DATE_RAW), '')) FROM bz
UNION ALL SELECT 'raw', 'invoice_number', 'unique', count(*) FROM (SELECT 1 FROM bz GROUP BY trim(INVOICE_NUMBER) HAVING count(*) > 1)
UNION ALL SELECT 'raw', 'category', 'accepted_values', count(DISTINCT CATEGORY) - 2 FROM bz"""))
def q_dq_failures(spark, sf_dir):
    b = bronze(spark, sf_dir, "erp")
    raw = b.select(*[C.clean_text(c).alias(c.lower()) for c in ("SUPPLIER_ID", "DUE_DATE_RAW", "INVOICE_NUMBER", "CATEGORY")])
    return (quality.not_null(raw, "raw", ["supplier_id", "due_date_raw"])
            .unionByName(quality.unique(raw, "raw", "invoice_number"))
            .unionByName(quality.accepted_values(raw, "raw", "category", ["category 0", "category 1"])))


# ------------------------------------------------------------------ ingest (real files)


def _nullif_all(cols, src="bz"):
    return ", ".join(f"NULLIF({c}, '') AS {c}" for c in cols)


def _store(spark, root):
    store = TableStore(spark, f"{root}/warehouse")
    ledger = ledger_ops.Ledger(spark, store)
    ledger.initialize()
    return store, ledger


def _ingest(spark, store, ledger, name, cfg, root, run=None):
    run = run or f"run-{uuid.uuid4().hex[:8]}"
    return load_files(spark, store, ledger, name, cfg, root, run, ledger_ops.now())


_ERP_WORKFLOW_KEYS = ["WORKFLOW_EVENT_ID", "WORKFLOW_ID", "EVENT_SEQUENCE", "INVOICE_NUMBER",
                      "SUPPLIER_ID", "INVOICE_AMOUNT_USD", "WORKFLOW_STAGE", "PREVIOUS_STATUS",
                      "CURRENT_STATUS", "STAGE_DURATION_HOURS", "EXCEPTION_REASON"]


def _lineage(store, ledger, table):
    """Bronze rows with what their lineage says: the source folder's name, and
    whether the file history holds the row's file, run and row count."""
    rows = store.read(table)
    landed = rows.groupBy("_source_file", "_run_id").agg(F.count(F.lit(1)).alias("row_count"))
    known = ledger.raw("metadata.file_history").select(F.col("source_file").alias("_source_file"), F.col("run_id").alias("_run_id"),
                                                       "row_count", F.lit(True).alias("in_history"))
    # a row per file: broadcast, so that the rows themselves aren't shuffled
    seen = F.broadcast(landed.join(known, ["_source_file", "_run_id", "row_count"], "left").drop("row_count"))
    return (rows.join(seen, ["_source_file", "_run_id"])
            .withColumn("source_folder", F.element_at(F.split("_source_file", "/"), -2))
            .withColumn("in_history", F.coalesce("in_history", F.lit(False))))


_LINEAGE_SQL = "'{folder}' AS source_folder, TRUE AS in_history"


@register("ingest_csv_append", O.with_bronze(
    "erp", f"SELECT {_nullif_all(ERP_SOURCE_COLUMNS)}, {_LINEAGE_SQL.format(folder='erp 50%+ x')} FROM bz"))
def q_ingest_csv_append(spark, sf_dir):
    """Derived ERP rows as several CSV files, in a folder whose name has
    blanks and a percent sign -> two incremental runs (the second finds nothing
    new) -> Bronze read back with its lineage."""
    root = scratch(spark, "ingest")
    write_csv(bronze(spark, sf_dir, "erp", spread=True).select(*ERP_SOURCE_COLUMNS), f"{root}/source/erp 50%+ x")
    store, ledger = _store(spark, root)
    cfg = {"source_folder": "source/erp 50%+ x", "source_pattern": "*.csv", "bronze_table": "bronze.erp"}
    _ingest(spark, store, ledger, "erp", cfg, root)
    _ingest(spark, store, ledger, "erp", cfg, root)
    return _lineage(store, ledger, "bronze.erp").select(*ERP_SOURCE_COLUMNS, "source_folder", "in_history")


def _workflow_csv(spark, sf_dir, root, keep_empty=False):
    write_csv(bronze(spark, sf_dir, "workflow", spread=True).select(*_ERP_WORKFLOW_KEYS), f"{root}/wf")
    found = src_files.discover(spark, f"{root}/wf", "*.csv")
    frames = scan_profiled(spark, src_files.profile(spark, found), keep_empty=keep_empty)
    out = frames[0][1]
    for _, f in frames[1:]:
        out = out.unionByName(f)
    return out.drop("_source_file")


@register("scan_csv_strings", O.with_bronze("workflow", f"SELECT {_nullif_all(_ERP_WORKFLOW_KEYS)} FROM bz"))
def q_scan_csv_strings(spark, sf_dir):
    return _workflow_csv(spark, sf_dir, scratch(spark, "scan"))


@register("scan_csv_keep_empty", O.with_bronze(
    "workflow", "SELECT " + ", ".join(f"COALESCE({c}, '') AS {c}" for c in _ERP_WORKFLOW_KEYS) + " FROM bz"))
def q_scan_csv_keep_empty(spark, sf_dir):
    return _workflow_csv(spark, sf_dir, scratch(spark, "scan"), keep_empty=True)


_NOTE = "concat({c}, {nl}, '\"', {k}, '\", line ', {nl}, {nl}, 'end')"


@register("scan_csv_quoted_breaks", "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, "
          + _NOTE.format(c="o_orderpriority", k="o_orderkey", nl="chr(10)") + " AS note, o_orderstatus AS status FROM orders")
def q_scan_csv_quoted_breaks(spark, sf_dir):
    """Orders with a note of several lines, quotes and separators in it, as CSV
    files; every file is cut into blocks of 64 KB and its records put together."""
    from millrace.sources.records import scan_records
    root = scratch(spark, "breaks")
    orders = read_table(spark, sf_dir, "orders")
    write_csv(orders.select(F.col("o_orderkey").cast("string").alias("order_key"),
                            F.expr(_NOTE.format(c="o_orderpriority", k="o_orderkey", nl="chr(10)")).alias("note"),
                            F.col("o_orderstatus").alias("status")), root, key="status")
    paths = [r.path for r in src_files.discover(spark, root, "*.csv").select("path").collect()]
    rows, irregular = scan_records(spark, paths, ["order_key", "note", "status"], ",", block_bytes=1 << 16)
    if irregular:
        raise RuntimeError(f"irregular quotes in {irregular}")
    return rows.drop("_source_file")


@register("scan_parquet", O.with_bronze("customer", "SELECT * FROM bz"))
def q_scan_parquet(spark, sf_dir):
    root = scratch(spark, "parquet")
    bronze(spark, sf_dir, "customer").write.parquet(f"{root}/customer.parquet")
    return scan_parquet(spark, f"{root}/customer.parquet")


_SEPS = [",", ";", "\t", "|"]


@register("sniff_delimiter", O.with_bronze("workflow", """
SELECT WORKFLOW_EVENT_ID, WORKFLOW_STAGE, NULLIF(EXCEPTION_REASON, '') AS EXCEPTION_REASON,
       CASE CAST(WORKFLOW_EVENT_ID AS BIGINT) % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9) ELSE '|' END AS detected_sep
FROM bz"""))
def q_sniff_delimiter(spark, sf_dir):
    root = scratch(spark, "sniff")
    wf = bronze(spark, sf_dir, "workflow").select(*_ERP_WORKFLOW_KEYS)
    folders = []
    for i, sep in enumerate(_SEPS):
        part = wf.where(F.col("WORKFLOW_EVENT_ID").cast("bigint") % 4 == i)
        folders.append(write_csv(part, f"{root}/sep{i}", sep=sep))
    prof = src_files.profile(spark, src_files.discover(spark, folders, "*.csv"))
    frames = scan_profiled(spark, prof)
    rows = frames[0][1]
    for _, f in frames[1:]:
        rows = rows.unionByName(f)
    seps = prof.select(F.col("path").alias("_source_file"), F.col("sep").alias("detected_sep"))
    return rows.join(seps, "_source_file").select("WORKFLOW_EVENT_ID", "WORKFLOW_STAGE",
                                                  "EXCEPTION_REASON", "detected_sep")


_CUST_B_ORDER = ["MODIFIED_DATE", "City", "customer_id", "order_ref"]


@register("append_by_name", O.with_bronze("customer", """
SELECT _run_id AS order_ref, customer_id,
       CASE WHEN CAST(_run_id AS BIGINT) % 2 = 0 THEN NULLIF(customer_name, '') END AS customer_name,
       NULLIF(city, '') AS city, NULLIF(modified_date, '') AS modified_date,
       CASE WHEN CAST(_run_id AS BIGINT) % 2 = 0 THEN 'early 1%' ELSE 'late [2]' END AS source_folder, TRUE AS in_history
FROM bz"""))
def q_append_by_name(spark, sf_dir):
    """Run 1 loads files with one header; run 2 adds files whose columns are
    reordered, differently cased and missing one: aligned by name."""
    root = scratch(spark, "byname")
    c = bronze(spark, sf_dir, "customer").withColumn("order_ref", F.col("_run_id"))
    even = F.col("order_ref").cast("bigint") % 2 == 0
    write_csv(c.where(even).select("order_ref", *CUSTOMER_SOURCE_COLUMNS), f"{root}/src/early 1%", key="order_ref")
    store, ledger = _store(spark, root)
    cfg = {"source_folder": "src", "source_pattern": "*/*.csv", "bronze_table": "bronze.customer"}
    _ingest(spark, store, ledger, "customer", cfg, root)
    later = c.where(~even).select(F.col("modified_date").alias("MODIFIED_DATE"),
                                  F.col("city").alias("City"), "customer_id", "order_ref")
    write_csv(later, f"{root}/src/late [2]", key="order_ref")
    _ingest(spark, store, ledger, "customer", cfg, root)
    return _lineage(store, ledger, "bronze.customer").select("order_ref", *CUSTOMER_SOURCE_COLUMNS, "source_folder", "in_history")


@register("append_dataframe", O.with_bronze(
    "customer", "SELECT customer_id, customer_name, city, modified_date, "
                "'/inbound/customer_frame.csv' AS _source_file FROM bz"))
def q_append_dataframe(spark, sf_dir):
    root = scratch(spark, "frame")
    store, _ = _store(spark, root)
    df = bronze(spark, sf_dir, "customer").select(*CUSTOMER_SOURCE_COLUMNS)
    bronze_ops.append_dataframe(store, "bronze.customer", df, "/inbound/customer_frame.csv",
                                "run-frame", ledger_ops.now())
    return store.read("bronze.customer").select(*CUSTOMER_SOURCE_COLUMNS, "_source_file")


@register("replace_load", O.with_bronze("customer", f"SELECT {_nullif_all(CUSTOMER_SOURCE_COLUMNS)} FROM bz"))
def q_replace_load(spark, sf_dir):
    """Append half the rows, then a replace run over the full snapshot: every
    row exactly once."""
    root = scratch(spark, "replace")
    c = bronze(spark, sf_dir, "customer").select(*CUSTOMER_SOURCE_COLUMNS, "_run_id")
    store, ledger = _store(spark, root)
    write_csv(c.where(F.col("_run_id").cast("bigint") % 2 == 0).drop("_run_id"), f"{root}/half")
    _ingest(spark, store, ledger, "customer", {"source_folder": "half", "bronze_table": "bronze.customer"}, root)
    write_csv(c.drop("_run_id"), f"{root}/full", key="customer_id")
    _ingest(spark, store, ledger, "customer",
            {"source_folder": "full", "bronze_table": "bronze.customer", "append": False}, root)
    return store.read("bronze.customer").select(*CUSTOMER_SOURCE_COLUMNS)


@contextmanager
def _writers(spark, most=16):
    """Tasks keep up to ``most`` partition files open instead of sorting their
    rows by partition; with more partitions the rest is sorted."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


@register("rows_per_file", O.with_bronze(
    "erp", "SELECT _source_file AS source_group, count(*) AS row_count FROM bz GROUP BY _source_file"))
def q_rows_per_file(spark, sf_dir):
    root = scratch(spark, "perfile")
    b = bronze(spark, sf_dir, "erp", spread=True).select(*ERP_SOURCE_COLUMNS, F.col("_source_file").alias("src"))
    with _writers(spark):
        b.write.partitionBy("src").options(
            header="true", escape='"', ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false").csv(f"{root}/src")
    store, _ = _store(spark, root)
    prof = src_files.profile(spark, src_files.discover(spark, f"{root}/src", "*.csv", recursive=True))
    counts = bronze_ops.land(store, "bronze.erp", scan_profiled(spark, prof), "run-1", ledger_ops.now())
    return (counts.select(F.regexp_extract("_source_file", r"src=([^/]+)/", 1).alias("source_group"),
                          "row_count")
            .groupBy("source_group").agg(F.sum("row_count").cast("bigint").alias("row_count")))


@register("required_columns", O.with_bronze("workflow", """
SELECT CASE WHEN CAST(WORKFLOW_EVENT_ID AS BIGINT) % 2 = 0 THEN 'full' ELSE 'partial' END AS file_group,
       CASE WHEN CAST(WORKFLOW_EVENT_ID AS BIGINT) % 2 = 0 THEN '' ELSE 'SUPPLIER_ID,WORKFLOW_ID' END AS missing_columns,
       count(*) AS row_count
FROM bz GROUP BY 1, 2"""))
def q_required_columns(spark, sf_dir):
    root = scratch(spark, "required")
    wf = bronze(spark, sf_dir, "workflow").select(*_ERP_WORKFLOW_KEYS)
    even = F.col("WORKFLOW_EVENT_ID").cast("bigint") % 2 == 0
    write_csv(wf.where(even), f"{root}/full")
    write_csv(wf.where(~even).drop("SUPPLIER_ID", "WORKFLOW_ID"), f"{root}/partial")
    prof = src_files.profile(spark, src_files.discover(spark, [f"{root}/full", f"{root}/partial"], "*.csv"))
    miss = src_files.missing_required(prof, ["WORKFLOW_ID", "SUPPLIER_ID"])
    rows = None
    for _, f in scan_profiled(spark, prof):
        f = f.select("_source_file")
        rows = f if rows is None else rows.unionByName(f)
    per_file = rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
    return (per_file.join(miss.withColumnRenamed("path", "_source_file"), "_source_file")
            .select(F.regexp_extract("_source_file", r"/(full|partial)/", 1).alias("file_group"),
                    F.array_join("missing", ",").alias("missing_columns"), "n")
            .groupBy("file_group", "missing_columns").agg(F.sum("n").cast("bigint").alias("row_count")))


@register("unsupported_files", """
SELECT '.json' AS suffix, count(DISTINCT c_mktsegment) AS files FROM customer
UNION ALL SELECT '.txt', count(DISTINCT c_nationkey) FROM customer""")
def q_unsupported_files(spark, sf_dir):
    """CSV, JSON and text files of customers in one tree, one JSON file per
    market segment and one text file per nation: the discovery lists those
    whose suffix no reader supports."""
    root = scratch(spark, "unsupported")
    c = read_table(spark, sf_dir, "customer")
    c.select("c_custkey", "c_mktsegment").repartition("c_mktsegment").write.partitionBy("c_mktsegment").csv(f"{root}/in/a")
    c.select("c_custkey", "c_mktsegment").repartition("c_mktsegment").write.partitionBy("c_mktsegment").json(f"{root}/in/b")
    c.select(F.col("c_name"), "c_nationkey").repartition("c_nationkey").write.partitionBy("c_nationkey").text(f"{root}/in/c")
    bad = src_files.unsupported(src_files.discover(spark, f"{root}/in", "*/*/part-*"))
    return bad.groupBy("suffix").agg(F.count(F.lit(1)).alias("files"))


# ------------------------------------------------------------------ ledger (derived from events)

def _ledger_frame(spark, sf_dir):
    return bronze(spark, sf_dir, "ledger")


_HISTORY_COLS = [f.name for f in ledger_ops.FILE_HISTORY.fields]
_LEDGER_CTE = f"lg AS ({bronze_sql('ledger')})"


def _with_ledger(body: str) -> str:
    return f"WITH {_LEDGER_CTE}\n{body}"


@register("upsert_latest", _with_ledger(f"""
SELECT {', '.join(_HISTORY_COLS)} FROM lg
QUALIFY row_number() OVER (PARTITION BY pipeline_name, source_file, file_hash
                           ORDER BY loaded_at DESC NULLS LAST, run_id DESC NULLS LAST) = 1"""))
def q_upsert_latest(spark, sf_dir):
    _, ledger = _store(spark, scratch(spark, "ledger"))
    ledger.record_files(_ledger_frame(spark, sf_dir))
    return ledger.latest("metadata.file_history").select(*_HISTORY_COLS)


@register("loaded_by_hash", _with_ledger("""
SELECT DISTINCT 'file_'||CAST(o_custkey AS VARCHAR)||'.csv' AS source_file, 'h'||CAST(o_orderkey % 5 AS VARCHAR) AS file_hash
FROM orders o
WHERE EXISTS (SELECT 1 FROM lg WHERE lg.status = 'SUCCESS' AND lg.pipeline_name = 'events'
              AND lg.source_file = 'file_'||CAST(o.o_custkey AS VARCHAR)||'.csv'
              AND lg.file_hash = 'h'||CAST(o.o_orderkey % 5 AS VARCHAR))"""))
def q_loaded_by_hash(spark, sf_dir):
    probes_ = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("file_"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("path"),
        F.concat(F.lit("h"), (F.col("o_orderkey") % 5).cast("string")).alias("file_hash")).distinct()
    return ledger_ops.loaded_by_hash(probes_, _ledger_frame(spark, sf_dir), "events") \
        .select(F.col("path").alias("source_file"), "file_hash")


_LISTING = """
SELECT DISTINCT source_file AS path, file_size_bytes,
       CASE WHEN event_id % 4 = 0 THEN file_modified_at + INTERVAL 1 DAY ELSE file_modified_at END AS file_modified_at
FROM lg"""


@register("incremental_skip", _with_ledger(f"""
SELECT * FROM ({_LISTING}) d
WHERE NOT EXISTS (SELECT 1 FROM lg WHERE lg.pipeline_name = 'events' AND lg.status = 'SUCCESS'
                  AND lg.source_file = d.path AND lg.file_size_bytes = d.file_size_bytes
                  AND lg.file_modified_at = d.file_modified_at)"""))
def q_incremental_skip(spark, sf_dir):
    lg = _ledger_frame(spark, sf_dir)
    listing = lg.select(
        F.col("source_file").alias("path"), "file_size_bytes",
        F.when(F.col("event_id") % 4 == 0, F.col("file_modified_at") + F.expr("INTERVAL 1 DAY"))
         .otherwise(F.col("file_modified_at")).alias("file_modified_at")).distinct()
    return ledger_ops.new_or_changed_files(listing, lg, "events")


@register("watermark_upsert", _with_ledger("""
SELECT pipeline_name, watermark_value, run_id FROM (
  SELECT event_type AS pipeline_name, 'run-'||CAST(user_id % 3 AS VARCHAR) AS run_id,
         max(file_modified_at) AS watermark_value, max(loaded_at) AS updated_at
  FROM lg GROUP BY 1, 2) w
QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY updated_at DESC, run_id DESC) = 1"""))
def q_watermark_upsert(spark, sf_dir):
    """Every (pipeline, run) sets the pipeline's watermark from its files, in
    the order of their load times; the last one stays."""
    _, ledger = _store(spark, scratch(spark, "ledger"))
    lg = _ledger_frame(spark, sf_dir).withColumn("run", F.concat(F.lit("run-"), (F.col("user_id") % 3).cast("string")))
    runs = lg.groupBy("event_type", "run").agg(F.max("loaded_at").alias("at")).orderBy("at", "run").collect()
    for r in runs:       # event types times three
        ledger.set_watermark(r["event_type"], r["run"], lg.where((F.col("event_type") == r["event_type"]) & (F.col("run") == r["run"])))
    return ledger.latest("metadata.watermark").select("pipeline_name", "watermark_value", "run_id")


@register("run_log_latest", _with_ledger("""
SELECT 'run-'||CAST(user_id AS VARCHAR) AS run_id, status, loaded_at AS recorded_at, row_count AS rows_loaded
FROM lg
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY loaded_at DESC, status DESC, row_count DESC) = 1"""))
def q_run_log_latest(spark, sf_dir):
    """Each event is one state record of run ``run-<user_id>`` (the ledger's
    order within a run: record time, then status)."""
    _, ledger = _store(spark, scratch(spark, "ledger"))
    none = F.lit(None)
    ledger.append_frame("metadata.elt_run_log", _ledger_frame(spark, sf_dir).select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), "pipeline_name", F.col("loaded_at").alias("started_at"),
        none.alias("ended_at"), "status", none.alias("files_found"), none.alias("files_loaded"), F.col("row_count").alias("rows_loaded"),
        "error_message", F.col("loaded_at").alias("recorded_at")))
    return ledger.latest("metadata.elt_run_log").select("run_id", "status", "recorded_at", "rows_loaded")


@register("audit_rollup", _with_ledger("""
SELECT CASE event_id % 5 WHEN 0 THEN 'DISCOVERY' WHEN 1 THEN 'BRONZE' WHEN 2 THEN 'DBT_BUILD'
                         WHEN 3 THEN 'EXPORT' ELSE 'PIPELINE' END AS stage,
       status, count(*) AS events, CAST(sum(row_count) AS BIGINT) AS rows_total,
       count(DISTINCT user_id) AS runs
FROM lg GROUP BY 1, 2"""))
def q_audit_rollup(spark, sf_dir):
    _, ledger = _store(spark, scratch(spark, "ledger"))
    stage = F.element_at(F.array(*[F.lit(s) for s in ledger_ops.STAGES]), (F.col("event_id") % 5 + 1).cast("int"))
    ledger.append_frame("metadata.audit_log", _ledger_frame(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("audit_id"), F.col("user_id").cast("string").alias("run_id"), "pipeline_name",
        stage.alias("stage"), F.col("loaded_at").alias("event_time"), "status", "row_count", F.col("error_message").alias("message")))
    return ledger.raw("metadata.audit_log").groupBy("stage", "status").agg(
        F.count(F.lit(1)).alias("events"), F.sum("row_count").cast("bigint").alias("rows_total"),
        F.count_distinct("run_id").alias("runs"))


@register("history_recent", _with_ledger(f"""
SELECT {', '.join(_HISTORY_COLS)} FROM lg
ORDER BY loaded_at DESC, source_file, file_hash, run_id LIMIT 10"""))
def q_history_recent(spark, sf_dir):
    """Top-10 most recent loads (the limit is the report)."""
    return (_ledger_frame(spark, sf_dir).select(*_HISTORY_COLS)
            .orderBy(F.col("loaded_at").desc(), "source_file", "file_hash", "run_id").limit(10))


@register("table_sample", O.with_bronze("customer", """
SELECT * FROM bz ORDER BY customer_id, _run_id LIMIT 10"""))
def q_table_sample(spark, sf_dir):
    return bronze(spark, sf_dir, "customer").orderBy("customer_id", "_run_id").limit(10)


# ERP rows with the files they go to: by order range, and in every third file
# the region holds a separator, quotes and a line feed.
_FILE_KEY = "CAST(split_part(ERP_RECORD_ID, '-', 1) AS BIGINT) // 2048"
_FILE_REGION = "CASE WHEN {file} % 3 = 0 THEN REGION || ', \"' || COUNTRY_CODE || '\"' || chr(10) || 'x' ELSE REGION END"


def _erp_files(spark, sf_dir, root):
    """Full ERP files of known text: one per range of orders, in record order.

    Rows are shuffled and sorted before the text columns are derived from them."""
    key = F.expr(_FILE_KEY.replace("//", "div").replace("ERP_RECORD_ID", erp_cell("ERP_RECORD_ID")))
    rows = erp_joined(spark, sf_dir).repartition(key).withColumn("file", key).withColumn("record", F.expr(erp_cell("ERP_RECORD_ID")))
    cells = {c: erp_cell(c) for c in ERP_SOURCE_COLUMNS} | {"ERP_RECORD_ID": "record"}
    cells["REGION"] = _FILE_REGION.format(file="file").replace("COUNTRY_CODE", cells["COUNTRY_CODE"]).replace("REGION", cells["REGION"])
    cells = {c: F.expr(x) for c, x in cells.items()}
    order = [F.coalesce(x, F.lit("")) for x in cells.values()]            # record ids may repeat
    (rows.sortWithinPartitions("file", *order).select("file", *(x.alias(c) for c, x in cells.items()))
     .write.partitionBy("file").options(**SOURCE_CSV_OPTIONS).csv(f"{root}/erp"))
    return src_files.discover(spark, f"{root}/erp", "file=*/*.csv")


def _file_number():
    return F.regexp_extract("path", r"file=(\d+)/", 1).cast("bigint").alias("file")


def _file_text() -> str:
    """Each file's content, by the rules of CSV."""
    cells = [f"CASE WHEN {c} IS NULL THEN '' WHEN {c} = '' THEN '\"\"' WHEN regexp_matches({c}, '[,\"\\n]') "
             f"THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE {c} END" for c in ERP_SOURCE_COLUMNS]
    return O.with_bronze("erp", "", f"""k AS (SELECT *, {_FILE_KEY} AS file FROM bz),
r AS (SELECT * REPLACE ({_FILE_REGION.format(file='file')} AS REGION) FROM k),
f AS (SELECT file, '{','.join(ERP_SOURCE_COLUMNS)}' || chr(10) ||
             string_agg({" || ',' || ".join(cells)} || chr(10), '' ORDER BY {', '.join(f"coalesce({c}, '')" for c in ERP_SOURCE_COLUMNS)}) AS content FROM r GROUP BY file)
""")


@register("discover_files", _file_text() + """
SELECT file, '.csv' AS suffix, strlen(content) AS file_size_bytes, TRUE AS modified_today FROM f""")
def q_discover_files(spark, sf_dir):
    """The files of a tree by a pattern with folders: name parts, size, time."""
    found = _erp_files(spark, sf_dir, scratch(spark, "discover"))
    today = F.abs(F.datediff(F.current_date(), F.to_date("file_modified_at"))) <= 1
    return found.select(_file_number(), "suffix", "file_size_bytes", today.alias("modified_today")).orderBy("file")


@register("file_profile", _file_text() + f"""
SELECT file, sha256(content) AS file_hash, ',' AS sep, '{','.join(ERP_SOURCE_COLUMNS)}' AS column_names, file % 3 = 0 AS quoted FROM f""")
def q_file_profile(spark, sf_dir):
    """SHA-256, separator, header columns and quoted line breaks of ERP files with known content."""
    prof = src_files.profile(spark, _erp_files(spark, sf_dir, scratch(spark, "profile")))
    return prof.select(_file_number(), "file_hash", "sep", F.array_join("columns", ",").alias("column_names"), "quoted")


# ------------------------------------------------------------------ sinks

def _mart_erp_store(spark, sf_dir, label):
    root = scratch(spark, label)
    store = TableStore(spark, f"{root}/warehouse")
    store.overwrite("mart.erp", marts.mart_erp(silver_erp_df(spark, sf_dir), FIXTURE_AS_OF))
    return root, store


@register("export_parquet", O.MART_ERP)
def q_export_parquet(spark, sf_dir):
    root, store = _mart_erp_store(spark, sf_dir, "export")
    out = export_tables(store, ["mart.erp"], f"{root}/exports", parquet=True)
    return spark.read.parquet(out[0])


@register("export_csv", O.MART_ERP)
def q_export_csv(spark, sf_dir):
    root, store = _mart_erp_store(spark, sf_dir, "export")
    out = export_tables(store, ["mart.erp"], f"{root}/exports", parquet=False, csv=True)
    return spark.read.schema(quality.ERP_CONTRACT).options(**CSV_OPTIONS).csv(out[0])


# ------------------------------------------------------------------ build and pipelines (rows-only)

def _landed_store(spark, sf_dir, root):
    store, ledger = _store(spark, root)
    now_ = ledger_ops.now()
    for name, cols in (("erp", ERP_SOURCE_COLUMNS), ("workflow", WORKFLOW_SOURCE_COLUMNS),
                       ("customer", CUSTOMER_SOURCE_COLUMNS)):
        df = bronze(spark, sf_dir, name)
        store.write_batch(f"bronze.{name}", df.select(*cols, "_source_file", "_loaded_at", "_run_id"),
                          "derived")
    return store, ledger, now_


_BUILD_COUNTS = [("stg_erp", "silver.erp", "lines"), ("stg_workflow", "silver.workflow", "acts"),
                 ("stg_customer", "silver.customer", "scu"), ("dim_invoice", "mart.dim_invoice", "inv"),
                 ("fact_invoice", "mart.fact_invoice", "lines"),
                 ("fact_workflow_event", "mart.fact_workflow_event", "acts"),
                 ("customer", "mart.customer", "scu"), ("erp", "mart.erp", "inv"),
                 ("workflow", "mart.workflow", _MW)]
ORACLE_BUILD_REPORT = _dq_oracle([
    f"SELECT '{m}' AS model, '{t}' AS table_name, count(*) AS row_count, 'SUCCESS' AS status FROM {src} x"
    for m, t, src in _BUILD_COUNTS])


@register("build_report", ORACLE_BUILD_REPORT)
def q_build_report(spark, sf_dir):
    from millrace.plans.models import build
    root = scratch(spark, "build")
    store, _, _ = _landed_store(spark, sf_dir, root)
    report = build(store, "+tag:workflow tag:erp tag:customer", FIXTURE_AS_OF)
    return spark.createDataFrame(report, "model string, table_name string, row_count long, status string")


# ------------------------------------------------------------------ batches: what counts, what is rebuilt

def _dealt(df, n):
    """``df`` in n parts by a checksum of its first column, so that invoices span parts."""
    part = F.pmod(F.crc32(F.coalesce(F.col(df.columns[0]), F.lit("")).cast("binary")), F.lit(n))
    return [df.where(part == i) for i in range(n)]


def _batch_rows(spark, sf_dir, name, columns):
    return bronze(spark, sf_dir, name).select(*columns, "_source_file", "_loaded_at", "_run_id")


@register("committed_reads", O.with_bronze("erp", f"SELECT * FROM ({O.SILVER_ERP}) WHERE CAST(substr(_run_id, 5) AS BIGINT) % 3 <> 1"))
def q_committed_reads(spark, sf_dir):
    """Three runs land ERP rows; the second's files are never recorded, as after
    a crash.  Silver, built afterwards, holds the recorded runs' rows only."""
    from millrace.plans.models import build
    store, ledger = _store(spark, scratch(spark, "committed"))
    rows = _batch_rows(spark, sf_dir, "erp", ERP_SOURCE_COLUMNS)
    for i, run in enumerate(("first", "crashed", "last")):
        store.write_batch("bronze.erp", rows.where(F.substring("_run_id", 5, 20).cast("bigint") % 3 == i), f"erp.{run}")
        if run != "crashed":
            ledger.record_files(spark.createDataFrame(
                [("erp", f"/in/{run}.csv", run, 1, None, ledger_ops.now(), run, 1, "SUCCESS", None)], ledger_ops.FILE_HISTORY))
    build(store, "stg_erp")
    return store.read("silver.erp")


@register("silver_rewritten_batch", O.with_bronze("erp", O.SILVER_ERP))
def q_silver_rewritten_batch(spark, sf_dir):
    """Silver is built, a Bronze batch is written again with other rows, Silver
    is built again: it equals Bronze."""
    from millrace.plans.models import build
    store, _ = _store(spark, scratch(spark, "rewritten"))
    a, b = _dealt(_batch_rows(spark, sf_dir, "erp", ERP_SOURCE_COLUMNS), 2)
    store.write_batch("bronze.erp", a, "one")
    store.write_batch("bronze.erp", a, "two")
    build(store, "stg_erp")
    store.write_batch("bronze.erp", b, "two")
    build(store, "stg_erp")
    return store.read("silver.erp")


def _built_in_steps(spark, sf_dir, selector, names):
    from millrace.plans.models import build
    store, _ = _store(spark, scratch(spark, "steps"))
    columns = {"erp": ERP_SOURCE_COLUMNS, "workflow": WORKFLOW_SOURCE_COLUMNS}
    parts = {n: _dealt(_batch_rows(spark, sf_dir, n, columns[n]), 3) for n in names}
    for step, batches in enumerate((("b0", "b1"), ("b2",))):
        for batch in batches:
            for n in names:
                store.write_batch(f"bronze.{n}", parts[n][int(batch[1])], batch)
        build(store, selector, FIXTURE_AS_OF)
    return store


@register("mart_erp_incremental", O.MART_ERP)
def q_mart_erp_incremental(spark, sf_dir):
    """The invoice mart merged from per-batch partial aggregates over two
    builds; invoices span the batches."""
    return _built_in_steps(spark, sf_dir, "+erp", ["erp"]).read("mart.erp")


@register("mart_workflow_incremental", O.MART_WORKFLOW)
def q_mart_workflow_incremental(spark, sf_dir):
    """The workflow mart likewise: latest event and stage sets merge."""
    return _built_in_steps(spark, sf_dir, "+workflow", ["erp", "workflow"]).read("mart.workflow")


_APP = {"warehouse": "warehouse", "exports": {"folder": "exports", "parquet": True, "csv": False}}
_PIPES = {
    "erp": {"source_folder": "source/erp", "source_pattern": "*.csv", "bronze_table": "bronze.erp",
            "dbt_selector": "tag:erp", "mart_tables": ["mart.erp"]},
    "workflow": {"source_folder": "source/workflow", "source_pattern": "*.csv",
                 "bronze_table": "bronze.workflow", "required_columns": ["WORKFLOW_ID", "SUPPLIER_ID"],
                 "dbt_selector": "+tag:workflow", "mart_tables": ["mart.workflow"]},
    "customer": {"source_folder": "source/customer", "source_pattern": "*.csv", "append": False,
                 "bronze_table": "bronze.customer", "dbt_selector": "tag:customer",
                 "mart_tables": ["mart.customer"]},
}


def _write_sources(spark, sf_dir, root):
    for name, columns in (("erp", ERP_SOURCE_COLUMNS), ("workflow", WORKFLOW_SOURCE_COLUMNS), ("customer", CUSTOMER_SOURCE_COLUMNS)):
        write_csv(bronze(spark, sf_dir, name, spread=True).select(*columns), f"{root}/source/{name}")


ORACLE_PIPELINE_ERP = O.with_erp("""
SELECT 'erp' AS pipeline_name, 'BRONZE' AS stage, 'SUCCESS' AS status, CAST(count(*) AS BIGINT) AS row_count FROM bz
UNION ALL
SELECT 'erp', 'DBT_BUILD', 'SUCCESS', CAST(2 * (SELECT count(*) FROM lines) + 2 * (SELECT count(*) FROM inv) AS BIGINT)
UNION ALL
SELECT 'erp', 'EXPORT', 'SUCCESS', CAST(0 AS BIGINT)""")


@register("pipeline_erp", ORACLE_PIPELINE_ERP)
def q_pipeline_erp(spark, sf_dir):
    """One ERP run end to end; returns that run's audit trail (rows loaded,
    rows built over stg_erp + dim_invoice + fact_invoice + erp, export); the
    discovery stage's file count depends on how the sources were split into
    files and is left out."""
    root = scratch(spark, "pipeline")
    _write_sources(spark, sf_dir, root)
    app = {**_APP, "root": root}
    r = run_pipeline(spark, "erp", _PIPES["erp"], app, FIXTURE_AS_OF)
    store = TableStore(spark, f"{root}/warehouse")
    return (store.read("metadata.audit_log")
            .where((F.col("run_id") == r["run_id"]) & (F.col("stage") != "DISCOVERY"))
            .select("pipeline_name", "stage", "status", "row_count"))


ORACLE_PIPELINE_ALL = f"""
WITH be AS ({bronze_sql('erp')}), bw AS ({bronze_sql('workflow')}), bc AS ({bronze_sql('customer')})
SELECT 'erp' AS pipeline, 'SUCCESS' AS status, CAST(count(*) AS BIGINT) AS rows_loaded FROM be
UNION ALL SELECT 'workflow', 'SUCCESS', CAST(count(*) AS BIGINT) FROM bw
UNION ALL SELECT 'customer', 'SUCCESS', CAST(count(*) AS BIGINT) FROM bc"""


@register("pipeline_all", ORACLE_PIPELINE_ALL)
def q_pipeline_all(spark, sf_dir):
    """ERP, workflow (which needs ERP's Bronze) and a replace-mode customer
    pipeline in configuration order: status and rows loaded per pipeline."""
    root = scratch(spark, "pipeline")
    _write_sources(spark, sf_dir, root)
    status = run_all(spark, _PIPES, {**_APP, "root": root}, as_of=FIXTURE_AS_OF)
    return status.select("pipeline", "status", "rows_loaded")


# ------------------------------------------------------------------ Excel

def _write_workbooks(spark, sf_dir, folder):
    """Customer rows as .xlsx workbooks (one per 50,000-row block of keys),
    written by executors straight into ``folder``."""
    from millrace.sources.excel import write_workbook
    cols = CUSTOMER_SOURCE_COLUMNS

    def write(pdf):
        import pandas as pd
        from millrace.store import arrow_file_system
        block = int(pdf["block"].iloc[0])
        path = f"{folder}/customers_{block:05d}.xlsx"
        data = write_workbook(cols, pdf[cols].itertuples(index=False, name=None))
        filesystem, inner = arrow_file_system(path)
        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(inner) as out:
            out.write(data)
        return pd.DataFrame({"path": [path], "rows": [len(pdf)]})

    c = bronze(spark, sf_dir, "customer").select(*cols, "_run_id")
    blocks = c.withColumn("block", (F.col("_run_id").cast("bigint") / 50000).cast("int")).drop("_run_id")
    return blocks.groupBy("block").applyInPandas(write, "path string, rows long").collect()


_EXCEL_ORACLE = O.with_bronze("customer", "SELECT " + ", ".join(
    f"COALESCE({c}, '') AS {c}" for c in CUSTOMER_SOURCE_COLUMNS) + " FROM bz")


@register("scan_excel", _EXCEL_ORACLE)
def q_scan_excel(spark, sf_dir):
    from millrace.sources.excel import scan_excel
    root = scratch(spark, "excel")
    _write_workbooks(spark, sf_dir, f"{root}/xlsx")
    found = src_files.discover(spark, f"{root}/xlsx", "*.xlsx").orderBy("path").collect()
    frames = scan_excel(spark, [r.path for r in found])
    out = frames[0][1]
    for _, f in frames[1:]:
        out = out.unionByName(f)
    return out.select(*CUSTOMER_SOURCE_COLUMNS)


@register("excel_to_staging", O.with_bronze("customer", "SELECT " + ", ".join(
    f"COALESCE({c}, '') AS {c}" for c in CUSTOMER_SOURCE_COLUMNS) + f", {_LINEAGE_SQL.format(folder='customer 50% x')} FROM bz"))
def q_excel_to_staging(spark, sf_dir):
    """Workbooks -> staged Parquet (one partition per workbook) -> Bronze
    with the original workbook path as lineage."""
    root = scratch(spark, "excel")
    _write_workbooks(spark, sf_dir, f"{root}/source/customer 50% x")
    store, ledger = _store(spark, root)
    cfg = {"source_folder": "source/customer 50% x", "source_pattern": "*.xlsx",
           "bronze_table": "bronze.customer", "excel": {"sheet_name": 0, "header": 0}}
    _ingest(spark, store, ledger, "customer", cfg, root)
    return _lineage(store, ledger, "bronze.customer").select(*CUSTOMER_SOURCE_COLUMNS, "source_folder", "in_history")


# ------------------------------------------------------------------ streaming ingest

@register("stream_ingest_csv", O.with_bronze("erp", f"SELECT {_nullif_all(ERP_SOURCE_COLUMNS)} FROM bz"))
def q_stream_ingest_csv(spark, sf_dir):
    """The ERP CSV files landed by an AvailableNow file stream, in two
    triggers' worth of batches, then re-run on the same checkpoint (nothing
    new: nothing added)."""
    from millrace.streaming.ingest import stream_ingest
    root = scratch(spark, "stream")
    write_csv(bronze(spark, sf_dir, "erp", spread=True).select(*ERP_SOURCE_COLUMNS), f"{root}/source/erp")
    store, ledger = _store(spark, root)
    for _ in range(2):
        stream_ingest(spark, store, ledger, "erp", f"{root}/source/erp", "bronze.erp",
                      f"{root}/checkpoints/erp", max_files_per_trigger=4)
    return store.read("bronze.erp").select(*ERP_SOURCE_COLUMNS)
