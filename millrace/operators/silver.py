"""Silver models: Bronze text -> typed, cleaned rows (MOD-1..3).

Each model is one projection generated from a column spec plus a row filter;
for customers a latest-row-per-key step follows.  All casts are the lenient
JVM-side expressions of :mod:`millrace.functions.casts`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import clean_text, to_bigint, to_date, to_typed
from millrace.operators.latest import latest_by

LINEAGE = ["_source_file", "_loaded_at", "_run_id"]

# Silver ERP columns as (source column, output name, type), in
# output order.  The reference selects COMPANY_CODE twice; the repeat is
# dropped because a table cannot hold two columns of one name.
ERP_SPEC = [
    ("ERP_RECORD_ID", "erp_record_id", "string"),
    ("DOCUMENT_ID", "document_id", "string"),
    ("INVOICE_ID", "invoice_id", "string"),
    ("INVOICE_NUMBER", "invoice_number", "string"),
    ("LINE_NUMBER", "line_number", "string"),
    ("DISTRIBUTION_NUMBER", "distribution_number", "string"),
    ("INVOICE_HEADER_FLAG", "invoice_header_flag", "string"),
    ("SUPPLIER_ID", "supplier_id", "string"),
    ("SUPPLIER_NAME", "supplier_name", "string"),
    ("CRITICAL_SUPPLIER_FLAG", "critical_supplier_flag", "string"),
    ("REGION", "region", "string"),
    ("COUNTRY_CODE", "country_code", "string"),
    ("COMPANY_CODE", "company_code", "string"),
    ("BUSINESS_UNIT", "business_unit", "string"),
    ("COST_CENTER", "cost_center", "string"),
    ("GL_ACCOUNT", "gl_account", "string"),
    ("CATEGORY", "category", "string"),
    ("QUANTITY", "quantity", "string"),
    ("UNIT_PRICE", "unit_price", "decimal(18,2)"),
    ("LINE_AMOUNT_DOC", "line_amount_doc", "decimal(18,2)"),
    ("LINE_AMOUNT_USD", "line_amount_usd", "decimal(18,2)"),
    ("INVOICE_AMOUNT_DOC", "invoice_amount_doc", "decimal(18,2)"),
    ("INVOICE_AMOUNT_USD", "invoice_amount_usd", "decimal(18,2)"),
    ("CURRENCY", "currency", "string"),
    ("FX_RATE", "fx_rate", "decimal(18,3)"),
    ("PAYMENT_TERM_DAYS", "payment_term_days", "int"),
    ("PO_NUMBER", "po_number", "string"),
    ("PO_NON_PO", "po_non_po", "string"),
    ("MATCH_TYPE", "match_type", "string"),
    ("INVOICE_TYPE", "invoice_type", "string"),
    ("INVOICE_DATE", "invoice_date", "date"),
    ("RECEIPT_DATE", "receipt_date", "date"),
    ("CREATION_DATE", "creation_date", "date"),
    ("POSTING_DATE", "posting_date", "date"),
    ("DUE_DATE_RAW", "due_date_raw", "date"),
    ("PAYMENT_DATE", "payment_date", "date"),
    ("PAYMENT_STATUS", "payment_status", "string"),
    ("AMOUNT_PAID", "amount_paid", "decimal(18,2)"),
    ("AMOUNT_REMAINING", "amount_remaining", "decimal(18,2)"),
    ("SOURCE_SYSTEM", "source_system", "string"),
    ("LAST_UPDATED_TIMESTAMP", "last_updated_timestamp", "timestamp"),
    ("LATE_ARRIVAL_FLAG", "late_arrival_flag", "string"),
    ("DQ_SCENARIO", "dq_scenario", "string"),
]

# Silver workflow columns, same layout.  INVOICE_NUMBER is
# selected twice in the reference; the repeat is dropped.  Stage duration is
# cast to a timestamp there (so numbers become NULL); kept as is.
WORKFLOW_SPEC = [
    ("WORKFLOW_EVENT_ID", "workflow_event_id", "string"),
    ("WORKFLOW_ID", "workflow_id", "string"),
    ("EVENT_SEQUENCE", "event_sequence", "string"),
    ("ERP_RECORD_ID", "erp_record_id", "string"),
    ("DOCUMENT_ID", "document_id", "string"),
    ("INVOICE_ID", "invoice_id", "string"),
    ("INVOICE_NUMBER", "invoice_number", "string"),
    ("SUPPLIER_ID", "supplier_id", "string"),
    ("PO_NUMBER", "po_number", "string"),
    ("COMPANY_CODE", "company_code", "string"),
    ("INVOICE_AMOUNT_USD", "invoice_amount_usd", "decimal(18,2)"),
    ("WORKFLOW_STAGE", "workflow_stage", "string"),
    ("PREVIOUS_STATUS", "previous_status", "string"),
    ("CURRENT_STATUS", "current_status", "string"),
    ("PREVIOUS_EVENT_TIMESTAMP", "previous_event_timestamp", "timestamp"),
    ("EVENT_TIMESTAMP", "event_timestamp", "timestamp"),
    ("STAGE_DURATION_HOURS", "stage_duration_hours", "timestamp"),
    ("PROCESSOR_ID", "processor_id", "string"),
    ("EXCEPTION_REASON", "exception_reason", "string"),
]

# Order that decides the surviving customer row: load time first (as in the
# reference), then the remaining columns so ties resolve the same way on
# every run.
CUSTOMER_TIEBREAK = ["_loaded_at", "_run_id", "_source_file", "customer_name", "city", "modified_date"]


def _lookup(df: DataFrame, name: str):
    """Source column by case-insensitive name; a missing column reads as NULL
    (by-name Bronze appends leave absent columns empty)."""
    by_lower = {c.lower(): c for c in df.columns}
    real = by_lower.get(name.lower())
    return F.col(f"`{real}`") if real else F.lit(None).cast("string")


def apply_spec(bronze: DataFrame, spec) -> DataFrame:
    """Two projections: cleaned text first, typed values second.  The cleaned
    text is referenced several times by a lenient cast, so Catalyst keeps it
    as its own column instead of repeating it inside every branch."""
    cleaned = bronze.select(*[clean_text(_lookup(bronze, src)).alias(out) for src, out, _ in spec],
                            *[_lookup(bronze, c).alias(c) for c in LINEAGE])
    typed = [F.col(out) if typ == "string" else to_typed(F.col(out), typ, cleaned=True).alias(out)
             for _, out, typ in spec]
    return cleaned.select(*typed, *LINEAGE)


def key_filter(bronze: DataFrame) -> DataFrame:
    """FLT-1: rows whose cleaned supplier id and invoice number are present.
    Applied on the raw columns so Catalyst evaluates it before the casts."""
    return bronze.filter(clean_text(_lookup(bronze, "SUPPLIER_ID")).isNotNull()
                         & clean_text(_lookup(bronze, "INVOICE_NUMBER")).isNotNull())


def silver_erp(bronze: DataFrame) -> DataFrame:
    return apply_spec(key_filter(bronze), ERP_SPEC)


def silver_workflow(bronze: DataFrame) -> DataFrame:
    return apply_spec(key_filter(bronze), WORKFLOW_SPEC)


def silver_customer(bronze: DataFrame) -> DataFrame:
    """Typed customers, invalid ids dropped, latest load per id kept."""
    typed = bronze.select(
        to_bigint(_lookup(bronze, "customer_id")).alias("customer_id"),
        F.trim(_lookup(bronze, "customer_name")).alias("customer_name"),
        F.trim(_lookup(bronze, "city")).alias("city"),
        to_date(_lookup(bronze, "modified_date")).alias("modified_date"),
        *[_lookup(bronze, c).alias(c) for c in LINEAGE],
    ).filter(F.col("customer_id").isNotNull())
    return latest_by(typed, ["customer_id"], CUSTOMER_TIEBREAK,
                     ["customer_name", "city", "modified_date", *LINEAGE])
