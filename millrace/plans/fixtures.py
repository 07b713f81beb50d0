"""Bronze-shaped inputs derived from the given test tables.

The pipeline's Bronze tables are normally produced by ingesting CSV / Excel
files.  For queries, tests and the bench the same shapes are derived from the
TPC-H-like parquet tables with SQL that runs unchanged in Spark SQL and in
DuckDB, so the Spark pipeline and the DuckDB oracle see identical inputs.
Dirty values (blanks, padding, junk numbers, impossible dates, zero
invoices, non-canonical integers and slash dates) are planted by modulus.

Table references are ``{name}`` placeholders: Spark binds DataFrames to them
(``spark.sql(text, lineitem=df)``) and the oracle substitutes plain view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.parquet import read_table

# Source column lists of the Bronze tables, in source order.
ERP_SOURCE_COLUMNS = [
    "ERP_RECORD_ID", "DOCUMENT_ID", "INVOICE_ID", "INVOICE_NUMBER", "LINE_NUMBER",
    "DISTRIBUTION_NUMBER", "INVOICE_HEADER_FLAG", "SUPPLIER_ID", "SUPPLIER_NAME",
    "CRITICAL_SUPPLIER_FLAG", "REGION", "COUNTRY_CODE", "COMPANY_CODE",
    "BUSINESS_UNIT", "COST_CENTER", "GL_ACCOUNT", "CATEGORY", "QUANTITY",
    "UNIT_PRICE", "LINE_AMOUNT_DOC", "LINE_AMOUNT_USD", "INVOICE_AMOUNT_DOC",
    "INVOICE_AMOUNT_USD", "CURRENCY", "FX_RATE", "PAYMENT_TERM_DAYS", "PO_NUMBER",
    "PO_NON_PO", "MATCH_TYPE", "INVOICE_TYPE", "INVOICE_DATE", "RECEIPT_DATE",
    "CREATION_DATE", "POSTING_DATE", "DUE_DATE_RAW", "PAYMENT_DATE",
    "PAYMENT_STATUS", "AMOUNT_PAID", "AMOUNT_REMAINING", "SOURCE_SYSTEM",
    "LAST_UPDATED_TIMESTAMP", "LATE_ARRIVAL_FLAG", "DQ_SCENARIO",
]
WORKFLOW_SOURCE_COLUMNS = [
    "WORKFLOW_EVENT_ID", "WORKFLOW_ID", "EVENT_SEQUENCE", "ERP_RECORD_ID",
    "DOCUMENT_ID", "INVOICE_ID", "INVOICE_NUMBER", "SUPPLIER_ID", "PO_NUMBER",
    "COMPANY_CODE", "INVOICE_AMOUNT_USD", "WORKFLOW_STAGE", "PREVIOUS_STATUS",
    "CURRENT_STATUS", "PREVIOUS_EVENT_TIMESTAMP", "EVENT_TIMESTAMP",
    "STAGE_DURATION_HOURS", "PROCESSOR_ID", "EXCEPTION_REASON",
]
CUSTOMER_SOURCE_COLUMNS = ["customer_id", "customer_name", "city", "modified_date"]
LINEAGE_COLUMNS = ["_source_file", "_loaded_at", "_run_id"]

# ``as_of`` for the overdue logic on the derived data (order dates run
# 1995-01-01 .. 2001-08-01, so every payment-timing branch occurs).
FIXTURE_AS_OF = "2001-06-30"

_ERP_DERIVED = {
    "ERP_RECORD_ID": "CAST(l_orderkey AS STRING)||'-'||CAST(l_linenumber AS STRING)||'-'||CAST(l_partkey AS STRING)",
    "DOCUMENT_ID": "'D'||CAST(o_orderkey AS STRING)",
    "INVOICE_ID": "CASE WHEN l_linenumber = 5 THEN '' ELSE 'I'||CAST(o_orderkey AS STRING) END",
    "INVOICE_NUMBER": "' INV'||CAST(o_orderkey AS STRING)||' '",
    "LINE_NUMBER": "CAST(l_linenumber AS STRING)",
    "SUPPLIER_ID": "CASE WHEN l_partkey % 97 = 0 THEN '   ' ELSE 'S'||CAST(o_custkey % 100 AS STRING) END",
    "SUPPLIER_NAME": "'Supplier '||CAST(o_custkey % 100 AS STRING)",
    "COMPANY_CODE": "'C'||CAST(l_suppkey % 5 AS STRING)",
    "QUANTITY": "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING)",
    "LINE_AMOUNT_DOC": "CASE WHEN l_partkey % 89 = 0 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END",
    "LINE_AMOUNT_USD": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)",
    "INVOICE_AMOUNT_DOC": "CASE WHEN o_orderkey % 53 = 0 THEN '0.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
    "INVOICE_AMOUNT_USD": "CASE WHEN l_partkey % 7 = 0 THEN '1_000.50' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
    "CURRENCY": "CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE ' EUR ' END",
    "FX_RATE": "CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE CAST(CAST(l_discount AS DECIMAL(18,3)) AS STRING) END",
    "PAYMENT_TERM_DAYS": "CASE l_linenumber WHEN 3 THEN '30.5' WHEN 4 THEN '1e1' WHEN 6 THEN 'net 30' ELSE CAST(o_orderkey % 90 AS STRING) END",
    "INVOICE_DATE": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "RECEIPT_DATE": "CAST(CAST(o_orderdate AS DATE) + 1 AS STRING)",
    "CREATION_DATE": "REPLACE(CAST(CAST(o_orderdate AS DATE) + 2 AS STRING), '-', '/')",
    "POSTING_DATE": "CASE WHEN l_partkey % 83 = 0 THEN '2024-13-01' ELSE CAST(CAST(o_orderdate AS DATE) + 3 AS STRING) END",
    "DUE_DATE_RAW": "CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) END",
    "PAYMENT_DATE": "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS STRING) ELSE '' END",
    "PAYMENT_STATUS": "CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'P' THEN 'Partial' ELSE '' END",
    "AMOUNT_PAID": "CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 'P' THEN '100.00' ELSE '' END",
    "AMOUNT_REMAINING": "CASE o_orderstatus WHEN 'F' THEN '0' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
    "SOURCE_SYSTEM": "'ERP'",
    "LAST_UPDATED_TIMESTAMP": "REPLACE(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '/')||' 10:30:00'",
    "LATE_ARRIVAL_FLAG": "CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'N' END",
    "DISTRIBUTION_NUMBER": "' '||CAST(l_suppkey % 11 AS STRING)",
    "INVOICE_HEADER_FLAG": "CASE WHEN l_linenumber = 1 THEN 'Y' ELSE '' END",
    "CRITICAL_SUPPLIER_FLAG": "CASE WHEN o_custkey % 13 = 0 THEN 'critical' ELSE 'no ' END",
    "REGION": "'region '||CAST(o_custkey % 5 AS STRING)",
    "COUNTRY_CODE": "'K'||CAST(o_custkey % 25 AS STRING)",
    "BUSINESS_UNIT": "'BU-'||CAST(l_partkey % 17 AS STRING)",
    "COST_CENTER": "'CC-'||CAST(l_partkey % 19 AS STRING)||' '",
    "GL_ACCOUNT": "CAST(400000 + l_partkey % 23 AS STRING)",
    "CATEGORY": "'category '||CAST(l_partkey % 6 AS STRING)",
    "UNIT_PRICE": "CASE WHEN l_partkey % 31 = 0 THEN 'free' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)||'7' END",
    "PO_NUMBER": "CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE 'PO'||CAST(o_orderkey AS STRING) END",
    "PO_NON_PO": "CASE WHEN o_orderkey % 4 = 0 THEN 'NON-PO' ELSE 'PO' END",
    "MATCH_TYPE": "CAST(2 + o_orderkey % 2 AS STRING)||'-way'",
    "INVOICE_TYPE": "CASE WHEN o_orderkey % 8 = 0 THEN 'credit' ELSE 'standard' END",
    "DQ_SCENARIO": "CASE WHEN l_partkey % 97 = 0 THEN 'blank supplier' WHEN l_partkey % 89 = 0 THEN 'bad amount' ELSE '' END",
}

_WF_DERIVED = {
    "WORKFLOW_EVENT_ID": "CAST(event_id AS STRING)",
    "WORKFLOW_ID": "'W'||CAST(okey AS STRING)",
    "EVENT_SEQUENCE": "CAST(event_id % 20 AS STRING)",
    "INVOICE_NUMBER": "'INV'||CAST(okey AS STRING)",
    "SUPPLIER_ID": "'S'||CAST(o_custkey % 100 AS STRING)",
    "INVOICE_AMOUNT_USD": "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)",
    "WORKFLOW_STAGE": "event_type",
    "PREVIOUS_STATUS": "'New'",
    "CURRENT_STATUS": "CASE event_type WHEN 'purchase' THEN 'Approved' WHEN 'signup' THEN 'paid' ELSE 'In Review' END",
    # whole weeks: events of an invoice share timestamps, so the text order of
    # EVENT_SEQUENCE ('10' below '2') decides which one is the latest
    "EVENT_TIMESTAMP": "CAST(DATE_TRUNC('week', ts) AS STRING)",
    "PREVIOUS_EVENT_TIMESTAMP": "CASE WHEN event_id % 6 = 0 THEN 'never' ELSE CAST(ts AS STRING) END",
    "ERP_RECORD_ID": "CAST(okey AS STRING)||'-'||CAST(event_id % 7 AS STRING)",
    "DOCUMENT_ID": "' D'||CAST(okey AS STRING)",
    "INVOICE_ID": "CASE WHEN event_id % 9 = 0 THEN '' ELSE 'I'||CAST(okey AS STRING) END",
    "PO_NUMBER": "'PO'||CAST(okey % 1000 AS STRING)||' '",
    "COMPANY_CODE": "'C'||CAST(okey % 5 AS STRING)",
    "PROCESSOR_ID": "CASE WHEN event_id % 12 = 0 THEN ' ' ELSE 'user-'||CAST(user_id % 40 AS STRING) END",
    "STAGE_DURATION_HOURS": "'1.5'",
    "EXCEPTION_REASON": "CASE WHEN event_type = 'error' THEN 'code '||CAST(event_id % 7 AS STRING) ELSE ' ' END",
}


def _select_list(columns, derived):
    return ",\n       ".join(
        f"{derived[c]} AS {c}" if c in derived else f"CAST(NULL AS STRING) AS {c}"
        for c in columns)


_ERP_JOIN = "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"

BRONZE_ERP_SQL = f"""
SELECT {_select_list(ERP_SOURCE_COLUMNS, _ERP_DERIVED)},
       'erp_'||o_orderstatus||'.csv' AS _source_file,
       l_shipdate AS _loaded_at,
       'run-'||CAST(l_orderkey % 3 AS STRING) AS _run_id
{_ERP_JOIN}
"""

BRONZE_WORKFLOW_SQL = f"""
SELECT {_select_list(WORKFLOW_SOURCE_COLUMNS, _WF_DERIVED)},
       'wf.csv' AS _source_file,
       ts AS _loaded_at,
       'run-'||CAST(event_id % 3 AS STRING) AS _run_id
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN event_id ELSE user_id END AS okey FROM {{events}}) e
JOIN {{orders}} ON okey = o_orderkey
"""

BRONZE_CUSTOMER_SQL = """
SELECT CASE WHEN o_orderkey % 37 = 0 THEN 'bad' ELSE CAST(c_custkey AS STRING) END AS customer_id,
       ' '||c_name||' ' AS customer_name,
       c_mktsegment AS city,
       CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS modified_date,
       'c.csv' AS _source_file, o_orderdate AS _loaded_at, CAST(o_orderkey AS STRING) AS _run_id
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_TABLES = {
    "erp": (BRONZE_ERP_SQL, ("lineitem", "orders")),
    "workflow": (BRONZE_WORKFLOW_SQL, ("events", "orders")),
    "customer": (BRONZE_CUSTOMER_SQL, ("orders", "customer")),
}


# the table a Bronze table has its rows from, and a column of it that deals them evenly
_SPREAD = {"erp": ("lineitem", "l_orderkey"), "workflow": ("events", "event_id"), "customer": ("orders", "o_custkey")}


_AMOUNTS = (("orders", "o_totalprice"), ("lineitem", "l_extendedprice"))


def bronze(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Derived Bronze table ``name`` (erp / workflow / customer) as a DataFrame.

    ``spread`` deals the rows over tasks.  The table's own few columns are shuffled
    for that, before the wide text columns are derived from them (the join on
    the same column then needs no further shuffle of them)."""
    text, inputs = _TABLES[name]
    frames = {t: read_table(spark, sf_dir, t) for t in inputs}
    if spread:
        table, column = _SPREAD[name]
        frames[table] = frames[table].repartition(column)
    if name == "erp":
        # amounts become text once a row of their table, not once for every column of every line
        for table, amount in _AMOUNTS:
            sql = f"CAST(CAST({amount} AS DECIMAL(18,2)) AS STRING)"
            frames[table] = frames[table].withColumn(f"{amount}_text", F.expr(sql))
            text = text.replace(sql, f"{amount}_text")
    return spark.sql(text, **frames)


def erp_cell(column: str) -> str:
    """SQL of one ERP column over the joined rows."""
    return f"({_ERP_DERIVED[column]})"


def erp_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows ``bronze("erp")`` is derived from, one by one."""
    return spark.sql(f"SELECT * {_ERP_JOIN}", **{t: read_table(spark, sf_dir, t) for t in ("lineitem", "orders")})


def bronze_sql(name: str) -> str:
    """The same derivation as plain SQL over views named like the tables."""
    text, inputs = _TABLES[name]
    return text.format(**{t: t for t in inputs})


# Edge-case texts for the lenient casts, derived row by row from the tables
# (same SQL in both engines); every spelling family of the cast rules occurs
# on every row, so the casts are checked over the whole tables.
NUMBER_PROBES_SQL = """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS p_plain,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)||'5' AS p_three_places,
       '-'||CAST(l_linenumber AS STRING)||'.5' AS p_negative_half,
       CAST(l_linenumber AS STRING)||'.5' AS p_half,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING)||'e2' AS p_exponent,
       '1_'||LPAD(CAST(l_partkey % 1000 AS STRING), 3, '0')||'.25' AS p_underscore,
       '0x'||CAST(l_linenumber AS STRING)||'f' AS p_hex,
       ' '||CAST(l_suppkey AS STRING)||' ' AS p_padded,
       CAST(l_suppkey AS STRING)||',000' AS p_thousands,
       CAST(l_orderkey AS STRING)||'99999999999999999' AS p_overflow,
       'n/a' AS p_junk,
       CAST(l_linenumber AS STRING)||'.49999999995' AS p_just_below_half,
       '-'||CAST(l_linenumber AS STRING)||'.5000000000000000000001' AS p_just_over_half,
       '0x7ffffffffffffff'||CAST(l_linenumber AS STRING) AS p_large_hex,
       CAST(l_linenumber AS STRING)||'\u0661' AS p_other_digits
FROM {lineitem}
"""

DATE_PROBES_SQL = """
SELECT o_orderkey,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS p_iso,
       REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/') AS p_slash,
       REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', ' ') AS p_space,
       CAST(YEAR(CAST(o_orderdate AS DATE)) AS STRING)||'-'||CAST(MONTH(CAST(o_orderdate AS DATE)) AS STRING)||'-'||CAST(DAY(CAST(o_orderdate AS DATE)) AS STRING) AS p_unpadded,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||' '||CAST(o_orderkey % 24 AS STRING)||':'||LPAD(CAST(o_orderkey % 60 AS STRING), 2, '0')||':05' AS p_with_time,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||'T'||CAST(o_orderkey % 30 AS STRING)||':00' AS p_t_time,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||' 24:00' AS p_midnight24,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||' '||CAST(o_orderkey % 24 AS STRING)||':30:00.1234567+02' AS p_zone_fraction,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||'Z' AS p_bare_zone,
       SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS p_year_month,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||' BC' AS p_trailing_word,
       CAST(YEAR(CAST(o_orderdate AS DATE)) AS STRING)||'-02-'||CAST(28 + o_orderkey % 4 AS STRING) AS p_february,
       CAST(CAST(o_orderdate AS DATE) AS STRING)||' '||CAST(o_orderkey % 24 AS STRING) AS p_hour_only,
       REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', CHR(92)) AS p_backslash
FROM {orders}
"""

_PROBES = {
    "numbers": (NUMBER_PROBES_SQL, ("lineitem",)),
    "dates": (DATE_PROBES_SQL, ("orders",)),
}
_TABLES.update(_PROBES)


def probes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Probe texts ``numbers`` (from lineitem) or ``dates`` (from orders)."""
    return bronze(spark, sf_dir, name)


# A run ledger derived from ``events``: each event is one file-history
# record (user_id names the file, event_id % 5 its content hash, ts its load
# time); errors are failed loads.
LEDGER_SQL = """
SELECT 'events' AS pipeline_name,
       'file_'||CAST(user_id AS STRING)||'.csv' AS source_file,
       'h'||CAST(event_id % 5 AS STRING) AS file_hash,
       CAST(user_id % 7 * 1000 AS BIGINT) AS file_size_bytes,
       ts AS file_modified_at,
       ts AS loaded_at,
       'run-'||CAST(event_id AS STRING) AS run_id,
       CAST(event_id % 100 AS BIGINT) AS row_count,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(NULL AS STRING) AS error_message,
       event_type, event_id, user_id
FROM {events}
"""
_TABLES["ledger"] = (LEDGER_SQL, ("events",))
