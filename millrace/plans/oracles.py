"""DuckDB texts that the registered queries are checked against.

Written from the metric definitions (SURVEY §2), apart from the Spark plans
and from the reference's models: own column lists, one grouped pass per invoice
straight over the typed rows, the latest event as an ``arg_max``, event ranks
as positions in an ordered list, date arithmetic that lets NULL spread instead
of guarding each case.  ``current_date`` is the fixtures' day.
"""

from __future__ import annotations

from millrace.plans.fixtures import FIXTURE_AS_OF, bronze_sql

TODAY = f"DATE '{FIXTURE_AS_OF}'"

# The Silver columns by type, as SURVEY §2.10 lists them.
ERP_BY_TYPE = {
    "VARCHAR": "erp_record_id document_id invoice_id invoice_number line_number distribution_number invoice_header_flag "
               "supplier_id supplier_name critical_supplier_flag region country_code company_code business_unit cost_center "
               "gl_account category quantity currency po_number po_non_po match_type invoice_type payment_status "
               "source_system late_arrival_flag dq_scenario",
    "DECIMAL(18,2)": "unit_price line_amount_doc line_amount_usd invoice_amount_doc invoice_amount_usd amount_paid amount_remaining",
    "DECIMAL(18,3)": "fx_rate",
    "INTEGER": "payment_term_days",
    "DATE": "invoice_date receipt_date creation_date posting_date due_date_raw payment_date",
    "TIMESTAMP": "last_updated_timestamp",
}
WORKFLOW_BY_TYPE = {
    "VARCHAR": "workflow_event_id workflow_id event_sequence erp_record_id document_id invoice_id invoice_number supplier_id "
               "po_number company_code workflow_stage previous_status current_status processor_id exception_reason",
    "DECIMAL(18,2)": "invoice_amount_usd",
    "TIMESTAMP": "previous_event_timestamp event_timestamp stage_duration_hours",
}


def _typed(by_type: dict[str, str], source: str) -> str:
    """Blank cells are NULL; a cell that is no value of its type is NULL; rows
    without supplier or invoice number are dropped."""
    cells = []
    for kind, names in by_type.items():
        for n in names.split():
            text = f"nullif(trim({n}), '')"
            cells.append(f"{text} AS {n}" if kind == "VARCHAR" else f"TRY_CAST({text} AS {kind}) AS {n}")
    return (f"SELECT {', '.join(cells)}, _source_file, _loaded_at, _run_id FROM {source} "
            "WHERE length(trim(coalesce(supplier_id, ''))) > 0 AND length(trim(coalesce(invoice_number, ''))) > 0")


def with_bronze(name: str, body: str, extra_ctes: str = "") -> str:
    """``WITH bz AS (<derived bronze>) [, more] <body>``."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH bz AS ({bronze_sql(name)}){more}\n{body}"


SILVER_ERP = _typed(ERP_BY_TYPE, "bz")
SILVER_WORKFLOW = _typed(WORKFLOW_BY_TYPE, "bz")


def silver_customer(source: str) -> str:
    """Of each valid customer id, the row loaded last (run ids break ties)."""
    return f"""
SELECT id AS customer_id, pick.customer_name, pick.city, pick.modified_date, pick._source_file, pick._loaded_at, pick._run_id
FROM (SELECT TRY_CAST(customer_id AS BIGINT) AS id,
             arg_max({{'customer_name': trim(customer_name), 'city': trim(city), 'modified_date': TRY_CAST(modified_date AS DATE),
                       '_source_file': _source_file, '_loaded_at': _loaded_at, '_run_id': _run_id}},
                     {{'a': _loaded_at, 'b': _run_id}}) AS pick
      FROM {source} GROUP BY ALL HAVING id IS NOT NULL)"""


SILVER_CUSTOMER = silver_customer("bz")

PAIR_KEY = "md5(supplier_id || '|' || invoice_number)"

# One pass per invoice: first dates, last values, sums and the number of lines.
INVOICES = f"""
inv AS (
  SELECT {PAIR_KEY} AS invoice_key, supplier_id, invoice_number,
         count(*) AS source_row_count,
         sum(line_amount_doc)::DECIMAL(38,2) AS line_amount_doc, sum(line_amount_usd)::DECIMAL(38,2) AS line_amount_usd,
         max(invoice_amount_doc) AS invoice_amount_doc, max(amount_paid) AS amount_paid,
         {', '.join(f'min({c}) AS {c}' for c in ('invoice_date', 'creation_date', 'receipt_date', 'posting_date'))},
         {', '.join(f'max({c}) AS {c}' for c in ('payment_date', 'due_date_raw', 'invoice_id', 'payment_status', 'currency', '_loaded_at', '_run_id'))}
  FROM lines GROUP BY supplier_id, invoice_number)"""

DIM_COLUMNS = ("invoice_key, supplier_id, invoice_id, invoice_number, invoice_date, creation_date, receipt_date, posting_date, "
               "payment_date, due_date_raw, payment_status, currency, _loaded_at, _run_id")
TOTAL_COLUMNS = "invoice_key, line_amount_doc, line_amount_usd, invoice_amount_doc, amount_paid, source_row_count"

# Metrics of one invoice; NULL spreads through differences.
INVOICE_METRICS = f"""
  (invoice_amount_doc - line_amount_doc)::DECIMAL(38,2) AS line_amount_variance_doc,
  (invoice_amount_doc - ifnull(amount_paid, 0))::DECIMAL(18,2) AS outstanding_amount_doc,
  round(ifnull(amount_paid, 0) / nullif(invoice_amount_doc, 0) * 100, 2) AS paid_percent,
  payment_date - invoice_date AS days_to_pay,
  posting_date - invoice_date AS days_to_post,
  if(due_date_raw IS NULL, NULL, greatest(ifnull(payment_date, {TODAY}) - due_date_raw, 0)) AS overdue_days,
  if(due_date_raw IS NULL, 'UNKNOWN',
     ['OPEN', 'OVERDUE', 'ON_TIME', 'LATE'][1 + if(payment_date IS NULL, 0, 2) + if(ifnull(payment_date, {TODAY}) > due_date_raw, 1, 0)])
    AS payment_timing,
  payment_date IS NOT NULL AS is_paid"""

ERP_CTES = f"lines AS ({SILVER_ERP}),{INVOICES},\ninvm AS (SELECT *,{INVOICE_METRICS}\n  FROM inv)"


def with_erp(body: str, extra: str = "") -> str:
    """Typed ERP lines (``lines``), invoices (``inv``) and their metrics (``invm``)."""
    return with_bronze("erp", body, ERP_CTES + (f",\n{extra}" if extra else ""))


MART_ERP = with_erp(f"SELECT {DIM_COLUMNS}, {TOTAL_COLUMNS.split(', ', 1)[1]}, line_amount_variance_doc, outstanding_amount_doc, "
                    "paid_percent, days_to_pay, days_to_post, overdue_days, payment_timing, is_paid FROM invm")

FACT_INVOICE = f"""
SELECT md5(supplier_id || '|' || invoice_number || '|' || ifnull(invoice_id, '')) AS invoice_row_key, {PAIR_KEY} AS invoice_key,
       supplier_id, invoice_id, invoice_number, line_amount_doc, line_amount_usd, invoice_amount_doc, amount_paid,
       _source_file, _loaded_at, _run_id
FROM lines"""

FACT_WORKFLOW = f"""
SELECT md5(supplier_id || '|' || invoice_number || '|' || workflow_event_id) AS workflow_event_key, {PAIR_KEY} AS invoice_key,
       supplier_id, invoice_number, workflow_event_id, workflow_id, event_sequence, workflow_stage, previous_status, current_status,
       previous_event_timestamp, event_timestamp, processor_id, exception_reason, invoice_amount_usd, _source_file, _loaded_at, _run_id
FROM acts"""

# One pass per invoice over its events; the event ids make the order total.
FLOWS = f"""
flow AS (
  SELECT {PAIR_KEY} AS invoice_key, supplier_id, invoice_number, count(*) AS workflow_event_count,
         max(invoice_amount_usd) AS invoice_amount_usd,
         min(event_timestamp) AS first_workflow_event_timestamp, max(event_timestamp) AS last_workflow_event_timestamp,
         len(list_distinct(list(workflow_stage))) AS workflow_stage_count, count(exception_reason) AS exception_event_count,
         arg_max({{'event': workflow_event_id, 'flow': workflow_id, 'stage': workflow_stage, 'status': current_status}},
                 {{'t': event_timestamp, 's': event_sequence, 'e': workflow_event_id}}) AS final
  FROM acts GROUP BY supplier_id, invoice_number),
flowm AS (
  SELECT *, date_diff('microsecond', first_workflow_event_timestamp, last_workflow_event_timestamp) / 1000000 / 3600 AS hours,
         round(exception_event_count / workflow_event_count * 100, 2) AS exception_rate_percent,
         round(hours, 2) AS workflow_duration_hours,
         ifnull(round(hours / nullif(workflow_event_count - 1, 0), 2), 0) AS average_event_gap_hours,
         exception_event_count > 0 AS has_exception,
         list_contains(['APPROVED', 'COMPLETED', 'CLOSED', 'PAID'], upper(ifnull(final.status, ''))) AS is_workflow_complete
  FROM flow)"""

WORKFLOW_TOTAL_COLUMNS = ("invoice_key, invoice_amount_usd, first_workflow_event_timestamp, last_workflow_event_timestamp, "
                          "workflow_event_count, workflow_stage_count, exception_event_count")

# Rank of each event: its position in the invoice's ordered list of events.
EVENT_RANKS = f"""
SELECT workflow_event_key, invoice_key, event_timestamp, event_sequence, list_position(ids, workflow_event_id)::BIGINT AS event_rank
FROM ({FACT_WORKFLOW}) JOIN (
  SELECT supplier_id, invoice_number,
         list(workflow_event_id ORDER BY event_timestamp DESC NULLS LAST, event_sequence DESC NULLS LAST, workflow_event_id DESC) AS ids
  FROM acts GROUP BY ALL) USING (supplier_id, invoice_number)"""

MART_WORKFLOW_BODY = """
SELECT invoice_key, inv.supplier_id, inv.invoice_id, inv.invoice_number, invoice_date, creation_date, receipt_date, posting_date,
       payment_date, due_date_raw, final.flow AS current_workflow_id, final.stage AS current_workflow_stage,
       final.status AS current_workflow_status, flowm.invoice_amount_usd, first_workflow_event_timestamp,
       last_workflow_event_timestamp, workflow_event_count, workflow_stage_count, exception_event_count, exception_rate_percent,
       workflow_duration_hours, average_event_gap_hours, has_exception, is_workflow_complete, inv._loaded_at, inv._run_id
FROM flowm JOIN inv USING (invoice_key)"""


def _workflow_ctes() -> str:
    return f"bw AS ({bronze_sql('workflow')}),\nacts AS ({_typed(WORKFLOW_BY_TYPE, 'bw')}),{FLOWS}"


def with_workflow(body: str, extra: str = "") -> str:
    """Typed workflow events (``acts``), invoices' flows (``flow``) and their metrics (``flowm``)."""
    return f"WITH {_workflow_ctes()}" + (f",\n{extra}" if extra else "") + f"\n{body}"


def with_erp_and_workflow(body: str, extra: str = "") -> str:
    return with_erp(body, _workflow_ctes() + (f",\n{extra}" if extra else ""))


MART_WORKFLOW = with_erp_and_workflow(MART_WORKFLOW_BODY)
