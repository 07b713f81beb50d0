"""Hand-computed golden rows for the mart metrics (FIXTURES.md section 7)."""

import datetime as dt
from decimal import Decimal as D

import pytest

from millrace.operators import marts, silver
from millrace.plans.fixtures import ERP_SOURCE_COLUMNS, WORKFLOW_SOURCE_COLUMNS

LOADED = dt.datetime(2024, 3, 1, 8, 0)


def _bronze(spark, columns, rows):
    data = []
    for values in rows:
        rec = {c: None for c in columns}
        rec.update(values)
        data.append(tuple(rec[c] for c in columns) + ("f.csv", LOADED, "run-1"))
    schema = ", ".join(f"`{c}` string" for c in columns) + \
        ", _source_file string, _loaded_at timestamp_ntz, _run_id string"
    return spark.createDataFrame(data, schema)


ERP = [  # invoice, line, invoice amount, paid, due, payment date
    ("A", "100.00", "100.00", "100.00", "2024-01-31", "2024-01-31"),
    ("B", "90.00", "100.00", "100.00", "2024-01-31", "2024-02-02"),
    ("C", "100.00", "100.00", None, "2024-01-31", None),
    ("D", "100.00", "300.00", "100.00", "2024-03-01", None),
    ("E", "100.00", "0.00", "5.00", None, "2024-01-02"),
    ("F", None, None, None, "2024-02-29", None),
]


@pytest.fixture(scope="module")
def erp_silver(spark):
    rows = [{"SUPPLIER_ID": "S1", "INVOICE_NUMBER": inv, "INVOICE_ID": f"I-{inv}",
             "LINE_AMOUNT_DOC": line, "INVOICE_AMOUNT_DOC": amt, "AMOUNT_PAID": paid,
             "DUE_DATE_RAW": due, "PAYMENT_DATE": pay, "INVOICE_DATE": "2024-01-01"}
            for inv, line, amt, paid, due, pay in ERP]
    return silver.silver_erp(_bronze(spark, ERP_SOURCE_COLUMNS, rows))


def test_erp_golden(erp_silver):
    got = {r.invoice_number: r for r in marts.mart_erp(erp_silver, "2024-03-01").collect()}
    expected = {
        # variance, outstanding, paid %, days to pay, overdue, timing, paid
        "A": (D("0.00"), D("0.00"), 100.0, 30, 0, "ON_TIME", True),
        "B": (D("10.00"), D("0.00"), 100.0, 32, 2, "LATE", True),
        "C": (D("0.00"), D("100.00"), 0.0, None, 30, "OVERDUE", False),
        "D": (D("200.00"), D("200.00"), 33.33, None, 0, "OPEN", False),
        "E": (D("-100.00"), D("-5.00"), None, 1, None, "UNKNOWN", True),
        "F": (None, None, None, None, 1, "OVERDUE", False),
    }
    assert set(got) == set(expected)
    for inv, exp in expected.items():
        r = got[inv]
        assert (r.line_amount_variance_doc, r.outstanding_amount_doc, r.paid_percent,
                r.days_to_pay, r.overdue_days, r.payment_timing, r.is_paid) == exp, inv
        assert r.source_row_count == 1


WORKFLOW = [  # invoice, timestamp, sequence, stage, status, exception
    ("A", "2024-01-01 00:00:00", "1", "Recv", "Open", None),
    ("A", "2024-01-01 12:00:00", "2", "Match", "Open", "E1"),
    ("A", "2024-01-02 00:00:00", "3", "Appr", "approved", None),
    ("B", "2024-01-01 00:00:00", "1", "Recv", "Open", None),
    ("C", "2024-01-01 00:00:00", "9", "Recv", "Open", None),
    ("C", "2024-01-01 00:00:00", "10", "Recv", "Paid", None),
    ("Z", "2024-01-01 00:00:00", "1", "Recv", "Open", None),
]


def test_workflow_golden(spark, erp_silver):
    rows = [{"WORKFLOW_EVENT_ID": f"{inv}{i}", "WORKFLOW_ID": f"W{inv}", "SUPPLIER_ID": "S1",
             "INVOICE_NUMBER": inv, "EVENT_TIMESTAMP": ts, "EVENT_SEQUENCE": seq,
             "WORKFLOW_STAGE": stage, "CURRENT_STATUS": status, "EXCEPTION_REASON": exc}
            for i, (inv, ts, seq, stage, status, exc) in enumerate(WORKFLOW)]
    wf = silver.silver_workflow(_bronze(spark, WORKFLOW_SOURCE_COLUMNS, rows))
    got = {r.invoice_number: r for r in
           marts.mart_workflow(wf, marts.dim_invoice(erp_silver)).collect()}
    assert set(got) == {"A", "B", "C"}  # Z has no invoice: inner join drops it
    expected = {
        "A": (3, 3, 1, 33.33, 24.0, 12.0, True, True, "approved"),
        "B": (1, 1, 0, 0.0, 0.0, 0.0, False, False, "Open"),
        # sequence is text: '9' > '10', so the latest status is Open
        "C": (2, 1, 0, 0.0, 0.0, 0.0, False, False, "Open"),
    }
    for inv, exp in expected.items():
        r = got[inv]
        assert (r.workflow_event_count, r.workflow_stage_count, r.exception_event_count,
                r.exception_rate_percent, r.workflow_duration_hours, r.average_event_gap_hours,
                r.has_exception, r.is_workflow_complete, r.current_workflow_status) == exp, inv


def test_round2_matches_reference_rounding(spark):
    from millrace.functions import round2
    vals = [1.005, 2.675, 33.333333, -1.005, 0.125, 1e-9]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(round2("x")).collect()]
    import duckdb
    con = duckdb.connect()
    exp = [con.execute("select round(?::double, 2)", [v]).fetchone()[0] for v in vals]
    assert got == exp
