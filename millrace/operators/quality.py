"""Data-quality checks and enforced contracts (DQ-1..5).

Checks return small DataFrames of ``(model, column_name, test, failures)``
where ``failures`` counts what the reference's test query would return:
NULL rows for ``not_null``, duplicated values for ``unique``, offending
distinct values for ``accepted_values``.  All not-null checks of a table run
in one aggregate; ``unique`` is one grouped count; nothing is collected except
the final counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.marts import PAYMENT_TIMINGS

RESULT_COLUMNS = ["model", "column_name", "test", "failures"]


class DataQualityError(RuntimeError):
    """Raised when a data test or a contract fails."""


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """One aggregate over ``df`` counting NULLs of every listed column."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"c{i}")
                      for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(f"c{i}").cast("bigint").alias("failures"))
                               for i, c in enumerate(columns)]))
    return counts.select(rows.alias("r")).select(
        F.lit(model).alias("model"), "r.column_name", F.lit("not_null").alias("test"),
        "r.failures")


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).count()
           .where(F.col("count") > 1))
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), F.col("failures").cast("bigint"))


def accepted_values(df: DataFrame, model: str, column: str, values: Iterable[str]) -> DataFrame:
    """Number of distinct non-NULL values outside ``values``."""
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return bad.agg(F.count_distinct(column).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("accepted_values").alias("test"), F.col("failures").cast("bigint"))


# The declared data tests, per model.
TESTS = {
    "stg_customer": {"not_null": ["customer_id"], "unique": ["customer_id"]},
    "customer": {"not_null": ["customer_id"], "unique": ["customer_id"]},
    "erp": {"not_null": ["invoice_key", "supplier_id", "invoice_number"],
            "unique": ["invoice_key"],
            "accepted_values": {"payment_timing": PAYMENT_TIMINGS}},
    "workflow": {"not_null": ["invoice_key", "supplier_id", "invoice_number"],
                 "unique": ["invoice_key"]},
}


def run_tests(df: DataFrame, model: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """All declared tests of ``model`` (optionally only some kinds) as one frame."""
    spec = TESTS.get(model, {})
    parts = []
    if spec.get("not_null") and (not kinds or "not_null" in kinds):
        parts.append(not_null(df, model, spec["not_null"]))
    if not kinds or "unique" in kinds:
        parts += [unique(df, model, c) for c in spec.get("unique", [])]
    if not kinds or "accepted_values" in kinds:
        parts += [accepted_values(df, model, c, v)
                  for c, v in spec.get("accepted_values", {}).items()]
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "model string, column_name string, test string, failures bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_passing(results: DataFrame) -> list[tuple]:
    """Collect the (few) check rows; raise if any check failed (DQ-5)."""
    rows = [tuple(r) for r in results.collect()]
    failed = [r for r in rows if r[3]]
    if failed:
        detail = "; ".join(f"{m}.{c} {t}: {n}" for m, c, t, n in failed)
        raise DataQualityError(f"Data tests failed: {detail}")
    return rows


# ---------------------------------------------------------------- contracts

def _type(name: str) -> T.DataType:
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return {"varchar": T.StringType(), "date": T.DateType(), "bigint": T.LongType(),
            "double": T.DoubleType(), "boolean": T.BooleanType(),
            "timestamp": T.TimestampNTZType()}[name]


def _contract(pairs: Sequence[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _type(t), True) for n, t in pairs])


# Enforced contracts (column, type) of the two Power BI marts.
# The database's HUGEINT (an integer SUM) is a bigint here.
ERP_CONTRACT = _contract([
    ("invoice_key", "varchar"), ("supplier_id", "varchar"), ("invoice_id", "varchar"),
    ("invoice_number", "varchar"), ("invoice_date", "date"), ("creation_date", "date"),
    ("receipt_date", "date"), ("posting_date", "date"), ("payment_date", "date"),
    ("due_date_raw", "date"), ("payment_status", "varchar"), ("currency", "varchar"),
    ("line_amount_doc", "decimal(38,2)"), ("line_amount_usd", "decimal(38,2)"),
    ("invoice_amount_doc", "decimal(18,2)"), ("amount_paid", "decimal(18,2)"),
    ("source_row_count", "bigint"), ("_loaded_at", "timestamp"), ("_run_id", "varchar"),
    ("line_amount_variance_doc", "decimal(38,2)"), ("outstanding_amount_doc", "decimal(18,2)"),
    ("paid_percent", "double"), ("days_to_pay", "bigint"), ("days_to_post", "bigint"),
    ("overdue_days", "bigint"), ("payment_timing", "varchar"), ("is_paid", "boolean"),
])
WORKFLOW_CONTRACT = _contract([
    ("invoice_key", "varchar"), ("supplier_id", "varchar"), ("invoice_id", "varchar"),
    ("invoice_number", "varchar"), ("invoice_date", "date"), ("creation_date", "date"),
    ("receipt_date", "date"), ("posting_date", "date"), ("payment_date", "date"),
    ("due_date_raw", "date"), ("current_workflow_id", "varchar"),
    ("current_workflow_stage", "varchar"), ("current_workflow_status", "varchar"),
    ("invoice_amount_usd", "decimal(18,2)"), ("first_workflow_event_timestamp", "timestamp"),
    ("last_workflow_event_timestamp", "timestamp"), ("workflow_event_count", "bigint"),
    ("workflow_stage_count", "bigint"), ("exception_event_count", "bigint"),
    ("exception_rate_percent", "double"), ("workflow_duration_hours", "double"),
    ("average_event_gap_hours", "double"), ("has_exception", "boolean"),
    ("is_workflow_complete", "boolean"), ("_loaded_at", "timestamp"), ("_run_id", "varchar"),
])
CONTRACTS = {"erp": ERP_CONTRACT, "workflow": WORKFLOW_CONTRACT}


def contract_differences(schema: T.StructType, contract: T.StructType) -> list[tuple]:
    """(column, expected type, actual type) for every mismatch, in contract
    order, then columns the contract does not list.  Names compare case-
    insensitively; nullability is not part of a contract."""
    actual = {f.name.lower(): f.dataType for f in schema.fields}
    expected = {f.name.lower(): f.dataType for f in contract.fields}
    diffs = []
    for f in contract.fields:
        got = actual.get(f.name.lower())
        if got != f.dataType:
            diffs.append((f.name, f.dataType.simpleString(),
                          got.simpleString() if got is not None else None))
    for f in schema.fields:
        if f.name.lower() not in expected:
            diffs.append((f.name, None, f.dataType.simpleString()))
    return diffs


def enforce_contract(df: DataFrame, model: str) -> DataFrame:
    """Raise before the model is written if its schema breaks the contract."""
    contract = CONTRACTS.get(model)
    if contract is None:
        return df
    diffs = contract_differences(df.schema, contract)
    if diffs:
        detail = ", ".join(f"{c} (expected {e}, got {a})" for c, e, a in diffs)
        raise DataQualityError(f"Contract of {model} violated: {detail}")
    return df
