"""Property test: lenient casts agree with the reference database on
generated number-like and date-like strings.

Exponents stay single-digit: the reference database accepts exponent-form
numbers beyond a decimal type's precision (``'.8E17'`` as DECIMAL(18,2)),
which no decimal(18,2) value can hold; those are NULL here, like any other
overflow (documented in the README)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.functions import to_bigint, to_date, to_decimal, to_timestamp_ntz

NUMBERISH = st.from_regex(
    r"\A[ ]{0,2}[+-]?[0-9_]{0,7}(\.[0-9]{0,4})?([eE][+-]?[0-9])?[ ]{0,2}\Z", fullmatch=True)
DATEISH = st.from_regex(
    r"\A[0-9]{4}[-/ ][0-9]{1,2}[-/ ][0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,7})?)?)?\Z",
    fullmatch=True)
CON = duckdb.connect()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NUMBERISH, min_size=50, max_size=150))
def test_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x", to_bigint("x").alias("b"), to_decimal("x", 18, 2).alias("d"))
    for r in df.collect():
        exp = CON.execute("select try_cast(? as bigint), try_cast(? as decimal(18,2))", [r.x] * 2).fetchone()
        assert (r.b, r.d) == tuple(exp), repr(r.x)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DATEISH, min_size=50, max_size=150))
def test_dates(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x", to_date("x").alias("d"), to_timestamp_ntz("x").alias("t"))
    for r in df.collect():
        exp = CON.execute("select try_cast(? as date), try_cast(? as timestamp)", [r.x] * 2).fetchone()
        assert (r.d, r.t) == tuple(exp), repr(r.x)
