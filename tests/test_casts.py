"""Lenient casts against the reference database's TRY_CAST (DuckDB)."""

import duckdb
import pytest

from millrace.functions import to_bigint, to_date, to_decimal, to_int, to_timestamp_ntz

NUMBERS = ["12", "12.5", "-2.5", "1e3", "1_000", " 12 ", "", "1,000", "0x10", "abc",
           "9223372036854775807", "9223372036854775808", "1.5e1", "+7", "007", "12.49999",
           ".5", "1e-2", "  -3.5 ", "1__0", "_1", "1_", "NaN", "inf", "2147483648",
           "12.49999999995", "-12.49999999995", "-12.5", "0.4999999999999999999999", "+.5", "-.5", "5.", "0x7fffffffffffffff",
           "0xffffffffffffffff", "\u0661", "\u0661.5", "9223372036854775807.5", "9223372036854775806.5"]
DATES = ["2024-01-05", "2024/01/05", "2024 01 05", "2024", "2024-01", "2024-01-05 BC",
         "2024-1-5", "2024-01-05 10:00:00", "2024-02-30", "01/05/2024", "20240105",
         "2024-01-05T10:00", "  2024-01-05", "2024-01-05  ", "2024-13-01", "2024-01-05 x",
         "2024-01-05 10", "2024-01-05 25:00:00", "2024-01/05", "2024-01-05 10:00:00Z",
         "2024-01-05 10:00:00 UTC", "2024-01-05 10:00:00.1234567", "2024-01-05 24:00:00",
         "2024-01-05 24:00:01", "2024-01-05+02", "2024-01-05Z", "2024-12-31 24:00", "12.5",
         "2024\\01\\05", "2024\\01-05", "2024\\1\\5 10:00"]


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


def test_numbers_match_reference(spark, duck):
    df = spark.createDataFrame([(v,) for v in NUMBERS], "x string").select(
        "x", to_bigint("x").alias("b"), to_int("x").alias("i"),
        to_decimal("x", 18, 2).alias("d2"), to_decimal("x", 18, 3).alias("d3"))
    for r in df.collect():
        exp = duck.execute("select try_cast(? as bigint), try_cast(? as integer), "
                           "try_cast(? as decimal(18,2)), try_cast(? as decimal(18,3))",
                           [r.x] * 4).fetchone()
        assert (r.b, r.i, r.d2, r.d3) == tuple(exp), r.x


def test_dates_and_timestamps_match_reference(spark, duck):
    df = spark.createDataFrame([(v,) for v in DATES], "x string").select(
        "x", to_date("x").alias("d"), to_timestamp_ntz("x").alias("t"))
    for r in df.collect():
        exp = duck.execute("select try_cast(? as date), try_cast(? as timestamp)", [r.x] * 2).fetchone()
        assert (r.d, r.t) == tuple(exp), r.x


def test_short_ways_of_casts_match_reference(spark, duck):
    """Texts that look like the usual spellings; amounts of a derived row are made once."""
    texts = ["2024/01/05 10:30:00", "2024/01/05T10:30:00", "2024-01-05  1:00:00", "2024-01-05 24:00:00", "2024/13/05 10:30:00",
             "2024-01-05 10:30:6\t", "2024/1/05", "2024-01-1T", "2024-01-1\t", "+024-01-05", "2024/01-05", "2024//1/05", "2024/01/0a"]
    df = spark.createDataFrame([(v,) for v in texts], "x string").select("x", to_date("x").alias("d"), to_timestamp_ntz("x").alias("t"))
    for r in df.collect():
        assert (r.d, r.t) == tuple(duck.execute("select try_cast(? as date), try_cast(? as timestamp)", [r.x] * 2).fetchone()), r.x
    from millrace.plans.fixtures import bronze
    plan = bronze(spark, "/root/testdata/sf0.001", "erp")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(o_totalprice") == 1 and plan.count("cast(l_extendedprice") == 1


def test_usual_slash_dates_need_no_pattern(spark):
    """The separators decide before any pattern is matched."""
    plan = spark.range(1).selectExpr("cast(id as string) x").select(to_date("x").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("try_cast(replace(") < plan.index("RLIKE")
