"""Driver contract: entry, queries and oracle SQL stay consistent."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck_connection



def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "invoice_key"


def test_every_pipeline_query_has_an_oracle():
    from millrace.plans import catalog
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert set(catalog.QUERIES) <= set(oracles)


@pytest.mark.parametrize("name", ["mart_erp", "mart_workflow", "silver_customer", "lenient_date",
                                  "dq_unique", "upsert_latest"])
def test_oracle_matches_at_smallest_scale(spark, name):
    sf = "/root/testdata/sf0.001"
    res = compare(spark, duck_connection(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert res["status"] == "ok", res
