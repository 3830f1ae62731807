"""Every query of the medallion pipeline against its DuckDB oracle (small scale factor).

The training-data queries are tested in ``tests/llm``."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from ledgerflow.plans import registry

KEYS = sorted(registry.all_queries())


@pytest.fixture(scope="module")
def results(spark):
    from oracle.compare import compare

    return compare(spark, SF_SMALL, KEYS, verbose=False)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(results, key):
    r = results[key]
    assert r.get("ok"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category"]


def test_non_utc_session_still_matches(spark):
    from oracle.compare import compare

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compare(spark, SF_SMALL, ["clean_orders", "daily_sales", "product_performance"], verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(r.get("ok") for r in res.values()), res
