"""Spark queries vs the independent DuckDB SQL, on the given tables.

A representative subset runs by default; ``EMPORIA_FULL_ORACLE=1`` runs
every key (``python tests/oracle_check.py`` does the same from the shell).
"""

import os

import pytest

from conftest import SF_ORACLE
from oracle_check import compare, duck

DEFAULT_KEYS = [
    "src_orders", "bronze_order_items", "silver_orders", "silver_order_items", "silver_payments",
    "silver_upsert", "dq_invalid_date_sequence", "dq_free_shipping", "dim_customers", "dim_products",
    "dim_date", "fact_sales", "fact_orders", "surrogate_keys", "sales_summary", "product_performance",
    "customer_revenue", "delivery_quality", "dash_payment_split", "dash_dq_by_month", "ctl_rows_affected",
]


def _keys():
    import __spark_entry__ as E

    if os.environ.get("EMPORIA_FULL_ORACLE"):
        return sorted(E.oracle_sql())
    return DEFAULT_KEYS


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", _keys())
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as E

    line = compare(spark, con, SF_ORACLE, key, E.queries()[key], E.oracle_sql()[key])
    assert line.startswith("OK"), line


def test_every_sql_key_is_registered():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "late_delivery_rate_pct" in df.columns
