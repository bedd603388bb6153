"""Both loads of every silver table, dimension and fact against the independent SQL."""

import pytest

from conftest import SF_SMALL
from emporia.schemas import FEEDS
from oracle_check import compare, duck

KEYS = (["silver_upsert", "dim_customers", "dim_products", "fact_sales_two_loads", "fact_orders_two_loads", "ctl_rows_affected_all"]
        + [f"silver_upsert_{n}" for n in FEEDS if n != "customers"] + [f"gold_incremental_filter_{n}" for n in FEEDS])


@pytest.mark.parametrize("key", KEYS)
def test_second_loads_match_sql(spark, key):
    import __spark_entry__ as E

    line = compare(spark, duck(SF_SMALL), SF_SMALL, key, E.queries()[key], E.oracle_sql()[key])
    assert line.startswith("OK"), line


def test_every_table_is_counted(spark):
    import __spark_entry__ as E

    rows = {r.table_name: r for r in E.queries()["ctl_rows_affected_all"](spark, SF_SMALL).collect()}
    assert len(rows) == 14 and all(r.rows_inserted + r.rows_updated == r.rows_out for r in rows.values())
    assert all(r.rows_out > 0 for n, r in rows.items() if n.startswith(("silver_", "gold_fact")))


def test_items_keep_their_frozen_columns(spark):
    """The second extract of the feed never changes these columns, so no key's values show it."""
    import datetime as dt

    from emporia.operators.merge import insert_all, merge
    from emporia.schemas import SILVER_SPECS

    s = SILVER_SPECS["order_items"]
    row = lambda mark, price: spark.sql(
        f"SELECT 'o' order_id, 1 order_item_id, 'p{mark}' product_id, 's{mark}' seller_id, TIMESTAMP_NTZ '2024-01-0{mark} 00:00:00' shipping_limit_date, "
        f"{price} price, 1 freight_value, {price + 1} total_item_value, 0 is_free_shipping")
    got = merge(insert_all(row(1, 5), list(s.columns), dt.datetime(2024, 1, 1)).drop("_action"), row(2, 7), list(s.keys), list(s.columns),
                list(s.update_columns), dt.datetime(2024, 1, 2)).first()
    assert (got.product_id, got.seller_id, got.shipping_limit_date.day, got.price, got.total_item_value) == ("p1", "s1", 1, 7, 8)
