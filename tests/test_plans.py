"""Physical-plan shape checks: the plans we want at scale, not only right answers."""

import re

from conftest import SF_SMALL
from emporia.plans import catalog as C
from emporia.plans.world import World


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_uses_group_limit_before_shuffle(spark):
    p = plan(C.registry()["silver_orders"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_bronze_incremental_is_anti_join(spark):
    p = plan(World(spark, SF_SMALL).bronze_two_loads("orders"))  # the stored form: tests/test_sinks.py
    assert "LeftAnti" in p


def test_calendar_is_broadcast(spark):
    p = plan(C.registry()["sales_summary"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_rank_has_no_unbounded_single_partition_window(spark):
    df = C.registry()["product_performance"](spark, SF_SMALL)
    lines = plan(df).split("\n")
    assert "rank(" not in "\n".join(lines).lower()
    # Every single-partition exchange sits on a per-bucket aggregate (at most B rows).
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[_bucket" in lines[i + 1], lines[i + 1]


def test_scans_are_pruned(spark):
    df = C.registry()["src_orders"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in p.split("ReadSchema")[1].split("\n")[0]


def scans(df) -> list[str]:
    """Tables read by the plan, one entry per scan."""
    return sorted(re.findall(r"FileScan parquet.*?/([a-z]+)\.parquet", plan(df)))


def test_reports_read_no_unused_table(spark):
    reg = C.registry()
    for key in ("delivery_quality", "dash_late_rate", "dash_dq_by_month", "dash_cancellations"):
        assert set(scans(reg[key](spark, SF_SMALL))) == {"orders"}, key
    for key in ("sales_summary", "dash_payment_split", "dash_free_shipping"):
        assert not {"customer", "part"} & set(scans(reg[key](spark, SF_SMALL))), key
    assert "customer" not in scans(reg["dash_category_revenue"](spark, SF_SMALL))


def test_second_loads_share_the_dedup_shuffles(spark):
    """All readers of a load's rows test the same keys under the dedup, so that one shuffle of it serves them all."""
    lines = [x for x in re.sub(r"#\d+L?", "", plan(C.registry()["fact_sales_two_loads"](spark, SF_SMALL))).split("\n") if "FileScan" not in x]
    items = [line[line.index("Filter ("):] for line in lines if "Filter (" in line and "l_orderkey" in line]
    payments = [line[line.index("Filter ("):] for line in lines if "Filter (" in line and "o_orderkey" in line and "o_custkey" not in line]
    for found in (items, payments):
        assert len(found) > 2 and len(set(found)) == 2, set(found)  # one for each load
