"""Entries by module, layer and command line; views by name; digests, profile, rejects and pruned reads."""

import datetime as dt
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from emporia.__main__ import main
from emporia.operators.digest import digest, key_is_dense
from emporia.operators.profile import ERROR, profile
from emporia.plans import catalog as C
from emporia.plans import dashboards as D
from emporia.plans.pipeline import Pipeline
from emporia.schemas import SOURCE_COLUMNS
from emporia.session import RELEASE_SHUFFLES
from emporia.sources import derived_feed as feed
from emporia.sources.csv_feed import read_feed, read_feed_checked, write_feed
from emporia.sources.store import TableStore


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("entry"))
    for n in feed.FEED_BUILDERS:
        write_feed(feed.source_feed(spark, SF_SMALL, n, 1), f"{base}/feeds/{n}", n)
    return base


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_command_line_module_layer_and_names(spark, feeds, capsys):
    wh = f"{feeds}/wh"
    assert main([f"{feeds}/feeds", wh, "--layer", "source"]) == 0
    assert main([f"{feeds}/feeds", wh, "--layer", "bronze"]) == 0
    assert main([f"{feeds}/feeds", wh, "--layer", "silver", "--module", "orders"]) == 0
    p = Pipeline(spark, wh, lambda n: read_feed(spark, f"{feeds}/feeds/{n}", n))
    marks = p.control.current_watermarks()
    # The module published its own watermark, and no other silver table's.
    assert marks["silver_orders"] is not None and "silver_customers" not in marks
    log = {r.pipeline_name: r for r in p.control.run_log().collect()}
    assert log["silver.load_orders"].status == "SUCCESS" and log["silver.load_orders"].rows_processed == p.silver("orders").count()
    assert "gold_sales_summary" not in p.create_views()
    assert main([f"{feeds}/feeds", wh, "--sql", "SELECT sum(total_orders) AS n FROM gold_sales_summary"]) == 0
    assert "|n " in capsys.readouterr().out
    names = p.create_views()
    assert {"gold_sales_summary", "gold_customer_revenue", "silver_orders_clean", "bronze_orders", "control_pipeline_log"} <= set(names)
    assert spark.sql("SELECT * FROM gold_sales_summary").count() > 0
    assert spark.table("control_pipeline_watermark").where("last_load_time IS NOT NULL").count() == 14
    assert p.run_module("silver", "orders") == 0  # nothing new since
    with pytest.raises(ValueError):
        p.run_module("silver", "nothing")
    with pytest.raises(SystemExit):
        main([f"{feeds}/feeds", wh, "--module", "orders"])


def test_calendar_follows_the_orders(spark, feeds):
    p = Pipeline(spark, f"{feeds}/wh-cal", lambda n: read_feed(spark, f"{feeds}/feeds/{n}", n))
    p.run()
    span = p.gold("dim_date").agg(F.min("full_date"), F.max("full_date")).first()
    years = p.silver("orders").agg(F.year(F.min("order_purchase_timestamp")), F.year(F.max("order_purchase_timestamp"))).first()
    assert (span[0], span[1]) == (dt.date(years[0], 1, 1), dt.date(years[1], 12, 31))
    assert p.gold("fact_orders").where("date_key IS NULL").count() == 0
    late = spark.createDataFrame([("late-1", "1", "shipped", "05-06-2011 10:00", None, None, None, None)], ", ".join(f"{c} string" for c in SOURCE_COLUMNS["orders"]))
    p.feed_reader = lambda n: late if n == "orders" else read_feed(spark, f"{feeds}/feeds/{n}", n)
    p.run()
    assert p.gold("dim_date").agg(F.max("full_date")).first()[0] == dt.date(2011, 12, 31)
    assert p.gold("fact_orders").where("order_id = 'late-1'").first().date_key == 20110605


def test_digest_ignores_order_and_sees_every_change(spark):
    rows = [(1, "a", None), (2, None, 1.5), (2, None, 1.5)]
    schema = "i int, s string, d double"
    one = digest(spark.createDataFrame(rows, schema), ["i", "s", "d"]).first()
    assert one == digest(spark.createDataFrame(rows[::-1], schema).repartition(3), ["i", "s", "d"]).first()
    assert one.row_count == 3 and one.digest != digest(spark.createDataFrame(rows[:2], schema), ["i", "s", "d"]).first().digest
    assert digest(spark.createDataFrame([(1, "b", None), *rows[1:]], schema), ["i", "s", "d"]).first().digest != one.digest
    empty = digest(spark.createDataFrame([], schema), ["i"]).first()
    assert (empty.row_count, empty.digest) == (0, 0)
    dense = lambda ks: key_is_dense(spark.createDataFrame([(k,) for k in ks], "k long"), "k").first()[0]
    assert dense([2, 1, 3]) and dense([]) and not dense([1, 3]) and not dense([1, 1, 2]) and not dense([2, 3])


def test_top_products_keep_ties_without_a_global_rank(spark):
    sales = spark.createDataFrame([(i, v) for i, v in enumerate([50, 40, 40, 30, 30, 30, 10])] + [(None, 99), (77, 98)], "product_key long, v int").select(
        "product_key", F.col("v").cast("decimal(10,2)").alias("total_item_value"))
    dim = spark.createDataFrame([(i, f"p{i}", "c") for i in range(7)], "product_key long, product_id string, product_category_name string")
    got = D.top_products(sales, dim, n=4)
    assert sorted((r.revenue_rank, r.product_id) for r in got.collect()) == [(1, "p0"), (2, "p1"), (2, "p2"), (4, "p3"), (4, "p4"), (4, "p5")]
    assert D.top_products(sales, dim, n=20).count() == 7 and D.top_products(sales.limit(0), dim).count() == 0
    plan = plan_of(C.registry()["dash_top_products"](spark, SF_SMALL))
    assert "RowDataSourceScan" not in plan and "Scan ExistingRDD" not in plan and "rank(" not in plan


def test_customer_report_joins_the_dimension_once(spark):
    plan = C.registry()["customer_revenue"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # Customers are read once: no look-up of a key per order before the aggregation.
    assert plan.count("c_custkey#") and len(re.findall(r"Relation \[[^\]]*c_custkey", plan)) == 1


def test_silver_increment_prunes_bronze_partitions(spark):
    for n in ("orders", "payments"):
        df = C.registry()[f"silver_increment_{n}"](spark, SF_SMALL)
        assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date#\d+ >= 2024-01-01", plan_of(df))


def test_profile_counts_and_sketch(spark):
    rows = [(str(i % 1000), "" if i % 10 == 0 else None if i % 10 == 1 else "x1" if i % 10 == 2 else str(i)) for i in range(20_000)]
    got = {r.column_name: r for r in profile(spark.createDataFrame(rows, "a string, b string"), ("a", "b"), {"b": "int"}).collect()}
    assert (got["a"].rows, got["a"].nulls, got["a"].blanks, got["a"].unparsable) == (20_000, 0, 0, 0)
    assert (got["b"].nulls, got["b"].blanks, got["b"].unparsable) == (2000, 2000, 2000)
    assert abs(got["a"].distinct_estimate / 1000 - 1) <= 4 * ERROR and abs(got["b"].distinct_estimate / 14_002 - 1) <= 4 * ERROR


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text(",".join(SOURCE_COLUMNS["customers"]) + "\n"
                                          '1,u,10,"São Paulo, ""SP""",sp\n2,u,,,\n3,u,10\n4,u,10,c,s,extra\n')
    rows, rejects = read_feed_checked(spark, str(tmp_path / "c"), "customers")
    assert [tuple(r) for r in rows.orderBy("customer_id").collect()] == [("1", "u", "10", 'São Paulo, "SP"', "sp"), ("2", "u", None, None, None)]
    assert sorted((r.reason, r.line) for r in rejects.collect()) == [("long", "4,u,10,c,s,extra"), ("short", "3,u,10")]
    assert rows.select("customer_id").count() == 2 and rejects.select("line").count() == 2
    with pytest.raises(Exception):
        read_feed(spark, str(tmp_path / "c"), "customers").collect()


def test_csv_keys_stage_their_feed_only(spark, monkeypatch):
    monkeypatch.setattr(C, "_STAGED", {})
    df = C.registry()["csv_products"](spark, SF_SMALL)
    assert len(C._STAGED) == 1 and all("products" in f and f.endswith(".gz") for f in df.inputFiles())


def test_steps_leave_no_shuffle_files(spark, feeds):
    def shuffles():
        names = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while names.hasNext():
            found.add(names.next().getName())
        return {f for f in found if f.startswith("shuffle_")}

    p = Pipeline(spark, f"{feeds}/wh-shuffles", lambda n: read_feed(spark, f"{feeds}/feeds/{n}", n))
    p.run_layer("source")
    p.run_layer("bronze")
    before, setting = shuffles(), spark.conf.get(RELEASE_SHUFFLES)
    assert p.run_layer("silver").total_rows > 0
    deadline = time.time() + 20  # files are deleted in the background
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(RELEASE_SHUFFLES) == setting


def test_loads_keep_two_versions_while_a_run_lasts(spark, feeds):
    p = Pipeline(spark, f"{feeds}/wh-versions", lambda n: read_feed(spark, f"{feeds}/feeds/{n}", n))
    for _ in range(3):  # no run ends here
        p.run_module("source", "customers")
    assert p.store.versions("source", "customers") == [2, 3]


def test_extracts_are_dropped_after_their_runs(spark):
    p, results, _ = C.pipeline_runs(spark, SF_ORACLE)
    assert len(results) == 3 and TableStore(spark, p.store.root.rsplit("/", 1)[0])._names(f"{p.store.root}/../feeds", "b") == []


def test_dense_keys_are_told_by_bits(spark):
    cases = [[None, 1], [1, 2, None], list(range(1, 70_001)), [*range(1, 70_000), 69_999], [0, 1, 2], [-1, 1, 2, 3], [*range(1, 32_768), 32_769], [1, 2, 2, 4]]
    for ks in cases:
        df = spark.createDataFrame([(k,) for k in ks], "k long")
        assert key_is_dense(df, "k").first()[0] == (ks == list(range(1, len(ks) + 1)))
    plan = plan_of(key_is_dense(spark.range(1, 9).toDF("k"), "k"))
    assert not re.search(r"hashpartitioning\(k#", plan)  # no key crosses a shuffle


def test_independent_jobs_run_at_once_and_keep_their_order():
    meet = threading.Barrier(3, timeout=30)  # broken if one job waited for another

    assert C._at_once([lambda i=i: (meet.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
    with pytest.raises(ZeroDivisionError):
        C._at_once([lambda: 1 / 0, lambda: 1])
