"""What a stored run moves and keeps: one shuffle a silver table, two states a table, no extract after its landing."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporia.operators import gold as G
from emporia.operators.key_index import KeyIndex
from emporia.operators.silver import clean_order_items, clean_orders
from emporia.plans.pipeline import Pipeline, append_new
from emporia.schemas import SOURCE_COLUMNS
from emporia.sources import derived_feed as feed
from emporia.sources.csv_feed import read_feed, write_feed
from emporia.sources.store import BUCKET, TableStore

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("size"))
    for n in feed.FEED_BUILDERS:
        write_feed(feed.source_feed(spark, SF_SMALL, n, 1), f"{base}/feeds/{n}", n, "gzip", "BEST_SPEED")
    return base


def pipeline(spark, feeds, name):
    return Pipeline(spark, f"{feeds}/{name}", lambda n: read_feed(spark, f"{feeds}/feeds/{n}", n))


def test_upserted_tables_are_written_where_their_rows_lie(spark, feeds, monkeypatch):
    p, gathered, plain = pipeline(spark, feeds, "wh-lie"), [], TableStore.gathered
    p.run_layer("source")
    p.run_layer("bronze")
    monkeypatch.setattr(TableStore, "gathered", staticmethod(lambda df, by: (gathered.append(by), plain(df, by))[1]))
    for _ in range(2):  # anew, then a merge
        assert p.run_module("silver", "customers", "snapshot") == 135
    changed = p.silver("customers").withColumn("customer_city", F.lit("elsewhere"))
    cols = [c for c in changed.columns if c not in ("created_at", "updated_at")]
    from emporia.operators.merge import insert_all, merge

    c = p._upsert("silver", "customers_clean", "customer_id", changed, T2.replace(year=2090), False, insert_all(changed, cols, T2),
                  lambda t, ch: merge(t, ch, ["customer_id"], cols, ["customer_city"], T2))
    assert c == {"inserted": 0, "updated": 135} and not [by for by in gathered if by == [BUCKET]]
    assert {r.customer_city for r in p.silver("customers").collect()} == {"elsewhere"} and p.silver("customers").count() == 135


def test_raw_keys_do_not_cross_the_dedup_shuffle(spark):
    cols = SOURCE_COLUMNS["orders"]
    row = dict.fromkeys(cols) | {"customer_id": "c", "order_status": "shipped", "order_purchase_timestamp": "01-02-2017 10:00"}
    rows = [tuple({**row, "order_id": k, **more}.values()) + (T1,) for k, more in (("7 ", {}), (" 7", {}), ("7", {"order_status": "delivered"}), ("8", {}))]
    df = spark.createDataFrame([tuple(dict(zip(row, r))[c] for c in cols) + (r[-1],) for r in rows],
                               ", ".join(f"{c} string" for c in cols) + ", ingestion_timestamp timestamp_ntz")
    got = clean_orders(df)
    assert sorted((r.order_id, r.order_status) for r in got.collect()) == [("7", "DELIVERED"), ("8", "SHIPPED")]
    assert not re.search(r"\border_id#\d+ ASC", plan_of(got))
    items = ", ".join(f"{c} string" for c in SOURCE_COLUMNS["order_items"]) + ", ingestion_timestamp timestamp_ntz"
    assert not re.search(r"\border_(item_)?id#\d+ ASC", plan_of(clean_order_items(spark.createDataFrame([], items))))


def test_two_states_stand_while_a_load_lasts(spark, feeds, monkeypatch):
    p, seen, plain = pipeline(spark, feeds, "wh-room"), [], TableStore.write_version
    monkeypatch.setattr(TableStore, "write_version", lambda self, layer, table, *a, **k: (
        seen.append(len(self.versions(layer, table))) if layer == "source" else None, plain(self, layer, table, *a, **k))[1])
    for _ in range(4):
        p.run_module("source", "customers")
    assert seen == [0, 1, 1, 1] and p.store.versions("source", "customers") == [3, 4]
    # A load that fails leaves the newest state.
    p.feed_reader = lambda n: read_feed(spark, f"{feeds}/nothing", n)
    with pytest.raises(Exception):
        p.run_module("source", "customers")
    assert p.store.read("source", "customers").count() == 135


def test_an_extract_is_given_back_once_it_is_landed(spark, feeds):
    store = TableStore(spark, feeds)
    for n in feed.FEED_BUILDERS:
        write_feed(feed.source_feed(spark, SF_SMALL, n, 1), f"{feeds}/gone/b1/{n}", n, "gzip")
    p, seen = Pipeline(spark, f"{feeds}/wh-gone", lambda n: read_feed(spark, f"{feeds}/gone/b1/{n}", n)), []

    def landed():
        seen.append((p.store.exists("source", "payments"), p.store.exists("bronze", "customers")))
        store.drop("gone", "b1")

    assert p.run(landed=landed).total_rows > 0 and seen == [(True, False)]
    assert p.gold("fact_orders").count() == p.silver("orders").count() > 0


def test_known_source_rows_are_told_by_their_keys_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    schema = ", ".join(f"{c} string" for c in SOURCE_COLUMNS["customers"])
    rows = lambda ids: spark.createDataFrame([(i, "u", "1", "c", "s") for i in ids], schema)
    append_new(store, rows([f"k{i}" for i in range(3000)]), "customers", T1, "incremental")
    new = KeyIndex(store, "customers", ("customer_id",)).new_rows(rows([f"k{i}" for i in range(3000)] + ["n1", "n2", None]))
    assert sorted([r.customer_id for r in new.collect()], key=str) == [None, "n1", "n2"]
    # Rows go to the exact comparison through a second bitmap, made of the bare keys that the index lacks.
    lines = plan_of(new).split("\n")
    assert any("LeftAnti" in x for x in lines) and any("bitmap_construct_agg" in x for x in lines)


def test_customers_are_looked_up_per_order(spark):
    items = spark.createDataFrame([], "order_id string, order_item_id int, product_id string, price decimal(10,2), freight_value decimal(10,2), total_item_value decimal(10,2), is_free_shipping int")
    orders = spark.createDataFrame([], "order_id string, customer_id string, order_status string, is_late_delivery int, order_purchase_timestamp timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
    pay = spark.createDataFrame([], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(10,2)")
    dc, dp = spark.createDataFrame([], "customer_id string, customer_key long"), spark.createDataFrame([], "product_id string, product_key long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(G.fact_sales(items, orders, pay, dc, dp, G.dim_date(spark))).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda x: re.search(r"[A-Za-z]", x).start() if re.search(r"[A-Za-z]", x) else 0
    at = [i for i, x in enumerate(lines) if "hashpartitioning(customer_id" in x]
    assert at
    for i in at:
        below = []
        for x in lines[i + 1:]:
            if depth(x) <= depth(lines[i]):
                break
            below.append(x)
        assert "order_item_id" not in "".join(below)  # no line crosses the shuffle by customer
