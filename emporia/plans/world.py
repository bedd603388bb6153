"""Lazy, in-plan build of every layer from the given tables (snapshot semantics).

``World`` wires the layer functions into one DataFrame plan per question:
feeds -> bronze -> silver -> star schema -> views.  Nothing is written and
nothing is collected (except the few bounded numbers the ordinal helpers
need), so Catalyst sees the whole chain and prunes columns / pushes filters
down to the Parquet scans.  The persisted, incremental form of the same
chain lives in ``emporia.plans.pipeline``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.text import parse_dmy
from emporia.operators import bronze as B
from emporia.operators import gold as G
from emporia.operators.merge import ACTION, insert_all, merge
from emporia.operators.silver import CLEANERS
from emporia.schemas import FEEDS, LOAD_INCREMENTAL, LOAD_SNAPSHOT, SILVER_SPECS
from emporia.sources import derived_feed as feed

TS1 = dt.datetime(2024, 1, 1)
TS2 = dt.datetime(2024, 1, 2)


class World:
    def __init__(self, spark: SparkSession, sf_dir: str, calendar: tuple[dt.date, dt.date] | None = None,
                 batch_ts: dt.datetime = TS1) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.calendar_range = calendar
        self.batch_ts = batch_ts

    # ---- source and bronze ------------------------------------------------
    def source(self, name: str, batch: int | None = None) -> DataFrame:
        return feed.source_feed(self.spark, self.sf_dir, name, batch)

    def bronze(self, name: str, batch: int | None = None) -> DataFrame:
        return feed.bronze_feed(self.spark, self.sf_dir, name, batch)

    def bronze_two_loads(self, name: str) -> DataFrame:
        """Bronze after a first load (batch 1) and an incremental load of the full batch-2 extract."""
        first = B.load(self.source(name, 1), None, name, TS1, LOAD_SNAPSHOT, feed.FIXTURE_SOURCE_SYSTEM)
        second = B.load(self.source(name, 2), first, name, TS2, LOAD_INCREMENTAL, feed.FIXTURE_SOURCE_SYSTEM)
        return first.unionByName(second)

    # ---- silver -----------------------------------------------------------
    def silver(self, name: str, batch: int | None = None) -> DataFrame:
        return CLEANERS[name](self.bronze(name, batch))

    def silver_upsert(self, name: str) -> DataFrame:
        """Silver of batch 1, then MERGE of the batch-2 extract (matched rows always updated)."""
        spec = SILVER_SPECS[name]
        cols = list(spec.columns)
        target = insert_all(self.silver(name, 1), cols, TS1).drop(ACTION)
        return merge(target, self.silver(name, 2), list(spec.keys), cols, list(spec.update_columns), TS2)

    def silver_after(self, name: str) -> DataFrame:
        """Silver after both loads."""
        return self.silver_upsert(name).drop(ACTION)

    # ---- gold -------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar of the given range, or of the whole years of the feed's order dates (one column's range to the driver)."""
        span = self.calendar_range
        if span is None:
            dates = self.source("orders").select(parse_dmy("order_purchase_timestamp").alias("t"))
            span = G.calendar_range_for(dates, "t")
        return G.dim_date(self.spark, *span)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return G.build_dim(self.silver("customers"), G.DIM_CUSTOMER_COLUMNS, "customer_id", "customer_key",
                           self.batch_ts).drop(ACTION)

    @cached_property
    def dim_products(self) -> DataFrame:
        return G.build_dim(self.silver("products"), G.DIM_PRODUCT_COLUMNS, "product_id", "product_key",
                           self.batch_ts).drop(ACTION)

    def dim_two_loads(self, which: str) -> DataFrame:
        """Dimension after batch 1, then a snapshot silver of batch 2 merged with change detection."""
        if which == "customers":
            cols, idc, key, upd, cmp_ = (G.DIM_CUSTOMER_COLUMNS, "customer_id", "customer_key",
                                         G.CUSTOMER_UPDATES, G.CUSTOMER_COMPARE)
        else:
            cols, idc, key, upd, cmp_ = (G.DIM_PRODUCT_COLUMNS, "product_id", "product_key",
                                         G.PRODUCT_UPDATES, G.PRODUCT_COMPARE)
        first = G.build_dim(self.silver(which, 1), cols, idc, key, TS1).drop(ACTION)
        max_key = first.agg(F.max(key)).first()[0] or 0
        return G.merge_dim(first, self.silver(which, 2), cols, idc, key, upd, cmp_, TS2, max_key)

    def fact_two_loads(self, which: str) -> DataFrame:
        """Fact of the first load, then the incremental load after the silver merges (without dimension keys)."""
        def load(table, watermark=None, existing=None):
            orders, items, payments = table("orders"), table("order_items"), table("payments")
            if which == "fact_sales":
                return G.fact_sales(items, orders, payments, None, None, self.dim_date, watermark, existing)
            return G.fact_orders(orders, items, payments, None, self.dim_date, watermark, existing)

        first = load(lambda n: insert_all(self.silver(n, 1), list(SILVER_SPECS[n].columns), TS1).drop(ACTION))
        second = load(self.silver_after, TS1, first)
        stamp = lambda df, ts: df.withColumn("created_at", F.lit(ts).cast("timestamp_ntz"))
        return stamp(first, TS1).unionByName(stamp(second, TS2))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return G.fact_sales(self.silver("order_items"), self.silver("orders"), self.silver("payments"),
                            self.dim_customers, self.dim_products, self.dim_date)

    def sales_lines(self, dim_products: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
        """``fact_sales`` without the keys that a report does not read."""
        return G.fact_sales(self.silver("order_items"), self.silver("orders"), self.silver("payments"),
                            None, dim_products, self.dim_date, carry=carry)

    @cached_property
    def order_heads(self) -> DataFrame:
        """``fact_orders`` without the customer key, with the customer's id."""
        return G.fact_orders(self.silver("orders"), self.silver("order_items"), self.silver("payments"),
                             None, self.dim_date, carry=("customer_id",))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return G.fact_orders(self.silver("orders"), self.silver("order_items"), self.silver("payments"),
                             self.dim_customers, self.dim_date)


__all__ = ["World", "FEEDS", "TS1", "TS2"]
