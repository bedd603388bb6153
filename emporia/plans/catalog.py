"""Registry of every implemented operator as a query over the given tables.

Each entry is ``(spark, sf_dir) -> DataFrame``; the keys are the operator
keys of SURVEY section 2.  Surrogate-key *values* and run clocks are not part
of the outputs compared with the SQL oracle (only their properties are).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions import flags as Q
from emporia.functions.text import clean_text, to_dec
from emporia.operators import gold as G
from emporia.operators.merge import ACTION
from emporia.operators.profile import profile
from emporia.operators.silver import CLEANERS, since_date
from emporia.plans import dashboards as D
from emporia.plans import reports as R
from emporia.plans.world import TS1, TS2, World
from emporia.schemas import (
    FEEDS, LOAD_INCREMENTAL, LOAD_SNAPSHOT, PAYMENT_NOT_DEFINED, RUN_BRONZE, RUN_GOLD, RUN_MAIN, RUN_SILVER, SILVER_SPECS,
    SOURCE_COLUMNS, SOURCE_KINDS,
)
from emporia.sources.csv_feed import read_feed_checked

Query = Callable[[SparkSession, str], DataFrame]

# Calendar used by the look-up demo: narrower than the data, so some keys are NULL.
LOOKUP_CALENDAR = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))


def _w(spark: SparkSession, sf_dir: str) -> World:
    return World(spark, sf_dir)


def _counts(frames: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
            F.lit(name).alias(label), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


# ---- sources / bronze / silver -------------------------------------------
def _src(name: str) -> Query:
    return lambda spark, sf: _w(spark, sf).source(name)


_LOADS: dict[str, object] = {}


def _two_loads(spark: SparkSession, sf: str, name: str):
    """A feed's stored bronze after a first load and an incremental load of the second extract, through
    the append sink and its key index (once per process and feed)."""
    from emporia.operators.control import new_id
    from emporia.plans.pipeline import append_new
    from emporia.session import scratch_path
    from emporia.sources import derived_feed as feed
    from emporia.sources.store import TableStore

    key = f"{sf}|{id(spark)}|{name}"
    if key not in _LOADS:
        store = TableStore(spark, scratch_path(spark, "emporia-bronze", new_id()))
        for batch, ts, load_type in ((1, TS1, LOAD_SNAPSHOT), (2, TS2, LOAD_INCREMENTAL)):
            append_new(store, feed.source_feed(spark, sf, name, batch), name, ts, load_type, feed.FIXTURE_SOURCE_SYSTEM)
        _LOADS[key] = store
    return _LOADS[key].read("bronze", name)


def _bronze(name: str) -> Query:
    def q(spark, sf):
        return _two_loads(spark, sf, name).drop("ingestion_date", "load_batch")
    return q


def _silver_increment(name: str) -> Query:
    """Cleaned rows that the second load brought: silver's incremental read of bronze (partitions by date, then time)."""
    def q(spark, sf):
        rows = _two_loads(spark, sf, name)
        return CLEANERS[name](since_date(rows, TS1).drop("ingestion_date", "load_batch"), TS1)
    return q


def _silver(name: str) -> Query:
    return lambda spark, sf: _w(spark, sf).silver(name)


def src_load_counts(spark, sf):
    w = _w(spark, sf)
    return _counts({n: w.source(n) for n in FEEDS}, "feed")


def bronze_load_counts(spark, sf):
    """Rows appended per feed by the first load and by the incremental second load."""
    w = _w(spark, sf)
    out = None
    for n in FEEDS:
        b = w.bronze_two_loads(n)
        c = b.groupBy(F.lit(n).alias("feed"), F.col("ingestion_timestamp").alias("load_ts")).agg(
            F.count(F.lit(1)).cast("long").alias("rows_appended"))
        out = c if out is None else out.unionByName(c)
    return out


def silver_load_counts(spark, sf):
    w = _w(spark, sf)
    return _counts({SILVER_SPECS[n].name: w.silver(n) for n in FEEDS})


def silver_upsert(spark, sf):
    return _w(spark, sf).silver_upsert("customers").withColumnRenamed(ACTION, "merge_action")


def _silver_upsert(name: str) -> Query:
    return lambda spark, sf: _w(spark, sf).silver_upsert(name).withColumnRenamed(ACTION, "merge_action")


# ---- data-quality flags, per bronze row ----------------------------------
def _orders_flag(expr_fn) -> Query:
    def q(spark, sf):
        b = _w(spark, sf).bronze("orders")
        st = Q.order_status("order_status")
        return b.select(F.trim("order_id").alias("order_id"), expr_fn(st).alias("flag"))
    return q


def _parsed_orders_flag(which: str) -> Query:
    def q(spark, sf):
        b = _w(spark, sf).bronze("orders")
        d = Q.order_dates()
        if which == "sequence":
            f = Q.invalid_date_sequence(d["order_purchase_timestamp"], d["order_approved_at"],
                                        d["order_delivered_carrier_date"], d["order_delivered_customer_date"])
        else:
            f = Q.late_delivery(d["order_delivered_customer_date"], d["order_estimated_delivery_date"])
        return b.select(F.trim("order_id").alias("order_id"), f.alias("flag"))
    return q


def dq_free_shipping(spark, sf):
    b = _w(spark, sf).bronze("order_items")
    return b.select(F.trim("order_id").alias("order_id"), F.trim("order_item_id").alias("order_item_id"),
                    Q.free_shipping("freight_value").alias("flag"))


def _products_flag(fn) -> Query:
    def q(spark, sf):
        b = _w(spark, sf).bronze("products")
        return b.select(F.trim("product_id").alias("product_id"), fn().alias("flag"))
    return q


def _payments_flag(fn) -> Query:
    def q(spark, sf):
        b = _w(spark, sf).bronze("payments")
        return b.select(F.trim("order_id").alias("order_id"),
                        F.trim("payment_sequential").alias("payment_sequential"), fn().alias("flag"))
    return q


def dq_profile(spark, sf):
    """Profiling facts behind the cleaning rules, one pass per feed, long format."""
    w = _w(spark, sf)
    o, it, p, pay = w.bronze("orders"), w.bronze("order_items"), w.bronze("products"), w.bronze("payments")
    d = Q.order_dates()
    parts = [
        o.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(d["order_purchase_timestamp"].isNull()).alias("purchase_unparsable"),
            F.count_if(clean_text("order_approved_at").isNull()).alias("approved_missing"),
            F.count_if(clean_text("order_delivered_carrier_date").isNull()).alias("carrier_missing"),
            F.count_if(clean_text("order_delivered_customer_date").isNull()).alias("customer_date_missing"),
            F.count_if((d["order_approved_at"] < d["order_purchase_timestamp"])
                       | (d["order_delivered_carrier_date"] < d["order_approved_at"])
                       | (d["order_delivered_customer_date"] < d["order_delivered_carrier_date"]))
            .alias("date_order_violations"),
        ).select(F.lit("orders").alias("feed"), F.expr(
            "stack(6, 'rows', rows, 'purchase_unparsable', purchase_unparsable, 'approved_missing', "
            "approved_missing, 'carrier_missing', carrier_missing, 'customer_date_missing', "
            "customer_date_missing, 'date_order_violations', date_order_violations) as (metric, value)")),
        it.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(to_dec("price").isNull()).alias("price_unparsable"),
            F.count_if(clean_text("freight_value").isNull()).alias("freight_missing"),
            F.count_if(to_dec("freight_value") == 0).alias("zero_freight"),
        ).select(F.lit("order_items").alias("feed"), F.expr(
            "stack(4, 'rows', rows, 'price_unparsable', price_unparsable, 'freight_missing', freight_missing, "
            "'zero_freight', zero_freight) as (metric, value)")),
        p.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(clean_text("product_category_name").isNull()).alias("category_missing"),
            F.count_if(clean_text("product_weight_g").isNull()).alias("weight_missing"),
        ).select(F.lit("products").alias("feed"), F.expr(
            "stack(3, 'rows', rows, 'category_missing', category_missing, 'weight_missing', weight_missing) "
            "as (metric, value)")),
        pay.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.lower(F.trim("payment_type")) == PAYMENT_NOT_DEFINED).alias("type_not_defined"),
            F.count_if(clean_text("payment_value").isNull()).alias("value_missing"),
            F.count_if(to_dec("payment_value") == 0).alias("zero_value"),
            F.count_if(clean_text("payment_installments").isNull()).alias("installments_missing"),
        ).select(F.lit("payments").alias("feed"), F.expr(
            "stack(5, 'rows', rows, 'type_not_defined', type_not_defined, 'value_missing', value_missing, "
            "'zero_value', zero_value, 'installments_missing', installments_missing) as (metric, value)")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("feed", "metric", F.col("value").cast("long").alias("value"))


def dq_profile_columns(spark, sf):
    """Every column of every feed: rows, NULLs, blanks and unparsable values (the distinct estimate is left out: SQL counts exactly)."""
    w = _w(spark, sf)
    parts = [profile(w.source(n), SOURCE_COLUMNS[n], SOURCE_KINDS[n]).drop("distinct_estimate").select(F.lit(n).alias("feed"), "*") for n in FEEDS]
    return reduce(DataFrame.unionByName, parts)


# ---- delimited files -------------------------------------------------------
_STAGED: dict[str, str] = {}


def _staged_csv(spark: SparkSession, sf: str, n: str) -> str:
    """A feed as delimited files with cities that hold commas and quotes, and a short and a long line for
    every row whose first id ends in 77 (once per process and feed); its folder."""
    from emporia.operators.control import new_id
    from emporia.session import scratch_path
    from emporia.sources import derived_feed as feed
    from emporia.sources.csv_feed import write_feed

    key = f"{sf}|{id(spark)}|{n}"
    if key not in _STAGED:
        path = scratch_path(spark, "emporia-csv", new_id(), n)
        rows = feed.source_feed(spark, sf, n)
        if n == "customers":
            rows = rows.withColumn("customer_city", F.concat("customer_city", F.lit(', "'), "customer_state", F.lit('"')))
        write_feed(rows, path, n, "gzip")
        columns = SOURCE_COLUMNS[n]
        first = F.trim(columns[0])
        lines = rows.where(F.endswith(first, F.lit("77"))).select(F.explode(F.array(
            first, F.concat_ws(",", F.array_repeat(first, len(columns) + 1)))).alias("value"))
        header = spark.createDataFrame([(",".join(columns),)], "value string")
        header.unionByName(lines).coalesce(1).write.mode("append").option("compression", "gzip").text(path)
        _STAGED[key] = path
    return _STAGED[key]


def _csv(name: str) -> Query:
    def q(spark, sf):
        return read_feed_checked(spark, _staged_csv(spark, sf, name), name)[0]
    return q


def csv_rejects(spark, sf):
    """Rejected lines per feed and reason."""
    parts = [read_feed_checked(spark, _staged_csv(spark, sf, n), n)[1] for n in FEEDS]
    return reduce(DataFrame.unionByName, parts).groupBy("feed", "reason").agg(F.count("line").cast("long").alias("rows"))


# ---- gold ----------------------------------------------------------------
def _no_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.drop(*keys)


def dim_customers(spark, sf):
    return _no_keys(_w(spark, sf).dim_two_loads("customers"), "customer_key").withColumnRenamed(ACTION, "merge_action")


def dim_products(spark, sf):
    return _no_keys(_w(spark, sf).dim_two_loads("products"), "product_key").withColumnRenamed(ACTION, "merge_action")


def dim_date(spark, sf):
    """The calendar over whole years of the warehouse's order dates."""
    w = _w(spark, sf)
    return G.dim_date(spark, *G.calendar_range_for(w.silver("orders"), "order_purchase_timestamp"))


def fact_sales(spark, sf):
    return _no_keys(_w(spark, sf).fact_sales, "customer_key", "product_key")


def fact_orders(spark, sf):
    return _no_keys(_w(spark, sf).fact_orders, "customer_key")


def surrogate_keys(spark, sf):
    """Key properties per dimension: dense 1..N and unique (values themselves are not contractual)."""
    w = _w(spark, sf)
    out = None
    for name, df, key in (("dim_customers", w.dim_customers, "customer_key"),
                          ("dim_products", w.dim_products, "product_key"),
                          ("dim_customers_two_loads", w.dim_two_loads("customers"), "customer_key"),
                          ("dim_products_two_loads", w.dim_two_loads("products"), "product_key")):
        c = df.agg(F.count(F.lit(1)).cast("long").alias("row_count"),
                   F.count_distinct(key).cast("long").alias("distinct_keys"),
                   F.min(key).cast("long").alias("min_key"),
                   F.max(key).cast("long").alias("max_key")).select(F.lit(name).alias("table_name"), "*")
        out = c if out is None else out.unionByName(c)
    return out


def gold_incremental_filter(spark, sf):
    """Silver customers changed after the first load's watermark (inserted or updated later)."""
    merged = _w(spark, sf).silver_upsert("customers").drop(ACTION)
    return G.changed_since(merged, TS1).select("customer_id", "customer_city", "created_at", "updated_at")


def _incremental_filter(name: str) -> Query:
    """Silver rows changed after the first load's watermark, whole."""
    return lambda spark, sf: G.changed_since(_w(spark, sf).silver_after(name), TS1)


def fact_sales_two_loads(spark, sf):
    return _w(spark, sf).fact_two_loads("fact_sales")


def fact_orders_two_loads(spark, sf):
    return _w(spark, sf).fact_two_loads("fact_orders")


def first_payment_per_order(spark, sf):
    return G.first_payment_per_order(_w(spark, sf).silver("payments"))


def date_key_lookup(spark, sf):
    w = _w(spark, sf)
    cal = G.dim_date(spark, *LOOKUP_CALENDAR)
    o = w.silver("orders").select("order_id", "order_purchase_timestamp")
    return G._calendar_lookup(o, cal).select("order_id", "date_key")


def order_item_totals(spark, sf):
    return G.order_item_totals(_w(spark, sf).silver("order_items")).select(
        "order_id", F.col("total_order_value").cast("decimal(38,2)").alias("total_order_value"), "item_count")


def order_payment_totals(spark, sf):
    return G.order_payment_totals(_w(spark, sf).silver("payments")).select(
        "order_id", F.col("total_payment_value").cast("decimal(38,2)").alias("total_payment_value"))


def gold_load_counts(spark, sf):
    w = _w(spark, sf)
    return _counts({"dim_customers": w.dim_customers, "dim_products": w.dim_products,
                    "fact_sales": w.fact_sales, "fact_orders": w.fact_orders})


# ---- reports -------------------------------------------------------------
def sales_summary(spark, sf):
    w = _w(spark, sf)
    return R.sales_summary(w.sales_lines(), w.dim_date, w.order_heads)


def product_performance(spark, sf):
    w = _w(spark, sf)
    return R.product_performance(w.sales_lines(w.dim_products), w.dim_products, w.order_heads)


def customer_revenue(spark, sf):
    w = _w(spark, sf)
    # Added up by customer_id: no key is looked up per order, and the dimension needs no numbering.
    return R.customer_revenue(w.order_heads, w.silver("customers"), "customer_id")


def delivery_quality(spark, sf):
    return R.delivery_quality(_w(spark, sf).order_heads)


# ---- control (SQL-checkable parts)-----------------------------------------
def ctl_rows_affected(spark, sf):
    """Rows inserted / updated by the second load of each merged table."""
    w = _w(spark, sf)
    out = None
    for name, df in (("silver_customers", w.silver_upsert("customers")),
                     ("silver_products", w.silver_upsert("products")),
                     ("gold_dim_customers", w.dim_two_loads("customers")),
                     ("gold_dim_products", w.dim_two_loads("products"))):
        c = df.agg(F.count_if(F.col(ACTION) == "insert").cast("long").alias("rows_inserted"),
                   F.count_if(F.col(ACTION) == "update").cast("long").alias("rows_updated")).select(
            F.lit(name).alias("table_name"), "rows_inserted", "rows_updated",
            (F.col("rows_inserted") + F.col("rows_updated")).alias("rows_out"))
        out = c if out is None else out.unionByName(c)
    return out


def ctl_rows_affected_all(spark, sf):
    """Rows inserted / updated by the second load of every bronze, silver and gold table."""
    w = _w(spark, sf)
    merged = {f"silver_{n}": w.silver_upsert(n) for n in FEEDS}
    merged |= {f"gold_dim_{n}": w.dim_two_loads(n) for n in ("customers", "products")}
    appended = {f"bronze_{n}": (w.bronze_two_loads(n), "ingestion_timestamp") for n in FEEDS}
    appended |= {f"gold_{n}": (w.fact_two_loads(n), "created_at") for n in ("fact_sales", "fact_orders")}
    tests = {n: (df, F.col(ACTION) == "insert", F.col(ACTION) == "update") for n, df in merged.items()}
    tests |= {n: (df, F.col(c) == F.lit(TS2).cast("timestamp_ntz"), F.lit(False)) for n, (df, c) in appended.items()}
    out = None
    for name, (df, inserted, updated) in tests.items():
        c = df.agg(F.count_if(inserted).cast("long").alias("rows_inserted"),
                   F.count_if(updated).cast("long").alias("rows_updated")).select(
            F.lit(name).alias("table_name"), "rows_inserted", "rows_updated",
            (F.col("rows_inserted") + F.col("rows_updated")).alias("rows_out"))
        out = c if out is None else out.unionByName(c)
    return out


# ---- dashboards ----------------------------------------------------------
def dash_monthly_revenue(spark, sf):
    return D.monthly_revenue(sales_summary(spark, sf))


def dash_payment_split(spark, sf):
    return D.payment_split(_w(spark, sf).sales_lines())


def dash_top_products(spark, sf):
    w = _w(spark, sf)
    return D.top_products(w.sales_lines(carry=("product_id",)), w.silver("products"), key="product_id")


def dash_category_revenue(spark, sf):
    w = _w(spark, sf)
    return D.category_revenue(w.sales_lines(w.dim_products), w.dim_products)


def dash_free_shipping(spark, sf):
    return D.free_shipping(_w(spark, sf).sales_lines())


def dash_customer_ltv(spark, sf):
    return D.customer_ltv(customer_revenue(spark, sf))


def dash_repeat_customers(spark, sf):
    return D.repeat_customers(customer_revenue(spark, sf))


def dash_revenue_by_state(spark, sf):
    w = _w(spark, sf)
    return D.revenue_by_state(w.fact_orders, w.dim_customers)


def dash_late_rate(spark, sf):
    return D.late_rate(delivery_quality(spark, sf))


def dash_dq_by_month(spark, sf):
    return D.dq_by_month(delivery_quality(spark, sf))


def dash_cancellations(spark, sf):
    return D.cancellations(_w(spark, sf).order_heads)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for n in FEEDS:
        q[f"src_{n}"] = _src(n)
        q[f"csv_{n}"] = _csv(n)
    q["src_load_counts"] = src_load_counts
    for n in FEEDS:
        q[f"bronze_{n}"] = _bronze(n)
    q["bronze_load_counts"] = bronze_load_counts
    for n in FEEDS:
        q[f"silver_{n}"] = _silver(n)
        q[f"silver_increment_{n}"] = _silver_increment(n)
    q["silver_upsert"] = silver_upsert
    for n in FEEDS:
        if n != "customers":
            q[f"silver_upsert_{n}"] = _silver_upsert(n)
        q[f"gold_incremental_filter_{n}"] = _incremental_filter(n)
    q["silver_load_counts"] = silver_load_counts
    q["dq_delivery_inconsistent"] = _orders_flag(
        lambda st: Q.delivery_inconsistent(st, "order_delivered_customer_date"))
    q["dq_shipped_missing"] = _orders_flag(lambda st: Q.shipped_missing(st, "order_delivered_carrier_date"))
    q["dq_canceled_in_transit"] = _orders_flag(
        lambda st: Q.canceled_in_transit(st, "order_delivered_carrier_date", "order_delivered_customer_date"))
    q["dq_canceled_but_reached"] = _orders_flag(
        lambda st: Q.canceled_but_reached(st, "order_delivered_carrier_date", "order_delivered_customer_date"))
    q["dq_invalid_date_sequence"] = _parsed_orders_flag("sequence")
    q["dq_late_delivery"] = _parsed_orders_flag("late")
    q["dq_free_shipping"] = dq_free_shipping
    q["dq_missing_category"] = _products_flag(lambda: Q.missing_category("product_category_name"))
    q["dq_missing_dimensions"] = _products_flag(lambda: Q.missing_dimensions("product_weight_g"))
    q["dq_payment_not_defined"] = _payments_flag(lambda: Q.payment_not_defined("payment_type"))
    q["dq_payment_zero_value"] = _payments_flag(lambda: Q.payment_zero_value("payment_value"))
    q["dq_profile"] = dq_profile
    q["dq_profile_columns"] = dq_profile_columns
    q["csv_rejects"] = csv_rejects
    for f in (dim_customers, dim_products, dim_date, fact_sales, fact_orders, surrogate_keys,
              gold_incremental_filter, first_payment_per_order, date_key_lookup, order_item_totals,
              order_payment_totals, gold_load_counts, sales_summary, product_performance,
              customer_revenue, delivery_quality, ctl_rows_affected,
              fact_sales_two_loads, fact_orders_two_loads, ctl_rows_affected_all, dash_monthly_revenue, dash_payment_split, dash_top_products,
              dash_category_revenue, dash_free_shipping, dash_customer_ltv, dash_repeat_customers,
              dash_revenue_by_state, dash_late_rate, dash_dq_by_month, dash_cancellations):
        q[f.__name__] = f
    q.update(pipeline_registry())
    return q


# ---- real pipeline runs over the given tables ---------------------------------------------
RUN_TIMES = (TS1, TS2, dt.datetime(2024, 1, 3))
_RUNS: dict[str, object] = {}
_SILVER: dict[str, list] = {}


def _at_once(jobs: list[Callable[[], object]]) -> list:
    """Results of independent jobs run as concurrent Spark jobs: one fills the cores that another's last tasks leave idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def pipeline_runs(spark: SparkSession, sf: str):
    """Run the stored pipeline once per process: a first load (batch 1), an incremental load of the
    batch-2 extract and a snapshot reload.  Its clock stands at the batch time and its ids count up, so
    logs and tables depend on the given tables alone.  After each run the digests of the stored gold
    tables are taken (one row a table)."""
    key = f"{sf}|{id(spark)}"
    if key not in _RUNS:
        from emporia.operators.control import new_id
        from emporia.plans.pipeline import Pipeline
        from emporia.session import released_shuffles, scratch_path
        from emporia.sources import derived_feed as feed
        from emporia.sources.csv_feed import read_feed, write_feed
        from emporia.sources.store import TableStore

        base = scratch_path(spark, "emporia-runs", new_id())
        extracts = TableStore(spark, base)
        state, ids = {"batch": 0, "now": TS1}, count(1)
        p = Pipeline(spark, f"{base}/warehouse",
                     lambda n: read_feed(spark, f"{base}/feeds/b{state['batch']}/{n}", n),
                     source_system=feed.FIXTURE_SOURCE_SYSTEM, clock=lambda: state["now"], ids=lambda: f"{next(ids):06d}")
        results, digests, silver = [], [], _SILVER.setdefault(key, [])
        # An extract stands from its first run until its last has it in the source tables.
        for run, (batch, load_type, now, last) in enumerate(zip((1, 2, 2), (LOAD_INCREMENTAL, LOAD_INCREMENTAL, LOAD_SNAPSHOT), RUN_TIMES, (True, False, True)), 1):
            if batch != state["batch"]:
                _at_once([lambda n=n: write_feed(feed.source_feed(spark, sf, n, batch), f"{base}/feeds/b{batch}/{n}", n, "gzip", "BEST_SPEED") for n in FEEDS])
            state |= {"batch": batch, "now": now}
            results.append(p.run(load_type, now, (lambda b=batch: extracts.drop("feeds", f"b{b}")) if last else None))
            with released_shuffles(spark):
                of_gold, of_silver = _at_once([lambda: p.gold_digests().collect(), lambda: p.silver_digests().collect()])
            digests += [(run, *r) for r in of_gold]
            silver += [(run, *r) for r in of_silver]
        _RUNS[key] = (p, results, digests)
    return _RUNS[key]


def run_pipeline(spark, sf):
    """Per run: load type, state, rows processed and times (from the runs' log)."""
    p, *_ = pipeline_runs(spark, sf)
    return p.control.run_log().where(F.col("pipeline_name") == RUN_MAIN).select(
        "run_id", "load_type", "status", "rows_processed", "start_time", "end_time", "duration_seconds")


def ctl_run_log(spark, sf):
    """Every step of every run with its last state."""
    p, *_ = pipeline_runs(spark, sf)
    return p.control.run_log()


def ctl_last_runs(spark, sf):
    p, *_ = pipeline_runs(spark, sf)
    return p.control.last_runs(10)


def ctl_rows_by_table(spark, sf):
    """Rows that each load of each run wrote (inserted and updated), as counted by the writes themselves."""
    _, results, _ = pipeline_runs(spark, sf)
    rows = [(i, name, int(n)) for i, r in enumerate(results, 1) for name, n in r.rows.items()]
    return spark.createDataFrame(rows, "run int, table_name string, rows_written long")


def gold_store_digests(spark, sf):
    """Content digests of the stored dimensions, facts and reports after each of the three runs."""
    _, _, digests = pipeline_runs(spark, sf)
    return spark.createDataFrame(digests, "run int, table_name string, row_count long, digest decimal(38,0), keys_ok boolean")


def silver_store_digests(spark, sf):
    """Content digests of the stored silver tables after each of the three runs."""
    pipeline_runs(spark, sf)
    return spark.createDataFrame(_SILVER[f"{sf}|{id(spark)}"], "run int, table_name string, row_count long, digest decimal(38,0)")


def ctl_run_rows_total(spark, sf):
    """Rows processed by the bronze, silver and gold steps of each run, summed from its log (source excluded)."""
    p, results, _ = pipeline_runs(spark, sf)
    log = p.control.run_log().where(F.col("pipeline_name").isin(RUN_BRONZE, RUN_SILVER, RUN_GOLD))
    return log.groupBy("run_id").agg(F.sum("rows_processed").cast("long").alias("rows_processed"))


def ctl_reconcile_counts(spark, sf):
    """Stored gold row counts against the counts that the stored silver implies, after the last run."""
    p, *_ = pipeline_runs(spark, sf)
    silver = {n: p.silver(n) for n in FEEDS}
    actual = _counts({t: p.gold(t) for t in ("dim_customers", "dim_products", "dim_date", "fact_sales", "fact_orders")})
    items_with_order = silver["order_items"].join(silver["orders"].select("order_id"), "order_id", "left_semi")
    days = G.dim_date(spark, *G.calendar_range_for(silver["orders"], "order_purchase_timestamp"))
    expected = _counts({"dim_customers": silver["customers"], "dim_products": silver["products"], "dim_date": days,
                        "fact_sales": items_with_order, "fact_orders": silver["orders"]}).withColumnRenamed("row_count", "expected_rows")
    return actual.join(expected, "table_name").select(
        "table_name", F.col("row_count").alias("actual_rows"), "expected_rows",
        (F.col("row_count") == F.col("expected_rows")).alias("matches"))


def gold_views_from_store(spark, sf):
    """The four reports over the gold tables that the pipeline wrote (row counts per report)."""
    p, *_ = pipeline_runs(spark, sf)
    return _counts(p.reports(), "view_name")


def pipeline_registry() -> dict[str, Query]:
    return {f.__name__: f for f in (run_pipeline, ctl_run_log, ctl_last_runs, ctl_rows_by_table, ctl_run_rows_total,
                                    ctl_reconcile_counts, silver_store_digests, gold_store_digests, gold_views_from_store)}
