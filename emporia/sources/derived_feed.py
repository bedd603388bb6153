"""The five shop feeds, derived from the given TPC-H-style tables.

The pipeline's input contract is five all-text feeds (customers, orders,
order items, products, payments).  The shipped data are Parquet tables of a
different shape, so this module derives the feeds from them with plain
column expressions: one narrow projection per table (plus two broadcast
look-ups of the 25-row nation / 5-row region tables), no shuffle.  Dirty
values are planted deterministically from the keys so every cleaning rule
and quality flag sees positive and negative rows.

``batch`` models a second delivery for incremental runs:

* ``batch=None`` - the full feed (used by the report queries and the bench);
* ``batch=1``   - first delivery: every row whose driving key ``k % 10 != 0``;
* ``batch=2``   - second, full extract: all rows, and for ``k % 10 == 5`` a
  changed city / category / status (known keys re-sent with new values).

All rule constants below are fixed values of the fixture contract.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.schemas import SOURCE_COLUMNS
from emporia.sources.tables import read_table

FEED_FORMAT = "dd-MM-yyyy HH:mm"
BATCH_TS = {None: dt.datetime(2024, 1, 1), 1: dt.datetime(2024, 1, 1), 2: dt.datetime(2024, 1, 2)}
FIXTURE_SOURCE_SYSTEM = "synthetic"

# Payment type per leading digit of o_orderpriority 1..5.
PAYMENT_TYPES = {"1": "Credit_Card", "2": "boleto ", "3": "voucher", "4": "NOT_DEFINED", "5": "debit_card"}


def _s(c: Column) -> Column:
    return c.cast("string")


def _dec2(c: Column) -> Column:
    return c.cast("decimal(10,2)").cast("string")


def _fmt(c: Column) -> Column:
    return F.date_format(c, FEED_FORMAT)


def _add_min(t: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), t)


def _keep(k: Column, batch: int | None) -> Column | None:
    return (k % 10 != 0) if batch == 1 else None


def _changed(k: Column, batch: int | None) -> Column:
    return (k % 10 == 5) if batch == 2 else F.lit(False)


def _finish(df: DataFrame, name: str, k: Column, batch: int | None) -> DataFrame:
    keep = _keep(k, batch)
    if keep is not None:
        df = df.where(keep)
    return df.select(*SOURCE_COLUMNS[name])


def customers(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    k = F.col("c_custkey")
    city = F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))
    # nation (25 rows) and region (5 rows) have fixed sizes in this schema: safe to broadcast.
    df = (
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
        .withColumn("customer_id", _s(k))
        .withColumn("customer_unique_id", _s(k - k % 2))
        .withColumn("customer_zip_code_prefix",
                    F.when(k % 47 == 0, F.lit("n/a")).otherwise(_s(F.lit(10000) + (k * 7) % 90000)))
        .withColumn("customer_city",
                    F.when(_changed(k, batch), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" north ")))
                    .otherwise(city))
        .withColumn("customer_state", F.lower(F.substring("r_name", 1, 2)))
    )
    return _finish(df, "customers", k, batch)


def orders(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k, d, st = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    m = k % 1440
    status = (
        F.when(k % 50 == 49, F.lit("unavailable"))
        .when(st == "F", F.lit("delivered"))
        .when(st == "O", F.lit("shipped"))
        .when(st == "P", F.lit("Canceled "))
    )
    df = (
        o.withColumn("order_id", F.when(k % 11 == 0, F.concat(F.lit(" "), _s(k), F.lit(" "))).otherwise(_s(k)))
        .withColumn("customer_id", _s(F.col("o_custkey")))
        .withColumn("order_status",
                    F.when(_changed(k, batch) & (st == "O") & (k % 50 != 49), F.lit("delivered")).otherwise(status))
        .withColumn("order_purchase_timestamp",
                    F.when(k % 97 == 0, F.lit("not a date")).otherwise(_fmt(_add_min(d, m))))
        .withColumn("order_approved_at",
                    F.when(k % 13 == 0, F.lit(""))
                    .when(k % 31 == 0, _fmt(_add_min(d, m - 30)))
                    .otherwise(_fmt(_add_min(d, m + 30))))
        .withColumn("order_delivered_carrier_date",
                    F.when((k % 17 == 0) | ((st == "P") & (k % 3 == 0)), F.lit(None).cast("string"))
                    .otherwise(_fmt(_add_min(d, F.lit(2880) + k % 1000))))
        .withColumn("order_delivered_customer_date",
                    F.when((k % 19 == 0) | (st == "O") | ((st == "P") & (k % 5 != 0)), F.lit(None).cast("string"))
                    .otherwise(_fmt(_add_min(d, (F.lit(5) + k % 20) * 1440))))
        .withColumn("order_estimated_delivery_date", _fmt(_add_min(d, F.lit(1440 * 18))))
    )
    return _finish(df, "orders", k, batch)


def order_items(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_extendedprice", "l_tax", "l_shipdate")
    k = F.col("l_orderkey")
    price = F.col("l_extendedprice")
    df = (
        li.withColumn("order_id", _s(k))
        .withColumn("order_item_id", _s(F.col("l_linenumber")))
        .withColumn("product_id", _s(F.col("l_partkey")))
        .withColumn("seller_id", _s(F.col("l_suppkey")))
        .withColumn("shipping_limit_date", _fmt(F.col("l_shipdate")))
        .withColumn("price", F.when(F.col("l_partkey") % 101 == 0, F.lit("n/a")).otherwise(_dec2(price)))
        .withColumn("freight_value",
                    F.when(F.col("l_tax") == 0, F.lit("0"))
                    .when(F.col("l_suppkey") % 23 == 0, F.lit(None).cast("string"))
                    .otherwise(_dec2(price.cast("decimal(10,2)") * F.col("l_tax").cast("decimal(4,2)"))))
        # Items arrive spread over the day: the per-row arrival time orders most duplicates.
        .withColumn("_arrival_minute", (F.col("l_partkey") % 1440).cast("int"))
    )
    keep = _keep(k, batch)
    if keep is not None:
        df = df.where(keep)
    return df.select(*SOURCE_COLUMNS["order_items"], "_arrival_minute")


def products(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    size = F.col("p_size")
    category = (
        F.when(k % 53 == 0, F.lit(""))
        .when(k % 59 == 0, F.lit(None).cast("string"))
        .otherwise(F.lower("p_type"))
    )
    df = (
        p.withColumn("product_id", _s(k))
        .withColumn("product_category_name",
                    F.when(_changed(k, batch) & category.isNotNull() & (category != ""),
                           F.concat(category, F.lit(" refurbished"))).otherwise(category))
        .withColumn("product_name_lenght", _s(F.length("p_name")))
        .withColumn("product_description_lenght", _s(size * 10))
        .withColumn("product_photos_qty", _s(k % 6))
        .withColumn("product_weight_g", F.when(k % 67 == 0, F.lit("")).otherwise(_dec2(F.col("p_retailprice"))))
        .withColumn("product_length_cm", _s(size))
        .withColumn("product_height_cm", _s(k % 40 + 1))
        .withColumn("product_width_cm", _s(size % 20 + 5))
    )
    return _finish(df, "products", k, batch)


def payments(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    # Up to two payment rows per order: a narrow explode, no join and no shuffle.
    seqs = F.filter(
        F.array(F.lit(1), F.lit(2)),
        lambda s: ((s == 1) & (k % 29 != 0)) | ((s == 2) & (k % 2 == 0)),
    )
    prio = F.substring("o_orderpriority", 1, 1)
    ptype = F.lit(None).cast("string")
    for digit, name in reversed(list(PAYMENT_TYPES.items())):
        ptype = F.when(prio == digit, F.lit(name)).otherwise(ptype)
    seq = F.col("seq")
    df = (
        o.withColumn("seq", F.explode(seqs))
        .withColumn("order_id", _s(k))
        .withColumn("payment_sequential", _s(seq))
        .withColumn("payment_type", ptype)
        .withColumn("payment_installments", F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(_s(k % 10 + 1)))
        .withColumn("payment_value",
                    F.when(k % 43 == 0, F.lit(None).cast("string"))
                    .when((seq == 2) & (k % 41 == 0), F.lit("0.00"))
                    .when(seq == 2, F.lit("12.50"))
                    .otherwise(_dec2(F.col("o_totalprice"))))
    )
    return _finish(df, "payments", k, batch)


FEED_BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "products": products,
    "payments": payments,
}


def source_feed(spark: SparkSession, sf_dir: str, name: str, batch: int | None = None) -> DataFrame:
    """The text feed exactly as a CSV extract would carry it."""
    return FEED_BUILDERS[name](spark, sf_dir, batch).select(*SOURCE_COLUMNS[name])


def bronze_feed(spark: SparkSession, sf_dir: str, name: str, batch: int | None = None) -> DataFrame:
    """The feed as landed in bronze by one load (audit columns added).

    Order items carry a per-row arrival minute after the batch time; the
    other feeds share one timestamp per batch, like a single INSERT.
    """
    ts = F.lit(BATCH_TS[batch]).cast("timestamp_ntz")
    df = FEED_BUILDERS[name](spark, sf_dir, batch)
    if name == "order_items":
        ts = F.timestamp_add("MINUTE", F.col("_arrival_minute"), ts)
    return df.select(*SOURCE_COLUMNS[name], ts.alias("ingestion_timestamp"),
                     F.lit(FIXTURE_SOURCE_SYSTEM).alias("source_system"))
