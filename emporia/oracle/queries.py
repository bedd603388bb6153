"""Per-key oracle SQL (DuckDB dialect) for the query catalog."""

from __future__ import annotations

from emporia.oracle.duckdb_sql import (
    CUSTOMER_REVENUE, DELIVERY_QUALITY, FACT_ORDERS_COLS, FACT_SALES_COLS, PRODUCT_PERFORMANCE, SALES_SUMMARY,
    TS1, TS2, _cnt, _dec, _int, _nz, _rate, _ts, bronze_sql, bronze_two_loads_sql, calendar_from_orders_sql, calendar_sql, dim_merge_sql,
    fact_two_loads_sql, silver_after_sql, silver_merge_sql, silver_sql, source_sql, with_base,
)

from emporia.oracle.stored import stored_sql
from emporia.schemas import SOURCE_COLUMNS, SOURCE_KINDS

FEEDS = ("customers", "orders", "order_items", "products", "payments")
SILVER_NAMES = {"customers": "customers_clean", "orders": "orders_clean", "order_items": "order_items_clean",
                "products": "products_clean", "payments": "payments_clean"}


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _orders_flag(expr):
    return f"SELECT trim(order_id) AS order_id, {expr} AS flag FROM ({bronze_sql('orders')})"


def _st():
    return "upper(trim(order_status))"


def _dq():
    st = _st()
    carr, cust = _nz("order_delivered_carrier_date"), _nz("order_delivered_customer_date")
    p, a = _ts("order_purchase_timestamp"), _ts("order_approved_at")
    c, d, e = _ts("order_delivered_carrier_date"), _ts("order_delivered_customer_date"), _ts(
        "order_estimated_delivery_date")
    q = {
        "dq_delivery_inconsistent": _orders_flag(
            f"CASE WHEN {st} = 'DELIVERED' AND {cust} IS NULL THEN 1 ELSE 0 END"),
        "dq_shipped_missing": _orders_flag(
            f"CASE WHEN {st} IN ('SHIPPED', 'DELIVERED') AND {carr} IS NULL THEN 1 ELSE 0 END"),
        "dq_canceled_in_transit": _orders_flag(
            f"CASE WHEN {st} IN ('CANCELED', 'UNAVAILABLE') AND {carr} IS NOT NULL AND {cust} IS NULL "
            f"THEN 1 ELSE 0 END"),
        "dq_canceled_but_reached": _orders_flag(
            f"CASE WHEN {st} IN ('CANCELED', 'UNAVAILABLE') AND {carr} IS NOT NULL AND {cust} IS NOT NULL "
            f"THEN 1 ELSE 0 END"),
        "dq_invalid_date_sequence": _orders_flag(
            f"CASE WHEN {a} < {p} OR {c} < {a} OR {d} < {c} THEN 1 ELSE 0 END"),
        "dq_late_delivery": _orders_flag(f"CASE WHEN {d} > {e} THEN 1 ELSE 0 END"),
        "dq_free_shipping": (
            f"SELECT trim(order_id) AS order_id, trim(order_item_id) AS order_item_id, "
            f"CASE WHEN trim(freight_value) IN ('0', '0.0') THEN 1 ELSE 0 END AS flag "
            f"FROM ({bronze_sql('order_items')})"),
        "dq_missing_category": (
            f"SELECT trim(product_id) AS product_id, CASE WHEN {_nz('product_category_name')} IS NULL "
            f"THEN 1 ELSE 0 END AS flag FROM ({bronze_sql('products')})"),
        "dq_missing_dimensions": (
            f"SELECT trim(product_id) AS product_id, CASE WHEN {_nz('product_weight_g')} IS NULL "
            f"THEN 1 ELSE 0 END AS flag FROM ({bronze_sql('products')})"),
        "dq_payment_not_defined": (
            f"SELECT trim(order_id) AS order_id, trim(payment_sequential) AS payment_sequential, "
            f"CASE WHEN lower(trim(payment_type)) = 'not_defined' THEN 1 ELSE 0 END AS flag "
            f"FROM ({bronze_sql('payments')})"),
        "dq_payment_zero_value": (
            f"SELECT trim(order_id) AS order_id, trim(payment_sequential) AS payment_sequential, "
            f"CASE WHEN {_dec('payment_value')} = 0 THEN 1 ELSE 0 END AS flag FROM ({bronze_sql('payments')})"),
    }

    def metrics(feed, pairs):
        return _union([f"SELECT '{feed}' AS feed, '{m}' AS metric, CAST({expr} AS BIGINT) AS value "
                       f"FROM ({bronze_sql(feed)})" for m, expr in pairs])

    q["dq_profile"] = _union([
        metrics("orders", [
            ("rows", "count(*)"),
            ("purchase_unparsable", f"count(*) FILTER (WHERE {p} IS NULL)"),
            ("approved_missing", f"count(*) FILTER (WHERE {_nz('order_approved_at')} IS NULL)"),
            ("carrier_missing", f"count(*) FILTER (WHERE {carr} IS NULL)"),
            ("customer_date_missing", f"count(*) FILTER (WHERE {cust} IS NULL)"),
            ("date_order_violations", f"count(*) FILTER (WHERE {a} < {p} OR {c} < {a} OR {d} < {c})"),
        ]),
        metrics("order_items", [
            ("rows", "count(*)"),
            ("price_unparsable", f"count(*) FILTER (WHERE {_dec('price')} IS NULL)"),
            ("freight_missing", f"count(*) FILTER (WHERE {_nz('freight_value')} IS NULL)"),
            ("zero_freight", f"count(*) FILTER (WHERE {_dec('freight_value')} = 0)"),
        ]),
        metrics("products", [
            ("rows", "count(*)"),
            ("category_missing", f"count(*) FILTER (WHERE {_nz('product_category_name')} IS NULL)"),
            ("weight_missing", f"count(*) FILTER (WHERE {_nz('product_weight_g')} IS NULL)"),
        ]),
        metrics("payments", [
            ("rows", "count(*)"),
            ("type_not_defined", "count(*) FILTER (WHERE lower(trim(payment_type)) = 'not_defined')"),
            ("value_missing", f"count(*) FILTER (WHERE {_nz('payment_value')} IS NULL)"),
            ("zero_value", f"count(*) FILTER (WHERE {_dec('payment_value')} = 0)"),
            ("installments_missing", f"count(*) FILTER (WHERE {_nz('payment_installments')} IS NULL)"),
        ]),
    ])
    return q


def _count_rows(pairs, label="table_name"):
    return _union([f"SELECT '{name}' AS {label}, CAST(count(*) AS BIGINT) AS row_count FROM {src}"
                   for name, src in pairs])


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for n in FEEDS:
        q[f"src_{n}"] = source_sql(n)
    q["src_load_counts"] = _count_rows([(n, f"({source_sql(n)})") for n in FEEDS], "feed")
    for n in FEEDS:
        q[f"bronze_{n}"] = bronze_two_loads_sql(n)
    q["bronze_load_counts"] = _union([
        f"SELECT '{n}' AS feed, ingestion_timestamp AS load_ts, CAST(count(*) AS BIGINT) AS rows_appended "
        f"FROM ({bronze_two_loads_sql(n)}) GROUP BY ingestion_timestamp" for n in FEEDS])
    for n in FEEDS:
        q[f"silver_{n}"] = silver_sql(n)
    kinds = {"int": _int, "decimal": _dec, "time": _ts}
    q["dq_profile_columns"] = _union([
        f"SELECT '{n}' AS feed, '{c}' AS column_name, {_cnt('true')} AS rows, {_cnt(f'{c} IS NULL')} AS nulls, "
        f"""{_cnt(f"trim({c}) = ''")} AS blanks, """
        + (f"{_cnt(f'{_nz(c)} IS NOT NULL AND {kinds[SOURCE_KINDS[n][c]](c)} IS NULL')}" if c in SOURCE_KINDS[n] else "CAST(0 AS BIGINT)")
        + f" AS unparsable FROM ({source_sql(n)})" for n in FEEDS for c in SOURCE_COLUMNS[n]])
    # As staged: an empty field reads as NULL, and the cities hold a comma and quotes.
    empty = lambda n: ", ".join(f"nullif({c}, '') AS {c}" for c in SOURCE_COLUMNS[n])
    for n in FEEDS:
        q[f"csv_{n}"] = f"SELECT {empty(n)} FROM ({source_sql(n)})"
    q["csv_customers"] = q["csv_customers"].replace(
        "nullif(customer_city, '')", "customer_city || ', \"' || customer_state || '\"'")
    q["csv_rejects"] = _union([f"SELECT '{n}' AS feed, '{why}' AS reason, count(*) AS rows FROM ({source_sql(n)}) "
                               f"WHERE ends_with(trim({SOURCE_COLUMNS[n][0]}), '77') HAVING count(*) > 0" for n in FEEDS for why in ("short", "long")])
    q["silver_upsert"] = silver_merge_sql("customers")
    for n in FEEDS:
        if n != "customers":
            q[f"silver_upsert_{n}"] = silver_after_sql(n)
        q[f"gold_incremental_filter_{n}"] = (
            f"SELECT * EXCLUDE (merge_action) FROM ({silver_after_sql(n)}) WHERE merge_action <> 'keep'")
    q["silver_load_counts"] = _count_rows([(SILVER_NAMES[n], f"({silver_sql(n)})") for n in FEEDS])
    q.update(_dq())
    q["dim_customers"] = dim_merge_sql("customers")
    q["dim_products"] = dim_merge_sql("products")
    q["dim_date"] = calendar_from_orders_sql()
    q["fact_sales"] = with_base(f"SELECT {FACT_SALES_COLS} FROM f_sales")
    q["fact_orders"] = with_base(f"SELECT {FACT_ORDERS_COLS} FROM f_orders")
    q["surrogate_keys"] = _union([
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST(count(*) AS BIGINT) AS distinct_keys, CAST(CASE WHEN count(*) > 0 THEN 1 END AS BIGINT) AS min_key, "
        f"CAST(CASE WHEN count(*) > 0 THEN count(*) END AS BIGINT) AS max_key FROM ({src})"
        for name, src in (("dim_customers", silver_sql("customers")), ("dim_products", silver_sql("products")),
                          ("dim_customers_two_loads", dim_merge_sql("customers")),
                          ("dim_products_two_loads", dim_merge_sql("products")))])
    q["gold_incremental_filter"] = (
        f"SELECT customer_id, customer_city, created_at, updated_at FROM ({silver_merge_sql('customers')}) "
        f"WHERE updated_at > {TS1} OR (updated_at IS NULL AND created_at > {TS1})")
    q["first_payment_per_order"] = with_base("SELECT order_id, payment_value, payment_type, payment_installments "
                                             "FROM first_pay")
    q["date_key_lookup"] = (
        f"SELECT o.order_id, cal.date_key FROM ({silver_sql('orders')}) o LEFT JOIN "
        f"({calendar_sql('1996-01-01', '2001-01-01')}) cal "
        f"ON cal.date_key = CAST(strftime(CAST(o.order_purchase_timestamp AS DATE), '%Y%m%d') AS INTEGER)")
    q["order_item_totals"] = (
        f"SELECT order_id, CAST(sum(total_item_value) AS DECIMAL(38,2)) AS total_order_value, "
        f"CAST(count(*) AS INTEGER) AS item_count FROM ({silver_sql('order_items')}) GROUP BY order_id")
    q["order_payment_totals"] = (
        f"SELECT order_id, CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_payment_value "
        f"FROM ({silver_sql('payments')}) GROUP BY order_id")
    q["gold_load_counts"] = with_base(_count_rows([
        ("dim_customers", "s_customers"), ("dim_products", "s_products"),
        ("fact_sales", "f_sales"), ("fact_orders", "f_orders")]))
    q["sales_summary"] = with_base(SALES_SUMMARY)
    q["product_performance"] = with_base(PRODUCT_PERFORMANCE)
    q["customer_revenue"] = with_base(CUSTOMER_REVENUE)
    q["delivery_quality"] = with_base(DELIVERY_QUALITY)
    q["ctl_reconcile_counts"] = with_base(f"""SELECT a.table_name, a.row_count AS actual_rows,
  e.row_count AS expected_rows, a.row_count = e.row_count AS matches
FROM ({_count_rows([("dim_customers", "s_customers"), ("dim_products", "s_products"), ("dim_date", "cal"),
                    ("fact_sales", "f_sales"), ("fact_orders", "f_orders")])}) a
JOIN ({_count_rows([("dim_customers", "s_customers"), ("dim_products", "s_products"), ("dim_date", "cal"),
                    ("fact_sales", "(SELECT * FROM s_items i WHERE EXISTS "
                                   "(SELECT 1 FROM s_orders o WHERE o.order_id = i.order_id))"),
                    ("fact_orders", "s_orders")])}) e ON a.table_name = e.table_name""")
    ins, upd = _cnt("merge_action = 'insert'"), _cnt("merge_action = 'update'")
    q["ctl_rows_affected"] = _union([
        f"SELECT '{name}' AS table_name, {ins} AS rows_inserted, {upd} AS rows_updated, "
        f"{ins} + {upd} AS rows_out FROM ({src})"
        for name, src in (("silver_customers", silver_merge_sql("customers")),
                          ("silver_products", silver_merge_sql("products")),
                          ("gold_dim_customers", dim_merge_sql("customers")),
                          ("gold_dim_products", dim_merge_sql("products")))])
    for n in ("fact_sales", "fact_orders"):
        q[f"{n}_two_loads"] = fact_two_loads_sql(n)
    merged = [(f"silver_{n}", silver_after_sql(n)) for n in FEEDS]
    merged += [(f"gold_dim_{n}", dim_merge_sql(n)) for n in ("customers", "products")]
    appended = [(f"bronze_{n}", "ingestion_timestamp", bronze_two_loads_sql(n)) for n in FEEDS]
    appended += [(f"gold_{n}", "created_at", fact_two_loads_sql(n)) for n in ("fact_sales", "fact_orders")]
    merged += [(n, f"SELECT if({c} = {TS2}, 'insert', 'keep') AS merge_action FROM ({src})") for n, c, src in appended]
    q["ctl_rows_affected_all"] = _union([
        f"SELECT '{name}' AS table_name, {ins} AS rows_inserted, {upd} AS rows_updated, "
        f"{ins} + {upd} AS rows_out FROM ({src})" for name, src in merged])
    q.update(stored_sql())
    # ---- dashboards ----
    q["dash_monthly_revenue"] = with_base(
        f"SELECT year_month, order_year, order_month, total_orders, total_revenue FROM ({SALES_SUMMARY})")
    q["dash_payment_split"] = with_base(f"""SELECT payment_type, orders, payment_value,
  {_rate('CAST(payment_value * 100 AS BIGINT)', 'sum(CAST(payment_value * 100 AS BIGINT)) OVER ()')}
    AS value_share_pct
FROM (SELECT payment_type, CAST(count(*) AS BIGINT) AS orders, CAST(sum(payment_value) AS DECIMAL(38,2))
        AS payment_value
      FROM (SELECT DISTINCT order_id, payment_type, payment_value FROM f_sales) GROUP BY payment_type)""")
    q["dash_top_products"] = with_base(
        f"SELECT revenue_rank, product_id, product_category_name, total_revenue, units_sold "
        f"FROM ({PRODUCT_PERFORMANCE}) WHERE revenue_rank <= 10")
    q["dash_category_revenue"] = with_base("""SELECT dp.product_category_name,
  CAST(sum(fs.total_item_value) AS DECIMAL(38,2)) AS total_revenue, CAST(count(*) AS BIGINT) AS units_sold,
  CAST(count(DISTINCT dp.product_id) AS BIGINT) AS products
FROM f_sales fs JOIN s_products dp ON fs.dim_product_id = dp.product_id GROUP BY dp.product_category_name""")
    q["dash_free_shipping"] = with_base("""SELECT is_free_shipping, CAST(count(*) AS BIGINT) AS items,
  CAST(sum(total_item_value) AS DECIMAL(38,2)) AS total_revenue,
  CAST(sum(freight_value) AS DECIMAL(38,2)) AS total_freight FROM f_sales GROUP BY is_free_shipping""")
    q["dash_customer_ltv"] = with_base(
        f"SELECT customer_id, customer_state, total_orders, lifetime_revenue, avg_order_value, customer_type "
        f"FROM ({CUSTOMER_REVENUE})")
    q["dash_repeat_customers"] = with_base(
        f"SELECT customer_type, CAST(count(*) AS BIGINT) AS customers, CAST(sum(total_orders) AS BIGINT) AS orders, "
        f"CAST(sum(lifetime_revenue) AS DECIMAL(38,2)) AS revenue FROM ({CUSTOMER_REVENUE}) GROUP BY customer_type")
    q["dash_revenue_by_state"] = with_base("""SELECT dc.customer_state, CAST(count(*) AS BIGINT) AS orders,
  CAST(sum(fo.total_order_value) AS DECIMAL(38,2)) AS revenue,
  CAST(count(DISTINCT dc.customer_id) AS BIGINT) AS customers
FROM f_orders fo JOIN s_customers dc ON fo.dim_customer_id = dc.customer_id GROUP BY dc.customer_state""")
    q["dash_late_rate"] = with_base(
        f"SELECT order_year, order_month, clean_delivered, late_deliveries, late_delivery_rate_pct "
        f"FROM ({DELIVERY_QUALITY})")
    q["dash_dq_by_month"] = with_base(_union([
        f"SELECT order_year, order_month, '{f}' AS flag_name, {f} AS flag_count FROM ({DELIVERY_QUALITY})"
        for f in ("delivery_inconsistent", "invalid_date_sequence", "canceled_in_transit", "canceled_but_reached",
                  "late_deliveries")]))
    q["dash_cancellations"] = with_base(f"""SELECT order_year, order_month,
  {_cnt("order_status = 'CANCELED'")} AS canceled, {_cnt("order_status = 'UNAVAILABLE'")} AS unavailable,
  {_cnt('is_canceled_in_transit = 1')} AS canceled_in_transit,
  {_cnt('is_canceled_but_reached = 1')} AS canceled_but_reached
FROM f_orders GROUP BY order_year, order_month""")
    return q


__all__ = ["oracle_sql", "_int"]
