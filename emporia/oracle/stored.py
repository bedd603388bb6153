"""DuckDB SQL for the stored pipeline: what three runs leave behind and log.

Run 1 loads batch 1, run 2 the whole batch-2 extract incrementally (bronze takes new keys only, so
silver sees those alone), run 3 reloads the extract as a snapshot (dimensions are merged, never
truncated).  All rows of a load carry the batch time, so ties are broken by the raw text alone.
"""

from __future__ import annotations

from emporia.oracle.duckdb_sql import (
    CUSTOMER_REVENUE, DELIVERY_QUALITY, FACT_ORDERS_COLS, FACT_SALES_COLS, ITEM_COLS, PAYMENT_COLS, PRODUCT_PERFORMANCE, SALES_SUMMARY,
    SILVER_COLS, SOURCE_COLS, TS1,
    TS2, base_ctes, bronze_two_loads_sql, dim_merge_sql, fact_two_loads_sql, silver_after_sql, silver_sql, source_sql,
)

FEEDS = ("customers", "orders", "order_items", "products", "payments")
TS3 = "TIMESTAMP '2024-01-03 00:00:00'"
TIMES = {1: TS1, 2: TS2, 3: TS3}
LOADS = {1: "incremental", 2: "incremental", 3: "snapshot"}


def _stamped(rows: str, ts: str) -> str:
    return f"SELECT *, {ts} AS ingestion_timestamp, 'synthetic' AS source_system FROM ({rows})"


def _new_rows(name: str) -> str:
    return f"SELECT {SOURCE_COLS[name]}, ingestion_timestamp, source_system FROM ({bronze_two_loads_sql(name)}) WHERE ingestion_timestamp = {TS2}"


def _loaded(name: str, run: int) -> str:
    """Bronze rows that a run appends."""
    return _new_rows(name) if run == 2 else _stamped(source_sql(name, 1 if run == 1 else 2), TIMES[run])


def _cleaned(name: str, run: int) -> str:
    return silver_sql(name, b=_loaded(name, run))


def _merged(name: str) -> str:
    """Silver after run 2, with merge_action."""
    return silver_after_sql(name, _cleaned(name, 1), _cleaned(name, 2))


def _silver(name: str, run: int) -> str:
    return f"SELECT * EXCLUDE (created_at, updated_at, merge_action) FROM ({_merged(name)})" if run == 2 else _cleaned(name, run)


def _dim(name: str, run: int, with_action: bool = False) -> str:
    first = f"SELECT *, {TS1} AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM ({_cleaned(name, 1)})"
    if run == 1:
        return first.replace("SELECT *,", "SELECT *, 'insert' AS merge_action,", 1) if with_action else first
    changed = f"SELECT * EXCLUDE (created_at, updated_at, merge_action) FROM ({_merged(name)}) WHERE merge_action <> 'keep'"
    got = dim_merge_sql(name, first, changed, at=TS2) if run == 2 else dim_merge_sql(name, _dim(name, 2), _cleaned(name, 3), at=TS3)
    return got if with_action else f"SELECT * EXCLUDE (merge_action) FROM ({got})"


_LOOKED_UP = {"fact_sales": ", dim_customer_id, dim_product_id", "fact_orders": ", dim_customer_id"}


def _fact(name: str, run: int) -> str:
    extra = _LOOKED_UP[name]
    if run == 2:
        return fact_two_loads_sql(name, lambda n: _cleaned(n, 1), _merged, extra)
    table, cols = ("f_sales", FACT_SALES_COLS) if name == "fact_sales" else ("f_orders", FACT_ORDERS_COLS)
    return f"WITH {base_ctes(lambda n: _cleaned(n, run))} SELECT {cols}{extra}, {TIMES[run]} AS created_at FROM {table}"


def _calendar(run: int) -> str:
    return f"WITH {base_ctes(lambda n: _silver(n, run))} SELECT * FROM cal"


def _report(text: str, run: int) -> str:
    """A report over the stored facts.  Facts are only added to: a line that run 1 loaded before its product
    or customer was known keeps its empty key in run 2, until the snapshot."""
    base = f"WITH {base_ctes(lambda n: _silver(n, run))}"
    if run != 2:
        return f"{base} SELECT * FROM ({text})"
    both = {}
    for table, key in (("f_orders", "order_id"), ("f_sales", "order_id, order_item_id")):
        first = f"WITH {base_ctes(lambda n: _cleaned(n, 1))} SELECT * FROM {table}"
        both[table] = (f"SELECT * FROM ({first}) UNION ALL SELECT * FROM ({base} SELECT * FROM {table}) WHERE ({key}) NOT IN "
                       f"(SELECT ({key}) FROM ({first})) AND order_id IN (SELECT order_id FROM ({_merged('orders')}) WHERE merge_action <> 'keep')")
    return f"{base} SELECT * FROM (WITH f_orders AS ({both['f_orders']}), f_sales AS ({both['f_sales']}) {text})"


def _digest(run: int, name: str, rows: str, columns: list[str]) -> str:
    text = ", ".join(f"ifnull(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"""SELECT {run} AS run, '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
  CAST(ifnull(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)), 0) AS DECIMAL(38,0)) AS digest, true AS keys_ok
FROM ({rows})"""


def _split(cols: str) -> list[str]:
    return [c.strip() for c in cols.split(",") if c.strip()]


_AUDIT = ["created_at", "updated_at"]
_CALENDAR = _split("date_key, full_date, year, quarter, month, month_name, week_of_year, day_of_week, day_name, is_weekend")


def _rows_written(run: int) -> list[tuple[str, str]]:
    """(step's table, SQL for the rows that it wrote)."""
    out = [(f"source_{n}", source_sql(n, 1 if run == 1 else 2)) for n in FEEDS]
    out += [(f"bronze_{n}", _loaded(n, run)) for n in FEEDS]
    out += [(f"silver_{n}", f"SELECT 1 FROM ({_merged(n)}) WHERE merge_action <> 'keep'" if run == 2 else _cleaned(n, run)) for n in FEEDS]
    out += [(f"gold_dim_{n}", f"SELECT 1 FROM ({_dim(n, run, True)}) WHERE merge_action <> 'keep'") for n in ("customers", "products")]
    for f in ("fact_sales", "fact_orders"):
        rows = f"SELECT 1 FROM ({_fact(f, 2)}) WHERE created_at = {TS2}" if run == 2 else _fact(f, run)
        out.append((f"gold_{f}", rows))
    return out


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_WRITTEN = _union([f"SELECT {run} AS run, '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows_written FROM ({rows})"
                   for run in TIMES for name, rows in _rows_written(run)])
#: Step of the run, its layer, and the prefix of the tables that it loads; ids count up, six a run.
_STEPS = (("MAIN_PIPELINE", "all", None), ("load_source", "source", "source_"), ("load_bronze", "bronze", "bronze_"),
          ("load_silver", "silver", "silver_"), ("load_gold", "gold", "gold_"))


def _log() -> str:
    parts = []
    for run, ts in TIMES.items():
        first = 6 * (run - 1) + 1
        for i, (name, layer, prefix) in enumerate(_STEPS):
            load = "snapshot" if name == "load_source" else LOADS[run]
            which = f"starts_with(table_name, '{prefix}')" if prefix else "NOT starts_with(table_name, 'source_')"
            parts.append(f"""SELECT '{first + 1 + i:06d}' AS log_id, '{first:06d}' AS run_id, '{name}' AS pipeline_name, '{layer}' AS layer,
  '{load}' AS load_type, 'SUCCESS' AS status, CAST(sum(rows_written) AS BIGINT) AS rows_processed, {ts} AS start_time, {ts} AS end_time,
  CAST(0 AS BIGINT) AS duration_seconds, CAST(NULL AS VARCHAR) AS error_message FROM written WHERE run = {run} AND {which}""")
    return _union(parts)


def stored_sql() -> dict[str, str]:
    log = f"WITH written AS ({_WRITTEN}), steps AS ({_log()})\nSELECT"
    q = {
        "ctl_rows_by_table": _WRITTEN,
        "ctl_run_log": f"{log} * FROM steps",
        # The runs' steps begin one after the other: the newest ten are those of the last two runs.
        "ctl_last_runs": f"{log} * FROM steps ORDER BY log_id DESC LIMIT 10",
        "run_pipeline": f"{log} run_id, load_type, status, rows_processed, start_time, end_time, duration_seconds FROM steps "
                        "WHERE pipeline_name = 'MAIN_PIPELINE'",
        "ctl_run_rows_total": f"{log} run_id, CAST(sum(rows_processed) AS BIGINT) AS rows_processed FROM steps "
                              "WHERE pipeline_name IN ('load_bronze', 'load_silver', 'load_gold') GROUP BY run_id",
    }
    parts = []
    for run in TIMES:
        for n in ("customers", "products"):
            parts.append(_digest(run, f"dim_{n}", _dim(n, run), [*SILVER_COLS[n], *_AUDIT]))
        parts.append(_digest(run, "dim_date", _calendar(run), _CALENDAR))
        for f, cols in (("fact_sales", FACT_SALES_COLS), ("fact_orders", FACT_ORDERS_COLS)):
            parts.append(_digest(run, f, _fact(f, run), [*_split(cols), *_split(_LOOKED_UP[f]), "created_at"]))
        for name, text in (("sales_summary", SALES_SUMMARY), ("product_performance", PRODUCT_PERFORMANCE),
                           ("customer_revenue", CUSTOMER_REVENUE), ("delivery_quality", DELIVERY_QUALITY)):
            parts.append(_digest(run, name, _report(text, run), _REPORT_COLUMNS[name]))
    q["gold_store_digests"] = _union(parts)
    names = {"customers": "customers_clean", "orders": "orders_clean", "order_items": "order_items_clean", "products": "products_clean",
             "payments": "payments_clean"}
    columns = {**SILVER_COLS, "order_items": ITEM_COLS, "payments": PAYMENT_COLS}
    whole = lambda n, run: (f"SELECT * EXCLUDE (merge_action) FROM ({_merged(n)})" if run == 2 else
                            f"SELECT *, {TIMES[run]} AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM ({_cleaned(n, run)})")
    q["silver_store_digests"] = _union([
        f"SELECT * EXCLUDE (keys_ok) FROM ({_digest(run, names[n], whole(n, run), [*columns[n], *_AUDIT])})" for run in TIMES for n in FEEDS])
    for n in FEEDS:
        q[f"silver_increment_{n}"] = _cleaned(n, 2)
    q["gold_views_from_store"] = _union([
        f"SELECT '{name}' AS view_name, CAST(count(*) AS BIGINT) AS row_count FROM ({_report(text, 3)})"
        for name, text in (("sales_summary", SALES_SUMMARY), ("product_performance", PRODUCT_PERFORMANCE),
                           ("customer_revenue", CUSTOMER_REVENUE), ("delivery_quality", DELIVERY_QUALITY))])
    return q


_REPORT_COLUMNS = {
    "sales_summary": _split(
        "order_year, order_month, order_quarter, month_name, year_month, total_orders, total_items_sold, total_revenue, total_freight, "
        "avg_order_value, total_payment_collected, delivered_orders, canceled_in_transit, canceled_but_reached, late_deliveries, late_delivery_rate_pct"),
    "product_performance": _split(
        "product_id, product_category_name, is_missing_category, total_orders, total_revenue, avg_price, units_sold, free_shipping_orders, "
        "late_deliveries, revenue_rank"),
    "customer_revenue": _split(
        "customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code_prefix, total_orders, lifetime_revenue, avg_order_value, "
        "first_order_date, last_order_date, customer_lifespan_days, late_delivery_count, inconsistent_delivery_count, canceled_in_transit_count, "
        "canceled_but_reached_count, customer_type"),
    "delivery_quality": _split(
        "order_year, order_month, total_orders, status_delivered, clean_delivered, delivery_inconsistent, invalid_date_sequence, canceled_in_transit, "
        "canceled_but_reached, late_deliveries, late_delivery_rate_pct"),
}
