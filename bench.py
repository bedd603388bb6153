"""Benchmark: the warehouse pipeline and the report views at one scale factor.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints ONE JSON line::

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Timed steps (feeds are staged as CSV first, untimed):
* ``pipeline_first_load``   - CSV -> source -> bronze -> silver -> gold, batch 1;
* ``pipeline_incremental``  - the batch-2 extract (new keys appended/merged);
* ``pipeline_snapshot``     - full reload of every layer (dimensions merged);
* ``view_*``                - the four report views over the stored gold tables
                              (best of 3 after a warm-up);
* ``e2e_*``                 - one lazy plan from the given tables to the result.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _timed(fn):
    t = time.time()
    out = fn()
    return time.time() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from emporia.operators.control import new_id
    from emporia.plans import catalog as C
    from emporia.plans import reports as R
    from emporia.plans.pipeline import Pipeline
    from emporia.session import get_session, scratch_path
    from emporia.sources import derived_feed as feed
    from emporia.sources.csv_feed import read_feed, write_feed

    spark = get_session(f"local[{cpus}]", "emporia-bench",
                        **{"spark.sql.shuffle.partitions": str(max(cpus * 4, 8)),
                           "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "emporia-bench", new_id())
    for b in (1, 2):
        for n in feed.FEED_BUILDERS:
            write_feed(feed.source_feed(spark, sf_dir, n, b), f"{base}/feeds/b{b}/{n}", n)

    state = {"batch": 1}
    p = Pipeline(spark, f"{base}/warehouse",
                 lambda n: read_feed(spark, f"{base}/feeds/b{state['batch']}/{n}", n))
    q: dict[str, float] = {}
    q["pipeline_first_load"], r1 = _timed(lambda: p.run("incremental", dt.datetime(2024, 1, 1)))
    state["batch"] = 2
    q["pipeline_incremental"], r2 = _timed(lambda: p.run("incremental", dt.datetime(2024, 1, 2)))
    q["pipeline_snapshot"], r3 = _timed(lambda: p.run("snapshot", dt.datetime(2024, 1, 3)))

    fs, fo = p.gold("fact_sales"), p.gold("fact_orders")
    views = {
        "view_sales_summary": lambda: R.sales_summary(fs, p.gold("dim_date"), fo),
        "view_product_performance": lambda: R.product_performance(fs, p.gold("dim_products"), fo),
        "view_customer_revenue": lambda: R.customer_revenue(fo, p.gold("dim_customers")),
        "view_delivery_quality": lambda: R.delivery_quality(fo),
    }
    rows: dict[str, int] = {}
    for name, build in views.items():
        build().collect()  # warm-up
        best = None
        for _ in range(3):
            t, res = _timed(lambda: build().collect())
            best = t if best is None else min(best, t)
            rows[name] = len(res)
        q[name] = best

    # End-to-end lazy plans from the given tables; executed into a no-op sink so the
    # time is Spark's work, not the transfer of large results into Python.
    for name in ("sales_summary", "product_performance", "delivery_quality", "silver_order_items"):
        t, _ = _timed(lambda: C.registry()[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        q[f"e2e_{name}"] = t

    total = sum(q.values())
    out = {
        "metric": "total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "rows": rows,
        "pipeline_rows": {"first_load": r1.total_rows, "incremental": r2.total_rows, "snapshot": r3.total_rows},
        "source_rows_per_sec_snapshot": round(sum(v for k, v in r3.rows.items() if k.startswith("source_"))
                                              / max(q["pipeline_snapshot"], 1e-9), 1),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
