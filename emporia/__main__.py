"""Command line: ``python -m emporia FEEDS WAREHOUSE [--load incremental|snapshot] [--layer L [--module M]] [--sql TEXT]``.

FEEDS holds one folder of delimited files per feed, WAREHOUSE is the tables' root; both may lie on any
file system that Spark reads.  Without --layer the whole pipeline runs; --sql then prints a query over
the stored tables (``gold_sales_summary``, ``control_pipeline_log``, ...).
"""

from __future__ import annotations

import argparse
import sys

from emporia.plans.pipeline import Pipeline
from emporia.schemas import LOAD_INCREMENTAL, LOAD_SNAPSHOT
from emporia.session import get_session
from emporia.sources.csv_feed import read_feed


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(prog="emporia", description="Load the warehouse from delimited feeds.")
    a.add_argument("feeds")
    a.add_argument("warehouse")
    a.add_argument("--load", choices=(LOAD_INCREMENTAL, LOAD_SNAPSHOT), default=LOAD_INCREMENTAL)
    a.add_argument("--layer", choices=("source", "bronze", "silver", "gold"))
    a.add_argument("--module", help="one table of the layer")
    a.add_argument("--sql", help="query to print afterwards")
    o = a.parse_args(argv)
    if o.module and not o.layer:
        a.error("--module needs --layer")
    spark = get_session()
    p = Pipeline(spark, o.warehouse, lambda n: read_feed(spark, f"{o.feeds.rstrip('/')}/{n}", n))
    if o.module:
        print(f"{o.layer}.{o.module}: {p.run_module(o.layer, o.module, o.load)} rows")
    elif o.layer:
        print(f"{o.layer}: {p.run_layer(o.layer, o.load).total_rows} rows")
    else:
        print(f"all layers: {p.run(o.load).total_rows} rows")
    if o.sql:
        p.create_views()
        spark.sql(o.sql).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
