"""The persisted, incremental pipeline: CSV -> source -> bronze -> silver -> gold.

Stages run in the reference's order (OP-C08); every layer module returns
the rows it inserted (+ updated for merges) as counted by an ``Observation``
on the written DataFrame (no re-scan; OP-C09), logs RUNNING then
SUCCESS/FAILED events (OP-C03), and advances its watermark to the batch
time captured at the start of the run (OP-C02).

Fault tolerance: each layer reads its inputs from tables written by the
previous layer (lineage is cut at every layer), rewrites go to a new table
version that becomes visible only after its commit, and every operator is
deterministic (total tie-breaks, hash-bucketed keys), so a task recomputed
after an executor loss produces the same rows.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporia.operators import bronze as B
from emporia.operators import gold as G
from emporia.operators.control import Control, new_id
from emporia.operators.digest import digest, key_is_dense
from emporia.operators.key_index import KeyIndex
from emporia.operators.merge import ACTION, insert_all, merge
from emporia.operators.silver import CLEANERS, since_date
from emporia.plans import reports as R
from emporia.schemas import (
    BRONZE_KEYS, DEFAULT_SOURCE_SYSTEM, FEEDS, LOAD_INCREMENTAL, LOAD_SNAPSHOT, RUN_BRONZE, RUN_GOLD, RUN_MAIN, RUN_SILVER,
    RUN_SOURCE, SILVER_SPECS,
)
from emporia.session import released_shuffles
from emporia.sources.store import BATCH, BUCKET, GEN, TableStore, bucket_of, stamp

SNAPSHOT = LOAD_SNAPSHOT
BRONZE_PARTITION = "ingestion_date"
FACT_PARTITION = ["order_year"]
SCRATCH = "scratch"
#: Hash buckets of the upserted tables: a merge rewrites those that its keys touch.  Choose it once, so that
#: a bucket of the grown table holds some 100 MB to 1 GB.
KEY_BUCKETS = 16


@dataclass
class RunResult:
    run_id: str
    load_type: str
    batch_ts: dt.datetime
    rows: dict[str, int] = field(default_factory=dict)
    total_rows: int = 0
    seconds: float = 0.0


def _now() -> dt.datetime:
    return dt.datetime.now()


def _write_counted(df: DataFrame, write: Callable[[DataFrame], object], by: list[str] | None = None,
                   action_col: bool = False) -> dict[str, int]:
    """Write ``df``, gathered by ``by``, and return its row counts, observed during the write itself."""
    obs = Observation(f"rows_{new_id()}")
    if by:  # below the observation: adaptive execution takes out an empty exchange with all that stands under it
        df = TableStore.gathered(df, by)
    if action_col:
        observed = df.observe(obs, F.count_if(F.col(ACTION) == "insert").alias("inserted"),
                              F.count_if(F.col(ACTION) == "update").alias("updated"))
        write(observed.drop(ACTION))
    else:
        observed = df.observe(obs, F.count(F.lit(1)).alias("inserted"))
        write(observed)
    got = obs.get
    return {"inserted": int(got.get("inserted") or 0), "updated": int(got.get("updated") or 0)}


def append_new(store: TableStore, source: DataFrame, name: str, batch_ts: dt.datetime, load_type: str,
               source_system: str = DEFAULT_SOURCE_SYSTEM, batch: str | None = None) -> int:
    """Append the rows of ``source`` whose key bronze lacks, as one batch; returns their number.

    A snapshot (or the first load) starts the table anew.  The batch's name is its time unless given;
    the same batch again replaces its earlier rows.  Known keys are told by the persisted key index,
    so the history itself is not read.
    """
    batch = batch or stamp(batch_ts)
    index = KeyIndex(store, name, BRONZE_KEYS[name])
    existing = None if load_type == SNAPSHOT else store.read("bronze", name)
    if existing is None:
        rows = source
    else:
        index.catch_up(existing)
        if batch in store.batches("bronze", name):  # a replay: what it wrote before is no history
            index.forget(batch)
        rows = index.new_rows(source)
    rows = B.stamp(rows, name, batch_ts, source_system).withColumn(BRONZE_PARTITION, F.to_date("ingestion_timestamp"))
    if existing is None:
        # One batch is one partition: the tasks that read the source write a file each, and no row moves.
        rows = rows.withColumn(BATCH, F.lit(batch))
        c = _write_counted(rows, lambda d: store.write_version("bronze", name, d, [BRONZE_PARTITION, BATCH]))
        index.restart()
    else:
        c = _write_counted(rows, lambda d: store.append_batch("bronze", name, d, batch, [BRONZE_PARTITION]),
                           [BRONZE_PARTITION])
    if batch in store.batches("bronze", name):
        index.add(store.read("bronze", name).where(F.col(BATCH) == batch), batch)
    return c["inserted"]


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, feed_reader: Callable[[str], DataFrame],
                 calendar: tuple[dt.date, dt.date] | None = None,
                 source_system: str = DEFAULT_SOURCE_SYSTEM,
                 clock: Callable[[], dt.datetime] = _now, parallel_tables: int = 5,
                 keep_versions: int = 2, key_buckets: int = KEY_BUCKETS, ids: Callable[[], str] = new_id) -> None:
        """``calendar``: fixed first and last day; without it the calendar covers the whole years of the order dates.

        ``clock`` gives every time in logs, watermarks and batches, ``ids`` the run and step names; with both
        given, what a run writes depends on its input alone.
        """
        self.spark = spark
        self.store = TableStore(spark, root)
        self.control = Control(spark, self.store, clock)
        self.ids = ids
        self.feed_reader = feed_reader
        self.calendar = calendar
        self.source_system = source_system
        self.clock = clock
        self.parallel_tables = parallel_tables
        self.keep_versions = keep_versions
        self.key_buckets = key_buckets
        self._watermarks: dict[str, dt.datetime | None] | None = None

    def _watermark(self, name: str) -> dt.datetime | None:
        """Watermark as of the start of the current layer step (one read per step)."""
        if self._watermarks is not None:
            return self._watermarks.get(name)
        return self.control.read_watermark(name)

    # ---- logging helper ---------------------------------------------------
    def _step(self, run_id: str, name: str, layer: str, load_type: str, fn: Callable[[], int]) -> int:
        log_id, start = self.ids(), self.clock()
        self.control.log_event(run_id, log_id, name, layer, load_type, "RUNNING", start)
        try:
            # Each layer advances only its own watermarks, so a snapshot taken here stays valid.
            self._watermarks = self.control.current_watermarks()
            with released_shuffles(self.spark):
                rows = fn()
        except Exception as e:
            self.control.log_event(run_id, log_id, name, layer, load_type, "FAILED", start, self.clock(),
                                   error=str(e))
            self.control.flush()
            raise
        finally:
            self._watermarks = None
        self.control.log_event(run_id, log_id, name, layer, load_type, "SUCCESS", start, self.clock(), rows=rows)
        self.control.flush()
        return rows

    def _each(self, result: RunResult, prefix: str, names, fn: Callable[[str], int]) -> int:
        """Load independent tables of one layer as concurrent Spark jobs."""
        with ThreadPoolExecutor(max_workers=self.parallel_tables) as pool:
            counts = dict(zip(names, pool.map(fn, names)))
        for n, c in counts.items():
            result.rows[f"{prefix}{n}"] = c
        return sum(counts.values())

    # ---- stage 0: source (always snapshot) --------------------------------
    def load_source_table(self, name: str) -> int:
        self._make_room("source", name)
        c = _write_counted(self.feed_reader(name), lambda d: self.store.write_version("source", name, d))
        self._retire("source", name)
        return c["inserted"]

    def load_source(self, result: RunResult) -> int:
        return self._each(result, "source_", FEEDS, self.load_source_table)

    # ---- stage 1: bronze --------------------------------------------------
    def load_bronze_table(self, name: str, load_type: str, batch_ts: dt.datetime) -> int:
        self._make_room("bronze", name)
        source = self.store.read("source", name)
        c = append_new(self.store, source, name, batch_ts, load_type, self.source_system)
        self._retire("bronze", name)
        self.control.advance_watermark(f"bronze_{name}", batch_ts, self.clock())
        return c

    def load_bronze(self, result: RunResult, load_type: str, batch_ts: dt.datetime) -> int:
        return self._each(result, "bronze_", FEEDS, lambda n: self.load_bronze_table(n, load_type, batch_ts))

    # ---- stage 2: silver --------------------------------------------------
    def load_silver_table(self, name: str, load_type: str, batch_ts: dt.datetime) -> int:
        spec = SILVER_SPECS[name]
        fresh = load_type == SNAPSHOT or not self.store.exists("silver", spec.name)
        # A missing table means "no watermark" (a dropped table is fully reloaded).
        wm = None if fresh else self._watermark(spec.watermark)
        # Partition pruning on the ingestion date, then (in the cleaner) the exact timestamp test.
        bronze = since_date(self.store.read("bronze", name), wm)
        changes = CLEANERS[name](bronze.drop(BRONZE_PARTITION, BATCH), wm)
        cols, keys = list(spec.columns), list(spec.keys)
        c = self._upsert("silver", spec.name, keys[0], changes, batch_ts, fresh, insert_all(changes, cols, batch_ts),
                         lambda t, ch: merge(t, ch, keys, cols, list(spec.update_columns), batch_ts))
        self.control.advance_watermark(spec.watermark, batch_ts, self.clock())
        return c["inserted"] + c["updated"]

    def _upsert(self, layer: str, table: str, key: str, changes: DataFrame, batch_ts: dt.datetime, fresh: bool,
                anew: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[str, int]:
        """Write a table anew, or merge ``changes`` into the buckets that their keys touch; the other buckets' files stay.

        The rows come placed by key, from the dedup or the join, and are written where they lie: a task's share, bounded
        by adaptive execution, goes to a file a bucket.  Gathering them by bucket would move the whole table once more.
        """
        self._make_room(layer, table)
        if fresh:
            out = anew
        else:
            # One number a bucket at most goes to the driver.
            touched = sorted(r[0] for r in changes.select(bucket_of(key, self.key_buckets).alias(BUCKET)).distinct().collect())
            if not touched:
                return {"inserted": 0, "updated": 0}
            out = merged(self.store.read(layer, table, touched).drop(BUCKET, GEN), changes)
        out = out.withColumn(BUCKET, bucket_of(key, self.key_buckets))
        c = _write_counted(out, lambda d: self.store.write_buckets(layer, table, d, stamp(batch_ts), new_version=fresh),
                           action_col=True)
        self._retire(layer, table)
        return c

    def _rows(self, layer: str, table: str, since: dt.datetime | None = None) -> DataFrame | None:
        """An upsert table without the store's columns; ``since`` prunes buckets not rewritten after that time."""
        df = self.store.read(layer, table)
        if df is None:
            return None
        if since is not None:
            df = df.where(F.col(GEN) > F.lit(stamp(since)))
        return df.drop(BUCKET, GEN)

    def load_silver(self, result: RunResult, load_type: str, batch_ts: dt.datetime) -> int:
        return self._each(result, "silver_", FEEDS, lambda n: self.load_silver_table(n, load_type, batch_ts))

    # ---- stage 3: gold ----------------------------------------------------
    def calendar_table(self) -> DataFrame:
        """The stored calendar; made, or made longer, when silver has order dates beyond it."""
        have = self.store.read("gold", "dim_date")
        if have is not None and self.calendar is not None:
            return have
        span = self.calendar
        if span is None:
            span = G.calendar_range_for(self._rows("silver", "orders_clean"), "order_purchase_timestamp")
            if have is not None:
                lo, hi = have.agg(F.min("full_date"), F.max("full_date")).first()
                if lo <= span[0] and span[1] <= hi:
                    return have
                span = (min(lo, span[0]), max(hi, span[1]))
        self.store.write_version("gold", "dim_date", G.dim_date(self.spark, *span).coalesce(1))
        return self.store.read("gold", "dim_date")

    def _load_dim(self, which: str, load_type: str, batch_ts: dt.datetime) -> int:
        if which == "customers":
            table, silver_name, cols, idc, key = ("dim_customers", "customers_clean", G.DIM_CUSTOMER_COLUMNS,
                                                 "customer_id", "customer_key")
            upd, cmp_ = G.CUSTOMER_UPDATES, G.CUSTOMER_COMPARE
        else:
            table, silver_name, cols, idc, key = ("dim_products", "products_clean", G.DIM_PRODUCT_COLUMNS,
                                                 "product_id", "product_key")
            upd, cmp_ = G.PRODUCT_UPDATES, G.PRODUCT_COMPARE
        wm_name = f"gold_{table}"
        # Dimensions are never truncated, not even by a snapshot run.
        existing = self._rows("gold", table)
        wm = None if load_type == SNAPSHOT or existing is None else self._watermark(wm_name)
        changes = G.changed_since(self._rows("silver", silver_name, wm), wm)
        max_key = 0 if existing is None else (existing.agg(F.max(key)).first()[0] or 0)
        c = self._upsert("gold", table, idc, changes, batch_ts, existing is None,
                         G.build_dim(changes, cols, idc, key, batch_ts),
                         lambda t, ch: G.merge_dim(t, ch, cols, idc, key, upd, cmp_, batch_ts, max_key))
        self.control.advance_watermark(wm_name, batch_ts, self.clock())
        return c["inserted"] + c["updated"]

    def _load_fact(self, which: str, load_type: str, batch_ts: dt.datetime) -> int:
        wm_name = f"gold_{which}"
        existing = None if load_type == SNAPSHOT else self.store.read("gold", which)
        wm = None if existing is None else self._watermark(wm_name)
        items, payments = self._rows("silver", "order_items_clean"), self._rows("silver", "payments_clean")
        orders = self._rows("silver", "orders_clean", wm)
        dim_c = self._rows("gold", "dim_customers")
        cal = self.store.read("gold", "dim_date")
        if which == "fact_sales":
            rows = G.fact_sales(items, orders, payments, dim_c, self._rows("gold", "dim_products"), cal, wm, existing)
        else:
            rows = G.fact_orders(orders, items, payments, dim_c, cal, wm, existing)
        self._make_room("gold", which)
        key = "sales_key" if which == "fact_sales" else "order_key"
        # Identity keys continue after the stored maximum; a truncating snapshot restarts them at 1.
        start = 0 if existing is None else (existing.agg(F.max(key)).first()[0] or 0)
        # The joins run once, into a scratch table that the numbering reads.  Its tasks write a file a year each: a task
        # takes more rows as the table grows (spark.sql.files.maxPartitionBytes), so the files grow with it.
        self.store.write_version(SCRATCH, which, rows)
        rows = G.with_fact_keys(self.store.read(SCRATCH, which), key, start, batch_ts)
        if existing is None:
            c = _write_counted(rows, lambda d: self.store.write_version("gold", which, d, FACT_PARTITION))
        else:
            c = _write_counted(rows, lambda d: self.store.append("gold", which, d, FACT_PARTITION))
        self.store.drop(SCRATCH, which)
        self._retire("gold", which)
        self.control.advance_watermark(wm_name, batch_ts, self.clock())
        return c["inserted"]

    def load_gold(self, result: RunResult, load_type: str, batch_ts: dt.datetime) -> int:
        # Dimensions first (facts look their keys up), then both facts.
        self.calendar_table()
        total = self._each(result, "gold_dim_", ("customers", "products"),
                           lambda d: self._load_dim(d, load_type, batch_ts))
        return total + self._each(result, "gold_", ("fact_sales", "fact_orders"),
                                  lambda f: self._load_fact(f, load_type, batch_ts))

    # ---- OP-C08 -----------------------------------------------------------
    def run(self, load_type: str = LOAD_INCREMENTAL, batch_ts: dt.datetime | None = None,
            landed: Callable[[], object] | None = None) -> RunResult:
        """Source (always snapshot) -> bronze -> silver -> gold, logged; re-raises on failure.

        ``landed`` is called once the source layer holds the whole extract: the run does not read the feeds after that.
        """
        t0 = time.time()
        run_id = self.ids()
        batch_ts = self._batch_time(batch_ts)
        result = RunResult(run_id, load_type, batch_ts)
        log_id, start = self.ids(), self.clock()
        self.control.log_event(run_id, log_id, RUN_MAIN, "all", load_type, "RUNNING", start)
        self.control.flush()
        try:
            self._step(run_id, RUN_SOURCE, "source", SNAPSHOT, lambda: self.load_source(result))
            if landed is not None:
                landed()
            self._step(run_id, RUN_BRONZE, "bronze", load_type,
                       lambda: self.load_bronze(result, load_type, batch_ts))
            self._step(run_id, RUN_SILVER, "silver", load_type,
                       lambda: self.load_silver(result, load_type, batch_ts))
            self._step(run_id, RUN_GOLD, "gold", load_type, lambda: self.load_gold(result, load_type, batch_ts))
            result.total_rows = self.control.run_rows_total(run_id)
        except Exception as e:
            self.control.log_event(run_id, log_id, RUN_MAIN, "all", load_type, "FAILED", start,
                                   self.clock(), error=str(e))
            self.control.flush()
            raise
        self.control.log_event(run_id, log_id, RUN_MAIN, "all", load_type, "SUCCESS", start, self.clock(),
                               rows=result.total_rows)
        self.control.flush()
        self.retire_old_versions()
        result.seconds = time.time() - t0
        return result

    # ---- one layer, one module ----------------------------------------------
    def modules(self, layer: str) -> dict[str, Callable[[str, dt.datetime], int]]:
        """The loaders of a layer's tables, in order: (load type, batch time) -> rows written."""
        if layer == "source":
            return {n: (lambda _, __, n=n: self.load_source_table(n)) for n in FEEDS}
        if layer == "bronze":
            return {n: (lambda kind, ts, n=n: self.load_bronze_table(n, kind, ts)) for n in FEEDS}
        if layer == "silver":
            return {n: (lambda kind, ts, n=n: self.load_silver_table(n, kind, ts)) for n in FEEDS}
        if layer == "gold":
            dims = {f"dim_{n}": (lambda kind, ts, n=n: self._load_dim(n, kind, ts)) for n in ("customers", "products")}

            def fact(name: str, kind: str, ts: dt.datetime) -> int:
                self.calendar_table()
                return self._load_fact(name, kind, ts)

            return dims | {n: (lambda kind, ts, n=n: fact(n, kind, ts)) for n in ("fact_sales", "fact_orders")}
        raise ValueError(f"no layer {layer!r}")

    def run_module(self, layer: str, name: str, load_type: str = LOAD_INCREMENTAL, batch_ts: dt.datetime | None = None) -> int:
        """Load one table: logged as a run of one step, its watermark published with it; returns the rows written."""
        load = self.modules(layer)
        if name not in load:
            raise ValueError(f"no module {layer}.{name}")
        kind = SNAPSHOT if layer == "source" else load_type
        ts = self._batch_time(batch_ts)
        return self._step(self.ids(), f"{layer}.load_{name}", layer, kind, lambda: load[name](kind, ts))

    def run_layer(self, layer: str, load_type: str = LOAD_INCREMENTAL, batch_ts: dt.datetime | None = None) -> RunResult:
        """Load all tables of one layer as one logged step."""
        kind = SNAPSHOT if layer == "source" else load_type
        result = RunResult(self.ids(), kind, self._batch_time(batch_ts))
        loads = {
            "source": lambda: self.load_source(result), "bronze": lambda: self.load_bronze(result, kind, result.batch_ts),
            "silver": lambda: self.load_silver(result, kind, result.batch_ts), "gold": lambda: self.load_gold(result, kind, result.batch_ts),
        }
        if layer not in loads:
            raise ValueError(f"no layer {layer!r}")
        names = {"source": RUN_SOURCE, "bronze": RUN_BRONZE, "silver": RUN_SILVER, "gold": RUN_GOLD}
        result.total_rows = self._step(result.run_id, names[layer], layer, kind, loads[layer])
        return result

    def create_views(self) -> list[str]:
        """Make every stored table, the four reports and the control tables readable in SQL as ``{layer}_{table}``.

        The names are temporary views of this session over the tables as they are now: call again after a load.
        """
        frames = {f"bronze_{n}": self.store.read("bronze", n) for n in FEEDS}
        frames |= {f"source_{n}": self.store.read("source", n) for n in FEEDS}
        frames |= {f"silver_{SILVER_SPECS[n].name}": self._rows("silver", SILVER_SPECS[n].name) for n in FEEDS}
        tables = ("dim_customers", "dim_products", "dim_date", "fact_sales", "fact_orders")
        gold = {f"gold_{t}": self._rows("gold", t) for t in tables}
        frames |= gold
        if all(df is not None for df in gold.values()):
            frames |= {f"gold_{n}": df for n, df in self.reports().items()}
        frames["control_pipeline_log"] = self.control.run_log()
        frames["control_pipeline_watermark"] = self.control.watermarks()
        made = {n: df for n, df in frames.items() if df is not None}
        for n, df in made.items():
            df.createOrReplaceTempView(n)
        return sorted(made)

    def _batch_time(self, asked: dt.datetime | None) -> dt.datetime:
        """A batch time after every stored watermark, so that no row of this run can fall under one."""
        last = max((t for t in self.control.current_watermarks().values() if t), default=None)
        if asked is not None:
            if last is not None and asked <= last:
                raise ValueError(f"batch time {asked} does not advance beyond the stored watermark {last}")
            return asked
        now = self.clock()
        return now if last is None or now > last else last + dt.timedelta(microseconds=1)

    def _make_room(self, layer: str, table: str) -> None:
        """Delete a spare state before the next one is written, so that ``keep_versions`` stand while a load lasts too.

        The newest state stays: readers that started before this load finish, and a load that fails leaves it as it is.
        """
        self.store.drop_old_versions(layer, table, keep=max(1, self.keep_versions - 1))

    def _retire(self, layer: str, table: str) -> None:
        """Delete a table's versions older than the newest ``keep_versions``, once the newest is written.

        Rewrites (source reloads, merges, snapshots) leave the previous version behind; keeping one spare lets
        readers that started before the load finish.  More than that never stands until the end of a run.
        """
        self.store.drop_old_versions(layer, table, keep=self.keep_versions)

    def retire_old_versions(self) -> None:
        """The same for every table (after a successful run)."""
        tables = [("source", n) for n in FEEDS] + [("bronze", n) for n in FEEDS]
        tables += [("silver", SILVER_SPECS[n].name) for n in FEEDS]
        tables += [("gold", t) for t in ("dim_customers", "dim_products", "fact_sales", "fact_orders")]
        for layer, table in tables:
            self._retire(layer, table)

    # ---- stored tables and the report views over them ---------------------------
    def gold(self, table: str) -> DataFrame:
        df = self.store.read("gold", table)
        if df is None:
            raise LookupError(f"gold.{table} has not been loaded")
        return df.drop(BUCKET, GEN)

    def silver(self, feed: str) -> DataFrame:
        df = self._rows("silver", SILVER_SPECS[feed].name)
        if df is None:
            raise LookupError(f"silver of {feed} has not been loaded")
        return df

    def reports(self) -> dict[str, DataFrame]:
        fs, fo = self.gold("fact_sales"), self.gold("fact_orders")
        return {
            "sales_summary": R.sales_summary(fs, self.gold("dim_date"), fo),
            "product_performance": R.product_performance(fs, self.gold("dim_products"), fo),
            "customer_revenue": R.customer_revenue(fo, self.gold("dim_customers")),
            "delivery_quality": R.delivery_quality(fo),
        }

    def silver_digests(self) -> DataFrame:
        """table_name, row_count, digest of every stored silver table."""
        rows = [digest(self.silver(n), [*SILVER_SPECS[n].columns, "created_at", "updated_at"]).select(
            F.lit(SILVER_SPECS[n].name).alias("table_name"), "*") for n in FEEDS]
        return reduce(DataFrame.unionByName, rows)

    # ---- OP-C07 / G12 -------------------------------------------------------
    def gold_digests(self) -> DataFrame:
        """table_name, row_count, digest, keys_ok of every stored gold table and report.

        Surrogate keys count by what they stand for: a fact's digest holds the business ids that its keys
        lead to, and ``keys_ok`` says that a table's own key is dense (true for tables without one).
        """
        dc, dp = self.gold("dim_customers"), self.gold("dim_products")
        by_c = dc.select("customer_key", F.col("customer_id").alias("dim_customer_id"))
        by_p = dp.select("product_key", F.col("product_id").alias("dim_product_id"))
        audit = ["created_at", "updated_at"]
        fs = self.gold("fact_sales").join(by_c, "customer_key", "left").join(by_p, "product_key", "left")
        fo = self.gold("fact_orders").join(by_c, "customer_key", "left")
        looked_up = ("customer_key", "product_key")
        tables = {
            "dim_customers": (dc, [*G.DIM_CUSTOMER_COLUMNS, *audit], "customer_key"),
            "dim_products": (dp, [*G.DIM_PRODUCT_COLUMNS, *audit], "product_key"),
            "dim_date": (self.gold("dim_date"), None, None),
            "fact_sales": (fs, [*[c for c in G.FACT_SALES_COLUMNS if c not in looked_up], "dim_customer_id", "dim_product_id", "created_at"], "sales_key"),
            "fact_orders": (fo, [*[c for c in G.FACT_ORDERS_COLUMNS if c not in looked_up], "dim_customer_id", "created_at"], "order_key"),
            **{name: (df, None, None) for name, df in self.reports().items()},
        }
        out = None
        for name, (df, columns, key) in tables.items():
            row = digest(df, columns or df.columns)
            # The key alone, from the table itself: the look-ups of a fact's digest are not run for it again.
            row = row.crossJoin(key_is_dense(self.gold(name).select(key), key)) if key else row.withColumn("keys_ok", F.lit(True))  # one row by one row
            row = row.select(F.lit(name).alias("table_name"), "*")
            out = row if out is None else out.unionByName(row)
        return out
