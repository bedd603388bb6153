"""Continuous ingest of feed files into bronze (optional streaming form of OP-B01..B05).

New CSV files dropped into a feed folder are picked up by a file-source
stream; each micro-batch goes through the same key-based bronze append as
the batch loader, written by ``foreachBatch`` under a name made of the
stream's name and the batch number.  Spark may run a micro-batch again after
a failure: it then finds its name, keeps its time and replaces its rows, so
a batch stands once in bronze, rows without a key included.
``trigger(availableNow=True)`` processes what is there and stops.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from emporia.plans.pipeline import append_new
from emporia.schemas import DEFAULT_SOURCE_SYSTEM, LOAD_INCREMENTAL, SOURCE_SCHEMAS
from emporia.sources.store import TableStore, stamp

STAMP = "%Y%m%dT%H%M%S%f"


def stream_feed_to_bronze(spark: SparkSession, feed_dir: str, name: str, store: TableStore,
                          checkpoint: str, source_system: str = DEFAULT_SOURCE_SYSTEM,
                          available_now: bool = True, stream_name: str = "stream",
                          clock: Callable[[], dt.datetime] = dt.datetime.now) -> StreamingQuery:
    """Start a stream that appends new keys of feed ``name`` to bronze."""
    stream = (
        spark.readStream.schema(SOURCE_SCHEMAS[name])
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(feed_dir)
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tag = f"-{stream_name}-{batch_id:012d}"
        names = store.batches("bronze", name)
        again = next((b for b in names if b.endswith(tag)), None)
        if again:  # Spark runs a micro-batch again after a failure: it keeps its time and replaces its rows
            batch_ts = dt.datetime.strptime(again[: -len(tag)], STAMP)
        else:  # never at or before what has landed already
            last = max((dt.datetime.strptime(b.split("-")[0], STAMP) for b in names), default=None)
            batch_ts = clock()
            if last is not None and batch_ts <= last:
                batch_ts = last + dt.timedelta(microseconds=1)
        append_new(store, batch, name, batch_ts, LOAD_INCREMENTAL, source_system, stamp(batch_ts) + tag)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
