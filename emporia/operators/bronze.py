"""Bronze layer: key-based incremental append (OP-B01..B05, B07).

New rows are found by business key, not by business time (a back-dated
order would be missed by a date filter).  The guard is a left-anti join on
the keys with trailing blanks ignored on both sides (text equality of the
reference ignores them).  A NULL key never matches, so such rows are
appended by every incremental run, as in the reference.  In-batch
duplicates are kept; silver de-duplicates them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.schemas import BRONZE_KEYS, DEFAULT_SOURCE_SYSTEM, LOAD_INCREMENTAL, LOAD_SNAPSHOT, SOURCE_COLUMNS


def stamp(source: DataFrame, name: str, batch_ts: dt.datetime,
          source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """Source columns + the two audit columns (one timestamp per load)."""
    return source.select(
        *SOURCE_COLUMNS[name],
        F.lit(batch_ts).cast("timestamp_ntz").alias("ingestion_timestamp"),
        F.lit(source_system).alias("source_system"),
    )


def new_rows(source: DataFrame, existing: DataFrame | None, name: str) -> DataFrame:
    """Source rows whose business key is not yet in bronze (all rows when bronze is empty)."""
    if existing is None:
        return source
    keys = BRONZE_KEYS[name]
    known = existing.select(*[F.rtrim(k).alias("_k_" + k) for k in keys]).distinct()
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.rtrim(source[k]) == known["_k_" + k])
    return source.join(known, cond, "left_anti")


def load(source: DataFrame, existing: DataFrame | None, name: str, batch_ts: dt.datetime,
         load_type: str = LOAD_INCREMENTAL, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """Rows to append to bronze for one load.

    ``snapshot`` (or a first load) appends everything to an emptied table;
    any other load type behaves as incremental.
    """
    base = None if load_type == LOAD_SNAPSHOT else existing
    return stamp(new_rows(source, base, name), name, batch_ts, source_system)
