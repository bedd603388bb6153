"""Global ordinals without a single-partition window (OP-G06 keys, OP-R02 rank).

An unpartitioned ``row_number()`` / ``rank()`` window moves every row into
one task.  Both helpers here split the rows into ``B`` buckets, number the
rows inside each bucket with a partitioned window, and add the bucket's
offset - the number of rows in all earlier buckets.  Offsets come from a
``B``-row count table (``B`` is a parameter, so its broadcast is bounded).

* ``surrogate_keys``: bucket = hash of the business key; keys are dense,
  unique and deterministic for a given input set (no partition-id tricks,
  so a recomputed task after an executor loss yields the same keys).
* ``global_rank``: rank with gaps over a measure.  Ranks depend on values
  only, so the rows are first collapsed to distinct values with their
  counts (a hot value becomes one row), the distinct values are cut into
  ordered buckets at approximate quantiles, ranked per bucket, and joined
  back by value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from emporia.session import checkpoint_root

_BUCKET = "_bucket"
_N = "_n"


def _offsets(counts: DataFrame, at: tuple[str, ...] = (_BUCKET,)) -> DataFrame:
    """Per bucket: rows in all earlier buckets.  ``counts`` has at most B rows (for each value of further columns in ``at``)."""
    w = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*at, F.coalesce(F.sum(_N).over(w), F.lit(0)).cast("long").alias("_offset"))


#: Hash buckets of the numbering.  A constant, so that key values do not depend on a session's settings.
BUCKETS = 1024


def default_buckets(df: DataFrame) -> int:
    return BUCKETS


def surrogate_keys(df: DataFrame, business_keys: list[str], key_name: str,
                   start: int | Column = 0, buckets: int | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """Add ``key_name`` = start + 1..N, unique per row of ``df`` (unique on ``business_keys``).

    ``within``: columns of few values (a table's partition columns).  The buckets are then cut inside each value and the
    rows come out gathered by them, since the shuffle goes by ranges of value and bucket: a write partitioned by
    these columns needs no shuffle of its own.
    """
    b = buckets or default_buckets(df)
    at = (*within, _BUCKET)
    keyed = df.withColumn(_BUCKET, F.pmod(F.xxhash64(*business_keys), F.lit(b)).cast("int"))
    w = Window.partitionBy(*at).orderBy(*[F.col(k).asc_nulls_first() for k in business_keys])
    placed = keyed.repartitionByRange(*at) if within else keyed
    numbered = placed.withColumn("_local", F.row_number().over(w))
    counts = keyed.groupBy(*at).agg(F.count(F.lit(1)).alias(_N))
    offsets = _offsets(counts, at).withColumnsRenamed({c: f"_at_{c}" for c in at})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at])
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        numbered.join(F.broadcast(offsets), same)
        .withColumn(key_name, (start_col + F.col("_offset") + F.col("_local")).cast("long"))
        .drop(_BUCKET, "_local", "_offset", *[f"_at_{c}" for c in at])
    )


def stored_row_keys(df: DataFrame, key_name: str, start: int | Column = 0) -> DataFrame:
    """Add ``key_name`` = start + 1..N to the rows of a stored Parquet table, read as ``df`` without further steps.

    A row is numbered by its place in its file, after the rows of all files before it: no row moves and none is
    sorted.  The files are written, so a recomputed task gives the same keys.  The only table that is gathered
    and broadcast has one row a file.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_local"))
    counts = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias(_N))
    offsets = F.broadcast(_offsets(counts, ("_file",)))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.join(offsets, "_file")
        .withColumn(key_name, (start_col + F.col("_offset") + F.col("_local") + 1).cast("long"))
        .drop("_file", "_local", "_offset")
    )


def global_rank(df: DataFrame, value: str, rank_name: str, descending: bool = True,
                buckets: int | None = None, relative_error: float = 0.001,
                materialize: bool = True) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value [DESC])`` (gaps on ties) over all rows of ``df``.

    NULL values rank last for DESC and first for ASC, as in Spark's default ordering.
    ``df`` is read three times (cut points, per-bucket ranks, final join), so by
    default it is checkpointed once to the cluster's checkpoint folder instead of
    recomputing its whole lineage three times.
    """
    b = buckets or default_buckets(df)
    if materialize:
        checkpoint_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    values = df.groupBy(value).agg(F.count(F.lit(1)).alias(_N))
    # Ordered cut points of the distinct non-NULL values (B-1 numbers to the driver).
    fractions = [i / b for i in range(1, b)]
    cuts = []
    if fractions:
        row = values.where(F.col(value).isNotNull()).agg(
            F.percentile_approx(F.col(value).cast("double"), fractions, int(1 / relative_error)).alias("q")
        ).first()
        cuts = sorted(set(row["q"] or [])) if row else []
    # Bucket = position among the cut points (JVM binary search); equal values share a bucket.
    splits = [float("-inf"), *cuts, float("inf")]
    nb = len(splits) - 1
    probe = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    values = values.withColumn("_probe", probe)
    if cuts:
        values = Bucketizer(splits=splits, inputCol="_probe", outputCol="_asc").transform(values)
    else:  # empty input, NULLs only or a single bucket: nothing to cut
        values = values.withColumn("_asc", F.lit(0.0))
    asc = F.col("_asc").cast("int")
    isnull = F.col(value).isNull()
    # Bucket 0 holds the first values in rank order; NULL gets its own bucket at the proper end.
    if descending:
        bucket = F.when(isnull, F.lit(nb)).otherwise(F.lit(nb - 1) - asc)
        order = F.col(value).desc_nulls_last()
    else:
        bucket = F.when(isnull, F.lit(0)).otherwise(asc + 1)
        order = F.col(value).asc_nulls_first()
    values = values.withColumn(_BUCKET, bucket.cast("int")).drop("_probe", "_asc")
    w = Window.partitionBy(_BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = values.withColumn("_before", F.coalesce(F.sum(_N).over(w), F.lit(0)))
    counts = values.groupBy(_BUCKET).agg(F.sum(_N).alias(_N))
    ranked = local.join(F.broadcast(_offsets(counts)), _BUCKET).select(
        F.col(value).alias("_value"), (F.col("_offset") + F.col("_before") + 1).cast("long").alias(rank_name)
    )
    return df.join(ranked, df[value].eqNullSafe(ranked["_value"]), "left").drop("_value")
