"""Spark session helpers.

Cluster deployments pass their own configuration (``spark-submit --conf``);
``get_session`` only fills in settings that are still unset, so a cluster's
``spark.checkpoint.dir`` / shuffle sizing always wins over the local defaults
used by tests and the bench.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tunables).
REQUIRED_CONF = {
    # The feeds carry zone-less wall-clock times; all date maths is done in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Failed casts must raise unless written as try_cast (the reference uses TRY_CAST).
    "spark.sql.ansi.enabled": "true",
}

# Defaults for local runs (tests, bench); a cluster job passes its own session
# and only calls ``configure``.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app_name: str = "emporia", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the correctness settings to an existing session; its tuning is left alone."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    # Python workers import this package where it lies, whatever folder the driver was started in.
    # (On a cluster the package is installed or shipped; the setting is one more folder on the path.)
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


#: Spark's own setting: the files of a query's shuffles are deleted when the query ends.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind.

    Spark otherwise keeps them until the driver's garbage collection finds their plans unused, so a run of many
    queries fills the executors' disks with the sum of all its shuffles.  For steps whose result is written or
    collected: a frame that is run again makes its shuffles anew.
    """
    before = spark.conf.get(RELEASE_SHUFFLES, None)
    spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_SHUFFLES)
        else:
            spark.conf.set(RELEASE_SHUFFLES, before)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it); only when the
    session has none (local tests) do we set one under the system temp folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local sessions only: no cluster-named folder, so take a fresh local one.
        import tempfile

        root = tempfile.mkdtemp(prefix="emporia-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    return "/".join([checkpoint_root(spark), *[p.strip("/") for p in parts]])

