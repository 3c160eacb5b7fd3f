"""Session defaults shared by tests, bench and the driver entry.

Cluster deployments pass their own settings through ``spark-submit``; this module
only fills what is unset, so a cluster's ``spark.checkpoint.dir`` (a shared folder)
always wins over the local fallback used in tests.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every strata job relies on: UTC session time (oracle parity), ANSI casts
# (bad input raises, as the reference tests expect) and AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast switch).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one with strata defaults if needed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``checkpoint()`` and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session when the cluster sets it. Only a
    ``local`` master falls back to a fresh scratch folder: on a cluster a folder of one
    machine is not seen by the others, so an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder shared by the cluster ({master})")
    local = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared checkpoint dir for written intermediate tables."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write ``df`` once under the shared checkpoint dir and read it back: later steps read the
    table instead of recomputing the plan, and a lost executor costs no more than its tasks. Paths and ids repeat:
    zstd writes them far smaller than the session's usual codec."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
