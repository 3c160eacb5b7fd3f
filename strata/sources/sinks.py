"""Sinks. Parquet snapshots are written to fresh folders; a
snapshot is only ever read after its write committed, so a failed job leaves the
previous snapshot intact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Replace the table (schema may change). With ``partition_by`` only the
    partitions present in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_append(df: DataFrame, path: str) -> str:
    """Append rows; new columns are allowed (read back with ``mergeSchema``)."""
    df.write.mode("append").parquet(path)
    return path


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read an appended table whose files may carry different column sets."""
    return spark.read.option("mergeSchema", True).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    """Create-or-replace a (temp) view."""
    df.createOrReplaceTempView(name)


def write_issues(df: DataFrame, path: str) -> bool:
    """Write findings when there are any (emptiness probe, no count); without findings the
    table of the last run becomes empty."""
    if df.isEmpty():
        df.write.mode("overwrite").parquet(path)
        return False
    df.write.mode("overwrite").parquet(path)
    return True
