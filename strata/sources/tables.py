"""S1/S2 - batch and streaming scans of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def scan(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Batch read. Selecting ``columns`` early keeps the parquet ReadSchema narrow
    (Catalyst prunes anyway, this only documents intent)."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def scan_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Incremental read of an append-only parquet folder (new files only)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


class Tables:
    """Lazy accessor ``t.orders`` -> DataFrame over ``{root}/orders.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return scan(self.spark, self.root, name)
