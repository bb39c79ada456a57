"""Catalog / file table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class ParquetTables:
    """Lazy handle on ``<root>/<name>.parquet`` tables.

    Only a plan is built here; the scan reads just the columns and row
    groups a query needs (column pruning and filter pushdown by Catalyst).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = self.table(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)


def catalog_table(spark: SparkSession, database: str | None, name: str) -> DataFrame:
    """A table registered in the session catalog."""
    return spark.table(f"{database}.{name}" if database else name)
