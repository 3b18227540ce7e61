"""Lazy access to the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class DriverTables:
    """``tables.orders`` -> ``spark.read.parquet(f"{root}/orders.parquet")``.

    Reads are lazy; Catalyst prunes columns and pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]
