"""Parquet table access for the driver's data folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; Spark prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict = {}

    def memo(self, key: str, build):
        """Build an intermediate once per query construction (e.g. a materialised table)."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def replace(self, key: str, value) -> None:
        """Set an intermediate, as where its written copy takes its place."""
        self._memo[key] = value

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
