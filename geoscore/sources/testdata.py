"""Table scans and column discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan: filters and projections reach the reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def discover_columns(df: DataFrame, excluded: list[str]) -> list[str]:
    """Every column of a table except an exclusion list, in table order."""
    ex = set(excluded)
    return [c for c in df.columns if c not in ex]
