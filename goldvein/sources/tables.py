"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldvein.session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan; naming the columns keeps ReadSchema minimal even before
    Catalyst's own pruning."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
