"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one table (SRC-12). Column pruning and filters reach the
    Parquet reader because callers stay declarative."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view so SQL forms can be used as well."""
    for t in TABLES:
        load(spark, sf_dir, t).createOrReplaceTempView(t)
