"""Table maintenance re-aimed as Spark jobs (MNT-1…4, AGG-10).

Each report is a distributed aggregate; nothing is listed or counted on the
driver beyond the final small result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table (MNT-1): one union of counts, run as one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per data file: record count, and min / max / null count per column
    (MNT-2): the statistics a table log keeps for data skipping."""
    aggs = [F.count(F.lit(1)).alias("num_records")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    # by path: one write gives the files of several folders the same name
    return (df.groupBy(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name"))
            .agg(*aggs).drop("_path"))


def partition_layout(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows and data files per partition directory (MNT-4)."""
    return (df.groupBy(*partition_cols)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_distinct(F.col("_metadata.file_path")).alias("files")))


def compact(df: DataFrame, path: str, partition_cols: list[str],
            target_rows_per_file: int | None = None) -> str:
    """Rewrite a table into fewer, larger files per partition (MNT-3,
    ``OPTIMIZE``): rebalanced on the partition columns, so each partition
    directory receives few files and a hot one is split over several tasks;
    ``maxRecordsPerFile`` caps file size."""
    w = df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols)
    if target_rows_per_file:
        w = w.option("maxRecordsPerFile", int(target_rows_per_file))
    w.parquet(path)
    return path
