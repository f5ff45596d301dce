"""Erasing keys from stored history (GOV-7).

A history table is a folder of Parquet partitions that other writers only append to. ``erase`` finds the
files that hold rows of the given keys by a semi-join over the file path, writes the other rows of their partitions
to a staging folder, and replaces those partitions by a dynamic partition overwrite. No other file is
touched. It can be run again at any time: after a failure it finds what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_dir
from .joins import broadcast_if_small


def files_with(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(file, rows) of the files that hold rows of ``keys``. NULL keys match nothing."""
    wanted = broadcast_if_small(keys.select(key).dropDuplicates())
    return (table.select(key, F.col("_metadata.file_path").alias("file")).join(wanted, key, "left_semi")
            .groupBy("file").agg(F.count("*").alias("rows")))


def erase(spark: SparkSession, path: str, keys: DataFrame, key: str, partition_by: Sequence[str], staging: str) -> int:
    """Remove the rows of ``keys`` from the table at ``path``; returns how many files held some.

    ``staging`` is a new folder that all executors share. The driver holds the names of partitions that become
    empty, never rows or keys.
    """
    table = spark.read.parquet(path)
    wanted = broadcast_if_small(keys.select(key).dropDuplicates())
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")
    hits = (table.select("*", F.col("_metadata.file_path").alias("_file"), folder).join(wanted, key, "left_semi")
            .groupBy("_folder", *partition_by).agg(F.count_distinct("_file").alias("files")))
    hits.write.mode("overwrite").parquet(f"{staging}/hits")
    hits = spark.read.schema(hits.schema).parquet(f"{staging}/hits")
    n = hits.agg(F.sum("files")).first()[0] or 0
    if not n:
        return 0
    touched = broadcast_if_small(hits.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by]))
    same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_by]
    rest = table.join(touched, same, "left_semi").join(wanted, key, "left_anti")
    rest.write.mode("overwrite").parquet(f"{staging}/rest")
    rest = spark.read.schema(rest.schema).parquet(f"{staging}/rest")
    (rest.repartition(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    stays = rest.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by]).distinct()
    for row in hits.join(stays, same, "left_anti").select("_folder").distinct().toLocalIterator():
        remove_dir(spark, row[0])
    return n
