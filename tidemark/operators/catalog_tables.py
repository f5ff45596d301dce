"""Given tables in the session's catalog, with statistics (MNT-1, MNT-3, FN-15).

Tables are external: nothing is copied. ``analyze`` stores row counts and column statistics in the catalog;
``profile`` lists what the catalog holds and reads the counts from there, and with
``spark.sql.cbo.enabled`` the optimizer estimates joins from them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .governance import quoted_name, quoted_text


def register(spark: SparkSession, database: str, location: str, tables: Mapping[str, str]) -> None:
    """Create ``database`` (its folder is ``location``) and an external Parquet table per (name, path)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(database)} LOCATION {quoted_text(location)}")
    for name, path in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted_name(database)}.{quoted_name(name)} USING parquet LOCATION {quoted_text(path)}")


def analyze(spark: SparkSession, database: str, table: str, columns: Sequence[str] = ()) -> None:
    """``ANALYZE TABLE``: the row count, and statistics of ``columns``."""
    at = f"{quoted_name(database)}.{quoted_name(table)}"
    spark.sql(f"ANALYZE TABLE {at} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(map(quoted_name, columns))}" if columns else ""))


def row_count(spark: SparkSession, database: str, table: str) -> int | None:
    """Rows of a table by its stored statistics; null if it was never analyzed."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(database)}.{quoted_name(table)}").filter("col_name = 'Statistics'").collect()
    found = re.search(r"(\d+) rows", rows[0].data_type) if rows else None
    return int(found[1]) if found else None


def profile(spark: SparkSession, database: str) -> DataFrame:
    """(catalog, table_name, row_count) of every table that the catalog lists in ``database``."""
    names = [t.name for t in spark.catalog.listTables(database) if t.tableType != "TEMPORARY"]
    rows = [(n, row_count(spark, database, n)) for n in names]
    return spark.createDataFrame(rows, "table_name string, row_count bigint").select(F.current_catalog().alias("catalog"), "table_name", "row_count")
