"""Join helpers (§2.4).

The reference hints a broadcast only for the country lookup. Here a side is
broadcast only after its size is checked from plan statistics (no job is
run); above the bound the join stays a shuffle join, where AQE can still
switch strategy or split skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bound for an explicit broadcast (bytes, as estimated by Catalyst).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file sizes for scans; metadata only)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is within ``max_bytes``."""
    try:
        small = estimated_bytes(df) <= max_bytes
    except Exception:  # streaming plans have no stats: leave the choice to Spark
        small = False
    return F.broadcast(df) if small else df


def lookup_join(df: DataFrame, lookup: DataFrame, on: Column | list[str] | str,
                how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join to a lookup table, broadcasting it when it is provably small (JOI-1)."""
    return df.join(broadcast_if_small(lookup, max_bytes), on, how)


def explode_join(orders: DataFrame, items: DataFrame, array_col: str, alias: str,
                 item_key: str, on_key: str) -> DataFrame:
    """``LATERAL EXPLODE(o.<array>) AS b(<alias>) JOIN items ON b.<alias>.<key> = items.<key>``
    (JOI-3, JOI-5, FN-8). The exploded element stays a struct column."""
    ex = orders.withColumn(alias, F.explode(array_col))
    return ex.join(items, F.col(f"{alias}.{item_key}") == items[on_key], "inner")
