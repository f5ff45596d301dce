"""Timestamp helpers.

Watermarks and ``window`` need session-zone timestamps (``TIMESTAMP``),
while the given tables hold ``TIMESTAMP_NTZ``; with the session zone pinned to
UTC the two casts below are value-preserving.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ntz(df: DataFrame) -> DataFrame:
    """Cast every top-level ``TIMESTAMP`` column to ``TIMESTAMP_NTZ`` (output form)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def ltz(df: DataFrame) -> DataFrame:
    """Cast every top-level ``TIMESTAMP_NTZ`` column to ``TIMESTAMP`` (event-time form)."""
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields])
