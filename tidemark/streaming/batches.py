"""Rows appended by micro-batch, and what is derived from them.

A ``BatchLog`` is a folder of Parquet folders ``batch=<id>``. A batch writes its own folder and
nothing else; when it is replayed it replaces that folder, so a stream that writes only
here gives each row once without a marker of its own. Rows are never rewritten:
state and history are read from the log with windows and aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import latest_per_key
from ..session import path_exists


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def append(self, df: DataFrame, batch_id: int) -> None:
        (df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
         .write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}"))

    def rows_of(self, batch_id: int) -> DataFrame:
        """Rows of one batch that was appended."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        """All rows with their ``batch``."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def newest(self, keys: Sequence[str], order: str | Column = "batch") -> DataFrame:
        """The newest row per key: by ``batch``, or by another order."""
        return latest_per_key(self.read(), keys, order, ties=False)
