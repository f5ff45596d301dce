"""A static side that can be replaced while streams read it (SNK-6, JOI-3).

A published table is a folder per version; the newest complete one is the current one. A micro-batch pins the
version that it reads before it writes anything, so a batch that is replayed after the table was
replaced gives the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import list_dirs, path_exists, touch


class PublishedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        found = [int(d[2:]) for d in list_dirs(self.spark, self.path) if d.startswith("v=")]
        return sorted(v for v in found if path_exists(self.spark, f"{self.path}/v={v}/_SUCCESS"))

    def publish(self, df: DataFrame) -> int:
        """``CREATE OR REPLACE TABLE … AS SELECT``: readers see it from the next batch on."""
        v = max(self.versions(), default=-1) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={v}")
        return v

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={max(self.versions()) if version is None else version}")

    def read_for(self, reader: str, batch_id: int) -> DataFrame:
        """The version that ``reader`` uses in this batch, the current one at its first try."""
        pins = f"{self.path}/_pins/{reader}/batch={batch_id}"
        pinned = list_dirs(self.spark, pins)
        if not pinned:
            touch(self.spark, f"{pins}/v={max(self.versions())}/_SET")
            pinned = list_dirs(self.spark, pins)
        return self.read(min(int(d[2:]) for d in pinned))
