"""Counts of expectations as the run measured them (QUA-5, QUA-11).

``observe_rules`` adds the counts to a query as observed metrics; ``RuleMetrics`` is a listener that stores them per
dataset, batch and rule when a micro-batch is done. Nothing is scanned a second time, and a replayed batch
replaces its counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import path_exists

SCHEMA = "dataset STRING, batch BIGINT, rule STRING, passed_records BIGINT, failed_records BIGINT"


def observe_rules(df: DataFrame, rules: Mapping[str, str], dataset: str) -> DataFrame:
    """``df`` with passed and failed counts per rule; a rule that is NULL has failed."""
    counts = []
    for name, rule in rules.items():
        ok = F.coalesce(F.expr(f"({rule})"), F.lit(False))
        counts += [F.count_if(ok).alias(f"{name}:passed"), F.count_if(~ok).alias(f"{name}:failed")]
    return df.observe(dataset, *counts)


class RuleMetrics(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.errors = spark, path.rstrip("/"), []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.store(event.progress.observedMetrics, event.progress.batchId)
        except Exception as e:  # raised by ``collecting``: an error here would be lost in the listener's thread
            self.errors.append(e)

    def store(self, metrics, batch_id: int) -> None:
        for dataset, row in metrics.items():
            got = row.asDict()
            rules = [k.removesuffix(":passed") for k in got if k.endswith(":passed")]
            rows = [(dataset, batch_id, r, got[f"{r}:passed"], got[f"{r}:failed"]) for r in rules]
            if rows:
                self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={dataset}-{batch_id}")

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).select("dataset", "batch", "rule", "passed_records", "failed_records")


@contextmanager
def collecting(spark: SparkSession, path: str):
    """Store the observed rules of all streams that run in this block."""
    listener = RuleMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    if listener.errors:
        raise listener.errors[0]
