"""Type 2 history that is only appended to (CDC-5, CDC-8).

``Scd2Log`` keeps closed versions and open rows in two logs. A batch reads the open rows of its own keys and
writes the versions it closes, one open row per touched key, and the change rows; closed history is
neither read nor rewritten. The open row of a key is its newest one.

``AutoCdcLog`` keeps the change rows of each batch as they are. Versions follow from their
order alone, so late rows and rows delivered twice need no rewrite: readers derive versions by windows
over the changes, and the current rows by the newest change per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc
from ..operators.joins import broadcast_if_small
from ..operators.keyed import latest_per_key
from .batches import BatchLog
from .runner import kept


class Scd2Log:
    """``schema`` has the attributes, ``current``, ``effective_date`` and ``end_date``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str):
        self.key, self.schema = key, T.StructType.fromDDL(schema)
        self.closed, self.open = BatchLog(spark, f"{path}/closed", self.schema), BatchLog(spark, f"{path}/open", self.schema)
        self.changes = BatchLog(spark, f"{path}/changes", T.StructType([*self.schema.fields, T.StructField("_change_type", T.StringType())]))

    def merge(self, updates: DataFrame, sequence: str, batch_id: int) -> None:
        """Apply one micro-batch; its rows must not be older than the open rows of their keys."""
        keys = broadcast_if_small(updates.select(self.key).dropDuplicates())
        known = self.open.read().filter(F.col("batch") < batch_id).join(keys, self.key, "left_semi")
        now = latest_per_key(known, [self.key], "batch", ties=False).select(*self.schema.names)
        result = cdc.scd2_merge(now, updates, self.key, sequence, of_batch=True)
        with kept(result.table) as versions:
            self.closed.append(versions.filter("not current"), batch_id)
            self.open.append(versions.filter("current"), batch_id)
        self.changes.append(result.changes, batch_id)

    def current(self) -> DataFrame:
        return self.open.newest([self.key]).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self.closed.read().select(*self.schema.names).unionByName(self.current())


class AutoCdcLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], sequence: str,
                 except_columns: Sequence[str] = (), delete_when: str | None = None):
        self.log = BatchLog(spark, path, schema)
        self.names, self.keys, self.sequence = schema.names, list(keys), sequence
        self.options = {"except_columns": list(except_columns), "delete_when": delete_when}

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Keep the changes of one micro-batch, each once."""
        self.log.append(changes.select(*self.names).dropDuplicates(), batch_id)

    def rows(self, upto: int | None = None) -> DataFrame:
        """Changes of all batches, or of those up to one."""
        rows = self.log.read()
        return (rows if upto is None else rows.filter(F.col("batch") <= upto)).select(*self.names)

    def scd2(self, upto: int | None = None) -> DataFrame:
        return cdc.scd2_rows(cdc.apply_changes_scd2(None, self.rows(upto), self.keys, self.sequence, **self.options))

    def scd1(self, upto: int | None = None) -> DataFrame:
        """The state after all batches, or after one."""
        return cdc.scd1_rows(cdc.apply_changes_scd1(None, self.rows(upto), self.keys, self.sequence, **self.options))
