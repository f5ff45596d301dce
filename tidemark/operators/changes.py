"""Change-feed operators (CDC-9, CDC-12, SET-2, GOV-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cdc import DELETE, INSERT, POST, PRE, _emit


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows turning ``old`` into ``new`` by key: one full outer join on
    the keys, values compared null-safely."""
    cols = old.columns
    vals = [c for c in cols if c not in keys]
    o = old.select(*[F.col(c).alias("o__" + c) for c in cols], F.lit(True).alias("_o"))
    n = new.select(*[F.col(c).alias("n__" + c) for c in cols], F.lit(True).alias("_n"))
    cond = None
    for k in keys:
        c = F.col("o__" + k) == F.col("n__" + k)
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    same = F.lit(True)
    for c in vals:
        same = same & F.col("o__" + c).eqNullSafe(F.col("n__" + c))
    has_o, has_n = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    upd = has_o & has_n & ~same

    def side(p, t):
        return F.struct(*[F.col(p + c).alias(c) for c in cols], F.lit(t).alias("_change_type"))

    return _emit(j, [(has_n & ~has_o, side("n__", INSERT)), (upd, side("o__", PRE)),
                     (upd, side("n__", POST)), (has_o & ~has_n, side("o__", DELETE))])


def change_history(changes: DataFrame) -> DataFrame:
    """Per version and change type: number of change rows (``DESCRIBE HISTORY``
    re-aimed at the change feed)."""
    return (changes.groupBy("_commit_version", "_change_type")
            .agg(F.count(F.lit(1)).alias("n")))


def rows_removed_since(old: DataFrame, new: DataFrame) -> DataFrame:
    """``SELECT * FROM t@vN EXCEPT SELECT * FROM t`` (distinct, SET-2)."""
    return old.subtract(new)


def erase_keys(changes: DataFrame, erased: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed without any row of erased keys (GOV-7): the rewrite that
    completes a right-to-be-forgotten delete."""
    return changes.join(erased.select(*keys).dropDuplicates(), list(keys), "left_anti")
