"""Data quality: check constraints, expectations, quarantine (§2.10).

Rules are SQL boolean expressions keyed by name, as in the reference. All
checks are aggregates evaluated on the executors; only violation counts reach
the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(Exception):
    pass


def _rule(expr: str | Column) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def violations(df: DataFrame, rules: Mapping[str, str], *, null_fails: bool = True) -> dict[str, int]:
    """Violation count per rule in one pass. For CHECK constraints a NULL
    result counts as a violation (``null_fails``)."""
    aggs = []
    for name, e in rules.items():
        ok = _rule(e)
        bad = ~F.coalesce(ok, F.lit(not null_fails))
        aggs.append(F.count_if(bad).alias(name))
    row = df.agg(*aggs).first()
    return {k: int(row[k] or 0) for k in rules}


def check_constraints(df: DataFrame, constraints: Mapping[str, str]) -> None:
    """All-or-nothing write check (QUA-1): raise before writing if any row
    violates any constraint."""
    if not constraints:
        return
    bad = {k: v for k, v in violations(df, constraints).items() if v}
    if bad:
        raise ConstraintViolation(f"CHECK constraint violated: {bad}")


def add_constraint(existing: DataFrame, constraints: dict[str, str], name: str, expr: str) -> dict[str, str]:
    """``ALTER TABLE ADD CONSTRAINT`` (QUA-2): existing rows are validated
    first; on failure the constraint is not added."""
    check_constraints(existing, {name: expr})
    return {**constraints, name: expr}


def drop_constraint(constraints: dict[str, str], name: str) -> dict[str, str]:
    """``ALTER TABLE DROP CONSTRAINT`` (QUA-3)."""
    return {k: v for k, v in constraints.items() if k != name}


def all_rules(rules: Mapping[str, str]) -> str:
    return " AND ".join(f"({e})" for e in rules.values())


def quarantine_expr(rules: Mapping[str, str]) -> str:
    """``NOT(r1 AND r2 AND …)`` (QUA-10); NULL when a rule is NULL and none is false."""
    return f"NOT ({all_rules(rules)})"


def quarantine_flag(df: DataFrame, rules: Mapping[str, str], col: str = "is_quarantined") -> DataFrame:
    return df.withColumn(col, F.expr(quarantine_expr(rules)))


def expect(df: DataFrame, rules: Mapping[str, str], action: str = "warn",
           name: str = "expectations") -> DataFrame:
    """Expectations (QUA-5/6/7/8).

    * ``warn``: rows kept; per-rule failed counts are observed metrics of the
      query (``df.observe``), readable from a batch ``Observation`` or a
      stream's ``lastProgress``.
    * ``drop``: rows where any rule is not true (false or NULL) are removed.
    * ``fail``: the query fails on the first violating row
      (``raise_error`` inside a filter, so it cannot be pruned away).
    """
    metrics = [F.count_if(~F.coalesce(_rule(e), F.lit(False))).alias(f"{k}_failed")
               for k, e in rules.items()]
    metrics.append(F.count(F.lit(1)).alias("rows"))
    out = df.observe(name, *metrics)
    ok = F.expr(all_rules(rules)) if rules else F.lit(True)
    if action == "drop":
        return out.filter(ok)
    if action == "fail":
        names = ", ".join(rules)
        return out.filter(F.when(F.coalesce(ok, F.lit(False)), F.lit(True))
                          .otherwise(F.raise_error(F.lit(f"expectation failed: {names}"))))
    return out


def expectation_metrics(df: DataFrame, rules: Mapping[str, str], dataset: str = "") -> DataFrame:
    """Per-rule passed / failed counts as a small table (QUA-11). NULL counts
    as failed, like ``expect_or_drop`` would drop it."""
    aggs = []
    for k, e in rules.items():
        ok = F.coalesce(_rule(e), F.lit(False))
        aggs += [F.count_if(ok).alias(f"p_{k}"), F.count_if(~ok).alias(f"f_{k}")]
    wide = df.agg(*aggs)
    parts = [F.struct(F.lit(k).alias("rule"), F.col(f"p_{k}").alias("passed_records"),
                      F.col(f"f_{k}").alias("failed_records")) for k in rules]
    return wide.select(F.inline(F.array(*parts))).withColumn("dataset", F.lit(dataset))


def split(df: DataFrame, rules: Mapping[str, str], *, null_fails: bool = False):
    """Valid rows and quarantined rows (QUA-4/9).

    With ``null_fails=False`` this is the reference's pair of filters
    ``rule`` / ``NOT rule``: a row whose rule is NULL lands in neither. With
    ``null_fails=True`` such rows go to quarantine.
    """
    ok = F.expr(all_rules(rules))
    valid = df.filter(ok)
    bad = df.filter(~ok) if not null_fails else df.filter(~F.coalesce(ok, F.lit(False)))
    return valid, bad


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (QUA-12); partial aggregation keeps it
    cheap for hot keys."""
    return df.groupBy(*keys).count().filter("count > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    n = duplicate_keys(df, keys).count()
    if n:
        raise AssertionError(f"{n} duplicate key(s) on {list(keys)}")
