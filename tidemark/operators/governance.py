"""Governance: dynamic views, column masks and row filters (GOV-1…4).

Open Spark has no ``is_member`` and no ``SET MASK`` / ``SET ROW FILTER``.
Group membership is an input: a SQL session variable ``tidemark_groups``
(ARRAY<STRING>) that views read when they are queried, so a view's output
follows whoever runs it. Masks and row filters are SQL functions applied by
``secured_view``. SQL views re-read the variable on every query; a
DataFrame built with ``redact``/``restrict_rows`` resolves it when built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUPS_VAR = "tidemark_groups"
REDACTED = "REDACTED"


def set_groups(spark: SparkSession, groups: Sequence[str] = ()) -> None:
    """Declare (or replace) the caller's group list for this session."""
    lits = ", ".join(map(quoted_text, groups))
    spark.sql(f"DECLARE OR REPLACE VARIABLE {GROUPS_VAR} ARRAY<STRING> "
              f"DEFAULT CAST(array({lits}) AS ARRAY<STRING>)")


def quoted_text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_name(name: str) -> str:
    """A name (or a dotted path of names) as quoted SQL identifiers."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def is_member(group: str) -> Column:
    """``is_member(group)`` evaluated against the session's group list (FN-14)."""
    return F.array_contains(F.expr(GROUPS_VAR), F.lit(group))


def redact(df: DataFrame, cols: Sequence[str], group: str, replacement: str = REDACTED) -> DataFrame:
    """``CASE WHEN is_member(g) THEN c ELSE 'REDACTED' END AS c`` for each column (GOV-1)."""
    m = is_member(group)
    return df.select(*[F.when(m, F.col(c)).otherwise(F.lit(replacement)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def restrict_rows(df: DataFrame, group: str, predicate: str | Column) -> DataFrame:
    """``WHERE CASE WHEN is_member(g) THEN TRUE ELSE <predicate> END`` (GOV-2)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(F.when(is_member(group), F.lit(True)).otherwise(p))


def create_mask_function(spark: SparkSession, name: str, group: str,
                         replacement: str = REDACTED) -> None:
    """``CREATE FUNCTION <name>(v STRING) RETURN CASE WHEN is_member(g) THEN v
    ELSE 'REDACTED' END`` (GOV-3, UDF-7). Membership is an argument."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {quoted_name(name)}(v STRING, groups ARRAY<STRING>)
                  RETURNS STRING
                  RETURN CASE WHEN array_contains(groups, {quoted_text(group)}) THEN v
                              ELSE {quoted_text(replacement)} END""")


def create_row_filter_function(spark: SparkSession, name: str, group: str,
                               args: str, predicate: str) -> None:
    """``CREATE FUNCTION <name>(<args>) RETURN IF(is_member(g), true, <predicate>)`` (GOV-4)."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {quoted_name(name)}({args}, groups ARRAY<STRING>)
                  RETURNS BOOLEAN
                  RETURN IF(array_contains(groups, {quoted_text(group)}), true, {predicate})""")


def secured_view(spark: SparkSession, source: str, name: str, *,
                 masks: Mapping[str, str] | None = None,
                 row_filter: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """A view over ``source`` applying column masks and a row filter the way
    ``ALTER COLUMN … SET MASK`` / ``SET ROW FILTER`` would."""
    cols = spark.table(source).columns
    masks = dict(masks or {})
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in cols}
    sel = ", ".join(f"{quoted_name(masks[c])}({q}, {GROUPS_VAR}) AS {q}" if c in masks else q for c, q in quoted.items())
    where = ""
    if row_filter:
        fn, fcols = row_filter
        where = f" WHERE {quoted_name(fn)}({', '.join(quoted[c] for c in fcols)}, {GROUPS_VAR})"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted_name(name)} AS SELECT {sel} FROM {quoted_name(source)}{where}")
    return spark.table(name)
