"""Python UDFs (UDF-1…6): one pricing rule and the forms Spark can run it in.

``PRICING`` maps a price and a percentage to the price after the discount. A NULL on
either side gives NULL; percentages outside 0 to 100 are taken as they are (a
surcharge, a negative price). ``form`` wraps the rule as a row UDF, with or without a result
type, or as an Arrow-batched one. Library operators never use the row forms on hot paths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rest_of(percent):
    """The share of a price that is left; works on numbers and on pandas columns."""
    return 1 - percent / 100


def PRICING(price, percent):
    if price is None or percent is None:
        return None
    return price * rest_of(percent)


@lru_cache(maxsize=None)
def form(kind: str):
    """The rule as a UDF: ``string`` (a row UDF without a type returns strings), ``double`` or ``arrow``.
    Built on first use, as that needs an active SparkContext."""
    if kind == "arrow":
        def batch(price: pd.Series, percent: pd.Series) -> pd.Series:
            return price.mul(rest_of(percent))
        return F.pandas_udf(batch, "double")
    return F.udf(PRICING, kind)


def apply_discount_udf():
    return form("string")


def apply_discount_decorator_udf():
    return form("double")


def vectorized_udf():
    return form("arrow")


def register_sql_udfs(spark: SparkSession) -> None:
    """UDF-2 / UDF-5: the row and the batched form by name, for SQL."""
    for name, f in {"apply_discount_sql_udf": PRICING, "sql_vectorized_udf": form("arrow")}.items():
        spark.udf.register(name, f)


def grouped_mean(df: DataFrame, key: str, value: str, out: str = "avg_value") -> DataFrame:
    """Mean of ``value`` per ``key`` with pandas code (AGG-9, UDF-6).

    The reference passes each whole group to pandas
    (``groupBy(key).applyInPandas``). A group can hold a third of all rows,
    so here pandas computes partial sums and counts per Arrow batch inside
    each partition (``mapInPandas``, memory bounded by the batch size), and
    Spark merges the partials with a normal aggregation.
    """
    kt = df.schema[key].dataType.simpleString()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = pdf.groupby(key, dropna=False)[value]
            yield pd.DataFrame({key: g.sum().index, "s": g.sum().values,
                                "n": g.count().values})

    parts = df.select(key, value).mapInPandas(partial, f"{key} {kt}, s double, n long")
    return parts.groupBy(key).agg(F.try_divide(F.sum("s"), F.sum("n")).alias(out))
