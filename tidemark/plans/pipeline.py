"""The whole bookstore flow run in dependency order (§3.3 / §3.5).

``run`` materializes every table of the pipeline, like the reference's task
list (land → bronze → silver customers / orders / books → customers_orders /
books_sales → gold). It is a plain sequence of calls: each step is itself a
distributed Spark job or availableNow stream, and every step is restartable
(checkpoints, replay-safe commits), so rerunning after a
failure continues where it stopped, and a run after new files have landed takes these only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import prepare, start_generation, table_root
from ..sources.ingest import ensure_bronze
from ..streaming.static import PublishedTable
from . import bookstore as bs
from . import streams as st


def _materialize(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """A materialized view: replaced by every run, readers of the version before are not disturbed."""
    path = f"{table_root(spark, sf_dir)}/gold/{name}"
    return f"{path}/v={PublishedTable(spark, path).publish(build())}"


def run(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Build every table; returns table name -> location."""
    prepare(spark)
    out: dict[str, str] = {"bronze": ensure_bronze(spark, sf_dir)}
    out["customers_silver"] = st.customers_silver(spark, sf_dir).path
    out["orders_silver"] = _materialize(spark, sf_dir, "orders_silver",
                                        lambda: bs.orders_silver(spark, sf_dir))
    out["orders_quarantine"] = _materialize(spark, sf_dir, "orders_quarantine",
                                            lambda: bs.orders_quarantine(spark, sf_dir))
    out["books_silver"] = _materialize(spark, sf_dir, "books_silver",
                                       lambda: bs.books_silver(spark, sf_dir))
    out["current_books"] = st.current_books_table(spark, sf_dir, replace=True).path
    out["customers_orders"] = st.customers_orders(spark, sf_dir).path
    out["books_sales"] = st.books_sales(spark, sf_dir)
    out["authors_stats"] = st.authors_stats(spark, sf_dir)
    out["countries_stats"] = _materialize(spark, sf_dir, "countries_stats",
                                          lambda: bs.countries_stats(spark, sf_dir))
    return out


def full_refresh(spark: SparkSession, sf_dir: str) -> int:
    """Recompute every refreshable table from bronze on the next ``run`` (STR-10).

    Bronze is reset-protected: its files and stream checkpoint are outside the
    generation folders, so a refresh neither re-ingests nor loses it. Earlier
    generations are left in place.
    """
    return start_generation(spark, sf_dir)
