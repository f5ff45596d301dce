"""Registered queries (one per operator of the inventory) and their oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or tables Spark derived from them); each oracle is DuckDB SQL over
the raw tables computing the same result. Output timestamps are
``TIMESTAMP_NTZ``; every computed column is aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ntz
from ..operators import cdc, quality
from ..session import prepare
from ..sources.tables import load
from . import bookstore as bs
from .oracle_fragments import (BOOKS_P, BOOKS_RAW, BOOKS_SCD2, CUST_P, CUST_SILVER,
                               LINES_P, ORDERS_P, with_)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return ntz(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


# --------------------------------------------------------------------------
# Gold (flagship)

@query("countries_stats", with_(ORDERS_P, CUST_P, CUST_SILVER) + """
SELECT s.country, date_trunc('day', o.order_timestamp) AS order_date,
       count(o.order_id) AS orders_count, CAST(sum(o.quantity) AS BIGINT) AS books_count
FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id
WHERE o.quantity > 0
GROUP BY ALL""")
def countries_stats(spark, sf_dir):
    """Materialized gold view: orders and books per country and day."""
    return bs.countries_stats(spark, sf_dir)


# --------------------------------------------------------------------------
# Bronze and multiplex parsing

@query("bronze_ingest_stream", with_(ORDERS_P, CUST_P, BOOKS_P) + """
SELECT topic, year_month, count(*) AS n FROM (
  SELECT 'orders' AS topic, strftime(order_timestamp, '%Y-%m') AS year_month FROM orders_p
  UNION ALL SELECT 'customers', strftime(row_time, '%Y-%m') FROM cust_p
  UNION ALL SELECT 'books', strftime(updated, '%Y-%m') FROM books_p)
GROUP BY ALL""")
def bronze_ingest_stream(spark, sf_dir):
    """Incremental JSON ingest into bronze partitioned by topic and month."""
    return bs.bronze(spark, sf_dir).groupBy("topic", "year_month").agg(F.count(F.lit(1)).alias("n"))


@query("multiplex_parse_orders", with_(ORDERS_P) + """
SELECT order_id, order_timestamp, customer_id, quantity, total, n_books FROM orders_p""")
def multiplex_parse_orders(spark, sf_dir):
    """Topic filter + from_json + v.* on the orders topic."""
    return bs.orders_raw(spark, sf_dir).select(
        "order_id", "order_timestamp", "customer_id", "quantity", "total",
        F.size("books").cast("bigint").alias("n_books"))


@query("count_all", with_(ORDERS_P) + "SELECT count(*) AS n FROM orders_p")
def count_all(spark, sf_dir):
    return bs.orders_raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("distinct_topics", """
SELECT DISTINCT topic FROM (SELECT 'orders' AS topic FROM orders
  UNION ALL SELECT 'customers' FROM events e JOIN customer c ON e.user_id = c.c_custkey
  UNION ALL SELECT 'books' FROM events e JOIN part p ON e.user_id = p.p_partkey)""")
def distinct_topics(spark, sf_dir):
    return bs.bronze(spark, sf_dir).select("topic").distinct()


@query("sorted_limit", with_(ORDERS_P) + """
SELECT order_id, customer_id, total FROM orders_p WHERE quantity > 0
ORDER BY total DESC, order_id LIMIT 20""")
def sorted_limit(spark, sf_dir):
    """Top orders by total (a top-k report: the limit is the feature)."""
    return (bs.orders_silver(spark, sf_dir).select("order_id", "customer_id", "total")
            .orderBy(F.col("total").desc(), "order_id").limit(20))


# --------------------------------------------------------------------------
# CDC

@query("cdc_latest", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, balance, country, row_time FROM cust_silver""")
def cdc_latest(spark, sf_dir):
    """Newest insert/update per customer with rank() = 1 (ties kept)."""
    from ..operators.keyed import latest_per_key
    return latest_per_key(bs.customers_cdc(spark, sf_dir), ["customer_id"], "row_time").select(
        "customer_id", "balance", "country", "row_time")


@query("auto_cdc_scd1", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, email, name, segment, balance, country_code, code, country FROM cust_silver""")
def auto_cdc_scd1(spark, sf_dir):
    """AUTO CDC SCD1 flow: customers_silver without row_status/row_time."""
    return bs.customers_silver(spark, sf_dir)


@query("auto_cdc_scd2", with_(BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + "SELECT * FROM books_silver")
def auto_cdc_scd2(spark, sf_dir):
    """AUTO CDC SCD2 flow over books_raw with __START_AT/__END_AT."""
    return bs.books_silver(spark, sf_dir)


@query("current_items", with_(BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + """
SELECT book_id, title, author, price FROM books_silver WHERE __END_AT IS NULL""")
def current_items(spark, sf_dir):
    """Current projection of the SCD2 table (current_books)."""
    return bs.current_books(spark, sf_dir)


@query("scd2_price_history", with_(BOOKS_P) + """,
x AS (SELECT *, row_number() OVER w AS rn, lag(price) OVER w AS p
      FROM books_p WINDOW w AS (PARTITION BY book_id ORDER BY updated)),
v AS (SELECT * FROM x WHERE rn = 1 OR price <> p)
SELECT book_id, title, author, price,
       lead(updated) OVER w2 IS NULL AS current, updated AS effective_date,
       lead(updated) OVER w2 AS end_date
FROM v WINDOW w2 AS (PARTITION BY book_id ORDER BY updated)""")
def scd2_price_history(spark, sf_dir):
    """Type 2 SCD by staged merge: a new version per price change."""
    empty = spark.createDataFrame([], "book_id BIGINT, title STRING, author STRING, price DOUBLE, "
                                      "current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP")
    upd = bs.books_raw(spark, sf_dir).drop("is_quarantined")
    return cdc.scd2_merge(empty, upd, "book_id", "updated").table


# --------------------------------------------------------------------------
# Joins

@query("lateral_explode_join", with_(ORDERS_P, LINES_P, BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + """
SELECT o.order_id, o.customer_id, o.quantity, l.book_id, l.book_quantity, l.subtotal,
       b.title, b.author, b.price
FROM orders_p o JOIN lines_p l ON o.order_id = l.order_id
JOIN books_silver b ON l.book_id = b.book_id AND b.__END_AT IS NULL
WHERE o.quantity > 0""")
def lateral_explode_join(spark, sf_dir):
    """books_sales: orders exploded per book joined to current books."""
    return bs.books_sales(spark, sf_dir).select(
        "order_id", "customer_id", "quantity", F.col("book.book_id").alias("book_id"),
        F.col("book.quantity").alias("book_quantity"), F.col("book.subtotal").alias("subtotal"),
        "title", "author", "price")


# --------------------------------------------------------------------------
# Quality

@query("expect_drop", with_(ORDERS_P) + "SELECT order_id, quantity FROM orders_p WHERE quantity > 0")
def expect_drop(spark, sf_dir):
    return bs.orders_silver(spark, sf_dir).select("order_id", "quantity")


@query("quarantine_split", with_(ORDERS_P) + "SELECT order_id, quantity FROM orders_p WHERE quantity <= 0")
def quarantine_split(spark, sf_dir):
    return bs.orders_quarantine(spark, sf_dir).select("order_id", "quantity")


@query("quarantine_flag", with_(BOOKS_P, BOOKS_RAW) + """
SELECT book_id, updated, price, is_quarantined FROM books_raw""")
def quarantine_flag(spark, sf_dir):
    return bs.books_raw(spark, sf_dir).select("book_id", "updated", "price", "is_quarantined")


@query("expect_warn_metrics", with_(BOOKS_P) + """
SELECT 'recent_updates' AS rule, count_if(coalesce(updated >= TIMESTAMP '2020-01-01', false)) AS passed_records,
       count_if(NOT coalesce(updated >= TIMESTAMP '2020-01-01', false)) AS failed_records, 'books_raw' AS dataset FROM books_p
UNION ALL
SELECT 'valid_price', count_if(coalesce(price BETWEEN 0 AND 100, false)),
       count_if(NOT coalesce(price BETWEEN 0 AND 100, false)), 'books_raw' FROM books_p
UNION ALL
SELECT 'valid_id', count_if(book_id IS NOT NULL), count_if(book_id IS NULL), 'books_raw' FROM books_p""")
def expect_warn_metrics(spark, sf_dir):
    """Warn expectations: rows kept, passed/failed counts per rule."""
    return quality.expectation_metrics(bs.books_raw(spark, sf_dir), bs.BOOK_RULES, "books_raw")


@query("constraint_violations", with_(ORDERS_P) + """
SELECT 'timestamp_within_range' AS rule, count_if(NOT coalesce(order_timestamp >= TIMESTAMP '2020-01-01', false)) AS failed_records FROM orders_p
UNION ALL
SELECT 'valid_quantity', count_if(NOT coalesce(quantity > 0, false)) FROM orders_p""")
def constraint_violations(spark, sf_dir):
    """Rows that would make a CHECK-constrained write (or ADD CONSTRAINT) fail."""
    rules = {"timestamp_within_range": "order_timestamp >= '2020-01-01'",
             "valid_quantity": "quantity > 0"}
    return quality.expectation_metrics(bs.orders_raw(spark, sf_dir), rules).select(
        "rule", "failed_records")


@query("pk_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def pk_unique(spark, sf_dir):
    """Primary-key uniqueness check: the duplicated keys and their counts."""
    return quality.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedup_batch", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_batch(spark, sf_dir):
    """dropDuplicates on a key subset (survivor row is arbitrary, keys returned)."""
    return (load(spark, sf_dir, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber"])
            .select("l_orderkey", "l_linenumber"))
