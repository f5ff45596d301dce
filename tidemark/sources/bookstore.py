"""The bookstore data model, derived from the given tables.

The pipeline this library reproduces works on three Kafka-shaped topics
(``orders``, ``customers`` CDC, ``books`` price updates) plus a country
lookup. The test data are TPC-H-like tables, so each topic is derived from
them with Spark:

* ``orders``    one document per order (``orders``) with its lines
                (``lineitem``) nested as ``books``.
* ``customers`` a CDC log: one row per ``events`` row of a user, joined to
                ``customer``; ``signup`` -> insert, ``error`` of a customer of
                ``DELETING_SEGMENT`` -> delete, anything else -> update,
                ``ts`` is ``row_time``.
* ``books``     a price-update log: one row per ``events`` row, the user id
                names the book (``part``), ``floor(value / 100)`` is the
                price so that repeats of the same price occur.
* ``country_lookup`` is ``nation`` (``code``, ``country``).

All payloads are typed after the test tables (keys are BIGINT) so oracle SQL
can be written against the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import estimated_bytes
from .tables import load

# Fixed schemas of the raw envelope and the topic payloads (DDL).
ENVELOPE_SCHEMA = ("key BINARY, value BINARY, topic STRING, partition LONG, "
                   "offset LONG, timestamp LONG")
BRONZE_SCHEMA = ("key BINARY, value BINARY, partition LONG, offset LONG, "
                 "timestamp TIMESTAMP, topic STRING, year_month STRING")
ORDERS_SCHEMA = ("order_id BIGINT, order_timestamp TIMESTAMP, customer_id BIGINT, "
                 "quantity BIGINT, total DOUBLE, "
                 "books ARRAY<STRUCT<book_id: BIGINT, quantity: BIGINT, subtotal: DOUBLE>>")
CUSTOMERS_SCHEMA = ("customer_id BIGINT, email STRING, name STRING, segment STRING, "
                    "balance DOUBLE, country_code INT, row_status STRING, row_time TIMESTAMP")
BOOKS_SCHEMA = ("book_id BIGINT, title STRING, author STRING, price DOUBLE, "
                "updated TIMESTAMP")
TOPIC_SCHEMAS = {"orders": ORDERS_SCHEMA, "customers": CUSTOMERS_SCHEMA,
                 "books": BOOKS_SCHEMA}
# Payload timestamps keep microseconds (the JSON default is milliseconds).
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# Scanned bytes of lines (estimated) whose lists one task builds.
GROUPED_BYTES = 8 << 20


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("country"))


def orders_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines nested as ``books``.

    One document per order is the source data model; lines are grouped per
    order key only (an order's own lines), sorted by line number. Order
    quantity is the sum of its line quantities, so orders without lines have
    quantity 0 (the zero-quantity orders the quality rules catch).

    Lines are dealt by order first, in parts of ``GROUPED_BYTES``: lists built before the shuffle
    combine nothing (an order's lines lie anywhere) and make a task sort, and spill, all that it scans.
    """
    raw = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    parts = max(spark.sparkContext.defaultParallelism, -(-estimated_bytes(raw) // GROUPED_BYTES))
    lines = (raw.repartition(parts, "l_orderkey")
             .groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct(
                     F.col("l_linenumber").alias("n"),
                     F.col("l_partkey").alias("book_id"),
                     F.col("l_quantity").cast("bigint").alias("quantity"),
                     F.col("l_extendedprice").alias("subtotal")))).alias("lines"),
                  F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")))
    o = load(spark, sf_dir, "orders")
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
                    F.col("o_custkey").alias("customer_id"),
                    F.coalesce("quantity", F.lit(0)).cast("bigint").alias("quantity"),
                    F.col("o_totalprice").alias("total"),
                    F.coalesce(F.transform("lines", lambda s: F.struct(
                        s["book_id"].alias("book_id"), s["quantity"].alias("quantity"),
                        s["subtotal"].alias("subtotal"))),
                        F.array().cast("array<struct<book_id:bigint,quantity:bigint,subtotal:double>>"))
                    .alias("books")))


# Customers of one market segment ask for deletion, so that deletes meet part of the customers.
DELETING_SEGMENT = "BUILDING"


def row_status(event_type, segment):
    return (F.when(event_type == "signup", "insert")
            .when((event_type == "error") & (segment == DELETING_SEGMENT), "delete")
            .otherwise("update"))


def customers_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC rows for customers, one per event of the customer."""
    e = load(spark, sf_dir, "events")
    c = load(spark, sf_dir, "customer")
    return (e.join(c, e.user_id == c.c_custkey, "inner")
            .select(F.col("user_id").alias("customer_id"),
                    F.concat(F.lit("c"), F.col("user_id"), F.lit("@mail.test")).alias("email"),
                    F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("value").alias("balance"),
                    F.col("c_nationkey").alias("country_code"),
                    row_status(F.col("event_type"), F.col("c_mktsegment")).alias("row_status"),
                    F.col("ts").cast("timestamp").alias("row_time")))


def books_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price updates for books, one per event of the user whose id names the book.

    Books are joined by a shuffle: names compress well, so a table of few bytes on disk is many through the driver.
    """
    e = load(spark, sf_dir, "events")
    p = load(spark, sf_dir, "part").hint("merge")
    return (e.join(p, e.user_id == p.p_partkey, "inner")
            .select(F.col("user_id").alias("book_id"),
                    F.col("p_name").alias("title"),
                    F.col("p_brand").alias("author"),
                    F.floor(F.col("value") / 100).cast("double").alias("price"),
                    F.col("ts").cast("timestamp").alias("updated")))


def envelope(payload: DataFrame, topic: str, key_col: str, ts_col: str,
             offset_col=None) -> DataFrame:
    """Wrap a payload in the Kafka-shaped envelope (value = JSON bytes,
    timestamp = epoch milliseconds)."""
    ts = F.col(ts_col)
    return payload.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in payload.columns]), JSON_OPTIONS).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(F.col(key_col)), F.lit(3)).cast("bigint").alias("partition"),
        (offset_col if offset_col is not None else F.lit(0).cast("bigint")).alias("offset"),
        (F.unix_micros(ts) / 1000).cast("bigint").alias("timestamp"))


def raw_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three topics as one envelope DataFrame."""
    orders = envelope(orders_payload(spark, sf_dir), "orders", "order_id",
                      "order_timestamp", F.col("order_id"))
    cust = envelope(customers_payload(spark, sf_dir), "customers", "customer_id",
                    "row_time", F.unix_micros(F.col("row_time")))
    books = envelope(books_payload(spark, sf_dir), "books", "book_id", "updated",
                     F.unix_micros(F.col("updated")))
    return orders.unionByName(cust).unionByName(books)


def parse_topic(bronze: DataFrame, topic: str, schema: str | None = None, *, once: bool = False) -> DataFrame:
    """Topic filter + ``from_json`` + ``v.*`` over bronze (FLT-1, FN-1, FN-7, PRJ-2).

    The topic equality is a partition filter on bronze, so only that topic's
    directories are listed and read.

    A filter on the result is pushed below the projection and parses each value a second time. ``once``
    parses it once, all columns: for readers that filter and then use most of them.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema or TOPIC_SCHEMAS[topic], JSON_OPTIONS)
    rows = bronze.filter(F.col("topic") == topic)
    return rows.select(F.inline(F.array(parsed))) if once else rows.select(parsed.alias("v")).select("v.*")
