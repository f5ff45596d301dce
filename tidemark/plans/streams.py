"""Streaming flows of the bookstore pipeline (§3.2, §3.3, §2.11).

Each flow is an availableNow streaming query with its checkpoint under the
work folder, writing through ``foreachBatch`` into versioned tables or
batch logs. Calling a flow again takes what is new since its last run and nothing
else: the checkpoint names what was taken, and a replayed batch is skipped (commits are keyed
by writer and batch id) or replaces its own folder.

``variant`` names a set of these tables: ``main``; ``gov``, which starts from the content of ``main``
and takes the deletes; any other reads the bronze table in its own folder, which its caller feeds.

Customer CDC arrives in steps of ``STEP_DAYS`` days, each landed as new
files and followed by one availableNow run, like the reference's "land a new
file, then process" loop; each run is one micro-batch and one table version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.joins import explode_join, lookup_join
from ..operators.keyed import latest_per_key
from ..session import prepare, table_root
from ..sources.bookstore import (CUSTOMERS_SCHEMA, JSON_OPTIONS, country_lookup,
                                 customers_payload, parse_topic)
from ..sources.ingest import bronze_stream, ensure_bronze, land_steps
from ..streaming.batches import BatchLog
from ..streaming.runner import drain, kept
from ..streaming.static import PublishedTable
from ..streaming.table import VersionedTable
from . import bookstore as bs

STEP_DAYS = 5
CUSTOMERS_SILVER_SCHEMA = ("customer_id BIGINT, email STRING, name STRING, segment STRING, "
                           "balance DOUBLE, country STRING, row_time TIMESTAMP")
ORDER_COLS = ["order_id", "order_timestamp", "customer_id", "quantity", "total", "books"]
CUSTOMERS_ORDERS_SCHEMA = ("order_id BIGINT, order_timestamp TIMESTAMP, customer_id BIGINT, "
                           "quantity BIGINT, total DOUBLE, "
                           "books ARRAY<STRUCT<book_id: BIGINT, quantity: BIGINT, subtotal: DOUBLE>>, "
                           "email STRING, name STRING, "
                           "segment STRING, balance DOUBLE, country STRING, row_time TIMESTAMP, "
                           "processed_timestamp TIMESTAMP")
DELETE_REQUESTS_SCHEMA = ("customer_id BIGINT, request_timestamp TIMESTAMP, deadline DATE, "
                          "status STRING")


def _root(spark: SparkSession, sf_dir: str, variant: str) -> str:
    return table_root(spark, sf_dir, variant)


def _stepped(spark: SparkSession, payload: DataFrame, ts_col: str, landing: str, run) -> None:
    """Land ``payload`` in ``STEP_DAYS``-day steps and call ``run`` after each one that was landed now; once, to
    take what a lost run has left, if all had been landed before."""
    day = F.to_date(ts_col)
    day0, day1 = payload.agg(F.min(day), F.max(day)).first()
    if day0 is None:
        return
    steps = payload.withColumn("_step", F.floor(F.datediff(day, F.lit(day0)) / STEP_DAYS).cast("int"))
    if not land_steps(steps, "_step", (day1 - day0).days // STEP_DAYS + 1, landing, run, fmt="json", part="step={:02d}", **JSON_OPTIONS):
        run()


def _landed(spark: SparkSession, landing: str, schema: str) -> DataFrame:
    return (spark.readStream.schema(schema).options(**JSON_OPTIONS)
            .option("recursiveFileLookup", "true").json(landing))


def _from_main(table: VersionedTable, main: VersionedTable) -> VersionedTable:
    """``CREATE TABLE … AS SELECT * FROM main``, once."""
    if not table.exists():
        table.insert(main.read(), writer="create", batch_id=0)
    return table


def bronze_of(spark: SparkSession, sf_dir: str, variant: str = "main") -> str:
    return ensure_bronze(spark, sf_dir) if variant in ("main", "gov") else f"{_root(spark, sf_dir, variant)}/bronze"


def customers_silver(spark: SparkSession, sf_dir: str, variant: str = "main") -> VersionedTable:
    """customers_silver fed by a stream of CDC files through ``foreachBatch``:
    status filter and newest row per key inside the batch, then an upsert
    guarded by ``row_time`` (CDC-2, WIN-3, JOI-1, SNK-4, STR-5/6)."""
    prepare(spark)
    root = _root(spark, sf_dir, variant)
    table = VersionedTable(spark, f"{root}/customers_silver", CUSTOMERS_SILVER_SCHEMA,
                           keys=["customer_id"])
    if variant == "gov":
        return _from_main(table, customers_silver(spark, sf_dir))
    table.create_if_absent()
    landing = f"{root}/landing/customers"
    lookup = country_lookup(spark, sf_dir)

    def batch_upsert(mb: DataFrame, batch_id: int) -> None:
        with kept(mb) as mb:  # the merge reads the batch twice (keys, rows)
            upd = mb.filter(F.col("row_status").isin("insert", "update")).select(*table.schema.names)
            table.merge(lambda cur: cdc.upsert(cur, upd, ["customer_id"], "row_time"),
                        writer="customers_silver_upsert", batch_id=batch_id, source=upd)

    def run() -> None:
        stream = lookup_join(_landed(spark, landing, CUSTOMERS_SCHEMA), lookup, F.col("country_code") == F.col("code"))
        drain(stream.writeStream.foreachBatch(batch_upsert), f"{root}/_checkpoints/customers_silver")

    _stepped(spark, customers_payload(spark, sf_dir), "row_time", landing, run)
    return table


def orders_stream(spark: SparkSession, sf_dir: str, variant: str = "main") -> DataFrame:
    """orders_silver as a stream over bronze (topic filter, parse, quantity > 0)."""
    s = parse_topic(bronze_stream(spark, bronze_of(spark, sf_dir, variant)), "orders", once=True)
    return s.filter("quantity > 0")


def customers_orders(spark: SparkSession, sf_dir: str, variant: str = "main") -> VersionedTable:
    """Stream-stream join of orders with the customers change feed, upserted by
    (order_id, customer_id) with the commit time as sequence (JOI-2, CDC-3, WIN-2, SRC-5).

    The change types are filtered before the join (same result as after it,
    with half the join state)."""
    root = _root(spark, sf_dir, variant)
    # a merge reads the rows of its batch's customers (part of the merge key)
    table = VersionedTable(spark, f"{root}/customers_orders", CUSTOMERS_ORDERS_SCHEMA,
                           keys=["customer_id"])
    if variant == "gov":
        return _from_main(table, customers_orders(spark, sf_dir))
    cs = customers_silver(spark, sf_dir, variant)
    table.create_if_absent()
    cols = table.schema.names
    newest = BatchLog(spark, f"{root}/customers_orders_batches", table.schema)

    def batch_upsert(mb: DataFrame, batch_id: int) -> None:
        if table.version_of("customers_orders_upsert", batch_id) is not None:
            return
        # The merge reads these rows twice, in one join. Spark does not find persisted rows of a stateful
        # micro-batch on the second side of such a join and would run the stream-stream join again.
        newest.append(latest_per_key(mb, ["order_id", "customer_id"], "_commit_timestamp")
                      .withColumnRenamed("_commit_timestamp", "processed_timestamp").select(*cols), batch_id)
        ranked = newest.rows_of(batch_id)
        table.merge(lambda cur: cdc.upsert(cur, ranked, ["order_id", "customer_id"],
                                           "processed_timestamp", rank_updates=False),
                    writer="customers_orders_upsert", batch_id=batch_id, source=ranked)

    feed = (cs.change_stream(start=1)
            .filter(F.col("_change_type").isin("insert", "update_postimage")))
    joined = orders_stream(spark, sf_dir, variant).select(*ORDER_COLS).join(feed, ["customer_id"], "inner")
    drain(joined.writeStream.foreachBatch(batch_upsert), f"{root}/_checkpoints/customers_orders")
    return table


def current_books_table(spark: SparkSession, sf_dir: str, *, replace: bool = False) -> PublishedTable:
    """``CREATE OR REPLACE TABLE current_books AS SELECT …`` (SNK-6, CDC-6): made if absent, or replaced."""
    table = PublishedTable(spark, f"{_root(spark, sf_dir, 'main')}/current_books")
    if replace or not table.versions():
        table.publish(bs.current_books(spark, sf_dir))
    return table


def books_sales(spark: SparkSession, sf_dir: str, variant: str = "main") -> str:
    """Stream-static join: the orders stream drives; each micro-batch reads the
    current_books table that is current when it is first tried, so a table replaced between runs is
    seen by the next batch (JOI-3, SNK-5 append)."""
    root = _root(spark, sf_dir, variant)
    books, orders = current_books_table(spark, sf_dir), orders_stream(spark, sf_dir, variant)

    def sales(mb: DataFrame, current: DataFrame) -> DataFrame:
        return explode_join(mb, current, "books", "book", "book_id", "book_id")

    log = BatchLog(spark, f"{root}/books_sales", sales(orders, books.read()).schema)
    drain(orders.writeStream.foreachBatch(lambda mb, i: log.append(sales(mb, books.read_for(f"books_sales-{variant}", i)), i)),
          f"{root}/_checkpoints/books_sales")
    return log.path


def author_windows(sales: DataFrame, start: str = "0 seconds") -> DataFrame:
    """Orders and mean order quantity per author and five minutes of order time, batch or
    stream; windows start at multiples of five minutes moved by ``start`` (AGG-4, AGG-5)."""
    five = F.window("order_timestamp", "5 minutes", startTime=start)
    return (sales.groupBy("author", five.alias("time"))
            .agg(F.count("order_id").alias("orders_count"), F.avg("quantity").alias("avg_quantity")))


def authors_stats(spark: SparkSession, sf_dir: str, variant: str = "main") -> str:
    """Gold table: ``author_windows`` of the ``books_sales`` stream (STR-3). Windows that the
    watermark has closed are appended; a later run goes on with new sales only."""
    root = _root(spark, sf_dir, variant)
    out, sales = f"{root}/gold/authors_stats", books_sales(spark, sf_dir, variant)
    stream = spark.readStream.schema(spark.read.parquet(sales).schema).parquet(sales)
    closed = author_windows(stream.withWatermark("order_timestamp", "10 minutes"))
    drain(closed.writeStream.outputMode("append"), f"{root}/_checkpoints/authors_stats", to_path=out)
    return out


# ---------------------------------------------------------------------------
# Governance: delete requests and their propagation (GOV-5/6, CDC-10/11)

def delete_requests(spark: SparkSession, sf_dir: str, variant: str = "gov") -> VersionedTable:
    """Delete requests from the customers topic: one row per delete event, a
    30-day deadline and status ``requested`` (stream append)."""
    root = _root(spark, sf_dir, variant)
    table = VersionedTable(spark, f"{root}/delete_requests", DELETE_REQUESTS_SCHEMA,
                           keys=["customer_id"])
    table.create_if_absent()
    reqs = (parse_topic(bronze_stream(spark, ensure_bronze(spark, sf_dir)), "customers")
            .filter("row_status = 'delete'")
            .select("customer_id", F.col("row_time").alias("request_timestamp"),
                    F.date_add("row_time", 30).alias("deadline"),
                    F.lit("requested").alias("status")))

    def append(mb: DataFrame, batch_id: int) -> None:
        table.insert(mb, writer="delete_requests_append", batch_id=batch_id)

    drain(reqs.writeStream.outputMode("append").foreachBatch(append),
          f"{root}/_checkpoints/delete_requests")
    return table


def propagate_deletes(spark: SparkSession, sf_dir: str, variant: str = "gov"):
    """Delete requested customers from customers_silver, then stream its change
    feed and, per micro-batch, delete those customers from customers_orders and
    mark their requests ``deleted``, both writes keyed by the batch id. The delete is keyed by
    the newest version with requests: run again, it takes those that have come since."""
    root = _root(spark, sf_dir, variant)
    cs = customers_silver(spark, sf_dir, variant)
    co = customers_orders(spark, sf_dir, variant)
    dr = delete_requests(spark, sf_dir, variant)
    requested = dr.read().filter("status = 'requested'")
    cs.merge(lambda cur: cdc.delete_by_keys(cur, requested, ["customer_id"]), writer="delete_customers",
             batch_id=dr.latest_version("delete_requests_append"), source=requested)

    def process_deletes(mb: DataFrame, batch_id: int) -> None:
        with kept(mb) as mb:
            deletes = mb.filter("_change_type = 'delete'").select("customer_id")
            co.merge(lambda cur: cdc.delete_by_keys(cur, deletes, ["customer_id"]),
                     writer="process_deletes", batch_id=batch_id, source=deletes)
            dr.merge(lambda cur: cdc.update_matched(cur, deletes, ["customer_id"],
                                                    {"status": F.lit("deleted")}),
                     writer="process_deletes", batch_id=batch_id, source=deletes)

    # version 0 is the content of the main table
    drain(cs.change_stream(start=1).writeStream.foreachBatch(process_deletes), f"{root}/_checkpoints/deletes")
    return cs, co, dr


# ---------------------------------------------------------------------------
# Books: type 2 history maintained by streams over stepped landings (CDC-5, CDC-8)

BOOKS_SILVER_SCHEMA = ("book_id BIGINT, title STRING, author STRING, price DOUBLE, "
                       "current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP")
BOOKS_AUTO_SCHEMA = ("book_id BIGINT, title STRING, author STRING, price DOUBLE, "
                     "is_quarantined BOOLEAN, __START_AT TIMESTAMP, __END_AT TIMESTAMP, "
                     "__SEQ TIMESTAMP, __DELETED BOOLEAN")


def books_scd2_stream(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """books_silver kept by the staged SCD2 merge in ``foreachBatch`` (CDC-5)."""
    from ..sources.bookstore import BOOKS_SCHEMA, books_payload
    prepare(spark)
    root = _root(spark, sf_dir, "main")
    table = VersionedTable(spark, f"{root}/books_silver_scd2", BOOKS_SILVER_SCHEMA, keys=["book_id"])
    table.create_if_absent()

    def type2_upsert(mb: DataFrame, batch_id: int) -> None:
        with kept(mb) as mb:
            table.merge(lambda cur: cdc.scd2_merge(cur, mb, "book_id", "updated", of_batch=True),
                        writer="books_scd2", batch_id=batch_id, source=mb)

    landing = f"{root}/landing/books-scd2"
    _stepped(spark, books_payload(spark, sf_dir), "updated", landing, lambda: drain(
        _landed(spark, landing, BOOKS_SCHEMA).writeStream.foreachBatch(type2_upsert), f"{root}/_checkpoints/books_scd2"))
    return table


def books_auto_cdc_stream(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """books_silver kept by AUTO CDC SCD2 in ``foreachBatch`` (CDC-8): each batch
    re-sequences only the books it touches."""
    from ..operators import quality
    from ..sources.bookstore import BOOKS_SCHEMA, books_payload
    prepare(spark)
    root = _root(spark, sf_dir, "main")
    table = VersionedTable(spark, f"{root}/books_silver_auto", BOOKS_AUTO_SCHEMA, keys=["book_id"])
    table.create_if_absent()
    cols = [c.split()[0] for c in BOOKS_AUTO_SCHEMA.split(", ")]

    def auto_cdc(mb: DataFrame, batch_id: int) -> None:
        with kept(quality.quarantine_flag(mb, bs.BOOK_RULES)) as mb:

            def fn(cur):
                new = cdc.apply_changes_scd2(cur, mb, ["book_id"], "updated",
                                             except_columns=["updated"]).select(*cols)
                return cdc.MergeResult(new, cdc.snapshot_changes(cur, new, ["book_id", "__SEQ"]))

            table.merge(fn, writer="books_auto_cdc", batch_id=batch_id, source=mb)

    landing = f"{root}/landing/books-auto"
    _stepped(spark, books_payload(spark, sf_dir), "updated", landing, lambda: drain(
        _landed(spark, landing, BOOKS_SCHEMA).writeStream.foreachBatch(auto_cdc), f"{root}/_checkpoints/books_auto"))
    return table
