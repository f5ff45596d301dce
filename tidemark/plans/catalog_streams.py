"""Registered streaming, change-feed and governance queries (see catalog.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import ltz
from ..operators import changes as ch
from ..operators import cdc
from ..session import path_exists, table_root
from ..sources.tables import table_path
from ..streaming.batches import BatchLog
from ..streaming.runner import drain
from . import streams as st
from .catalog import query
from .oracle_fragments import (BOOKS_P, BOOKS_RAW, BOOKS_SCD2, CUST_P, CUST_SILVER, LINES_P,
                               ORDERS_P, with_)

# Customer CDC steps (STEP_DAYS days, version = step ordinal, version 0 = CREATE).
CUST_STEPS = f"""cust_s AS (
  SELECT c.*, n.n_name AS country,
         CAST(floor(datediff('day', (SELECT min(CAST(row_time AS DATE)) FROM cust_p),
                                CAST(row_time AS DATE)) / {st.STEP_DAYS}) AS INT) AS step
  FROM cust_p c JOIN nation n ON c.country_code = n.n_nationkey),
step_v AS (SELECT step, CAST(dense_rank() OVER (ORDER BY step) AS BIGINT) AS version
           FROM (SELECT DISTINCT step FROM cust_s)),
cust_lat AS (
  SELECT s.*, v.version FROM cust_s s JOIN step_v v USING (step)
  WHERE row_status IN ('insert', 'update')
  QUALIFY rank() OVER (PARTITION BY customer_id, step ORDER BY row_time DESC) = 1),
cust_seq AS (
  SELECT *, row_number() OVER w AS rn, lag(balance) OVER w AS p_balance,
         lag(row_time) OVER w AS p_row_time
  FROM cust_lat WINDOW w AS (PARTITION BY customer_id ORDER BY step)),
feed AS (
  SELECT customer_id, balance, country, row_time, 'insert' AS _change_type,
         version AS _commit_version FROM cust_seq WHERE rn = 1
  UNION ALL SELECT customer_id, p_balance, country, p_row_time, 'update_preimage', version
            FROM cust_seq WHERE rn > 1
  UNION ALL SELECT customer_id, balance, country, row_time, 'update_postimage', version
            FROM cust_seq WHERE rn > 1)"""

TRAVEL_V = 3


def _state_at(v: int) -> str:
    return f"""state_{v} AS (
  SELECT customer_id, balance, country, row_time FROM cust_lat WHERE version <= {v}
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version DESC) = 1)"""


FINAL = """final AS (SELECT customer_id, balance, country, row_time FROM cust_silver)"""
FEED_SQL = with_(CUST_P, CUST_STEPS)


# --------------------------------------------------------------------------
# foreachBatch upsert stream and its change feed

@query("cdc_upsert_stream", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, email, name, segment, balance, country, row_time FROM cust_silver""")
def cdc_upsert_stream(spark, sf_dir):
    """customers_silver built by a CDC stream + foreachBatch rank/upsert."""
    return st.customers_silver(spark, sf_dir).read()


@query("change_feed", FEED_SQL + "SELECT * FROM feed")
def change_feed(spark, sf_dir):
    """Change rows (insert / update pre- and post-images) of every version."""
    return st.customers_silver(spark, sf_dir).changes(start=1).select(
        "customer_id", "balance", "country", "row_time", "_change_type", "_commit_version")


@query("table_changes_from", FEED_SQL + "SELECT * FROM feed WHERE _commit_version >= 2")
def table_changes_from(spark, sf_dir):
    """``table_changes(t, 2)``: the feed from version 2, inclusive."""
    return st.customers_silver(spark, sf_dir).changes(start=2).select(
        "customer_id", "balance", "country", "row_time", "_change_type", "_commit_version")


@query("table_changes_since", FEED_SQL + "SELECT * FROM feed WHERE _commit_version >= 2")
def table_changes_since(spark, sf_dir):
    """``table_changes(t, <time>)``: the feed from the time of a commit, here that of version 2."""
    t = st.customers_silver(spark, sf_dir)
    since = t.changes(start=2, end=2).agg(F.min("_commit_timestamp")).first()[0]
    if since is None:
        return t.changes(start=2).select("customer_id", "balance", "country", "row_time", "_change_type", "_commit_version")
    return t.changes(start=1, since=since).select(
        "customer_id", "balance", "country", "row_time", "_change_type", "_commit_version")


@query("change_history", FEED_SQL + """
SELECT _commit_version, _change_type, count(*) AS n FROM feed GROUP BY ALL""")
def change_history(spark, sf_dir):
    """Per version and change type: number of changed rows."""
    return ch.change_history(st.customers_silver(spark, sf_dir).changes(start=1))


@query("time_travel", FEED_SQL + "," + _state_at(TRAVEL_V) + f" SELECT * FROM state_{TRAVEL_V}")
def time_travel(spark, sf_dir):
    """Read an older version of the table."""
    return st.customers_silver(spark, sf_dir).read(TRAVEL_V).select(
        "customer_id", "balance", "country", "row_time")


@query("snapshot_diff", with_(CUST_P, CUST_STEPS, _state_at(TRAVEL_V), CUST_SILVER, FINAL) + f"""
SELECT n.customer_id, n.balance, n.country, n.row_time, 'insert' AS _change_type
FROM final n LEFT JOIN state_{TRAVEL_V} o USING (customer_id) WHERE o.customer_id IS NULL
UNION ALL
SELECT o.customer_id, o.balance, o.country, o.row_time, 'delete'
FROM state_{TRAVEL_V} o LEFT JOIN final n USING (customer_id) WHERE n.customer_id IS NULL
UNION ALL
SELECT o.customer_id, o.balance, o.country, o.row_time, 'update_preimage'
FROM state_{TRAVEL_V} o JOIN final n USING (customer_id)
WHERE o.balance IS DISTINCT FROM n.balance OR o.country IS DISTINCT FROM n.country
   OR o.row_time IS DISTINCT FROM n.row_time
UNION ALL
SELECT n.customer_id, n.balance, n.country, n.row_time, 'update_postimage'
FROM state_{TRAVEL_V} o JOIN final n USING (customer_id)
WHERE o.balance IS DISTINCT FROM n.balance OR o.country IS DISTINCT FROM n.country
   OR o.row_time IS DISTINCT FROM n.row_time""")
def snapshot_diff(spark, sf_dir):
    """Changes between an old version and the latest one, by key."""
    t = st.customers_silver(spark, sf_dir)
    cols = ["customer_id", "balance", "country", "row_time"]
    return ch.snapshot_diff(t.read(TRAVEL_V).select(*cols), t.read().select(*cols), ["customer_id"])


@query("except_versions", with_(CUST_P, CUST_STEPS, _state_at(TRAVEL_V), CUST_SILVER, FINAL) + f"""
SELECT * FROM state_{TRAVEL_V} EXCEPT SELECT * FROM final""")
def except_versions(spark, sf_dir):
    """``SELECT * FROM t@v3 EXCEPT SELECT * FROM t``: rows superseded since v3."""
    t = st.customers_silver(spark, sf_dir)
    cols = ["customer_id", "balance", "country", "row_time"]
    return ch.rows_removed_since(t.read(TRAVEL_V).select(*cols), t.read().select(*cols))


# --------------------------------------------------------------------------
# Stream joins

@query("stream_stream_join", with_(ORDERS_P, CUST_P, CUST_SILVER) + """
SELECT o.order_id, o.customer_id, o.quantity, o.total, o.n_books, s.email, s.name, s.balance,
       s.country, s.row_time
FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id WHERE o.quantity > 0""")
def stream_stream_join(spark, sf_dir):
    """customers_orders: orders stream ⋈ customers change feed stream, upserted."""
    return st.customers_orders(spark, sf_dir).read().select(
        "order_id", "customer_id", "quantity", "total", F.size("books").cast("bigint").alias("n_books"),
        "email", "name", "balance", "country", "row_time")


@query("stream_static_join", with_(ORDERS_P, LINES_P, BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + """
SELECT o.order_id, o.customer_id, o.quantity, l.book_id, l.book_quantity, l.subtotal,
       b.title, b.author, b.price
FROM orders_p o JOIN lines_p l ON o.order_id = l.order_id
JOIN books_silver b ON l.book_id = b.book_id AND b.__END_AT IS NULL
WHERE o.quantity > 0""")
def stream_static_join(spark, sf_dir):
    """books_sales: orders stream exploded ⋈ current_books re-read per batch."""
    return spark.read.parquet(st.books_sales(spark, sf_dir)).select(
        "order_id", "customer_id", "quantity", F.col("book.book_id").alias("book_id"),
        F.col("book.quantity").alias("book_quantity"), F.col("book.subtotal").alias("subtotal"),
        "title", "author", "price")


# --------------------------------------------------------------------------
# Streaming dedup and event-time windows over the given tables

def _table_stream(spark, sf_dir, name):
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(sf_dir))


def _run_to_parquet(spark, sf_dir, name, df, mode="append"):
    """Drain a streaming query into a Parquet folder (what is new since its last run) and return a batch read."""
    out = f"{table_root(spark, sf_dir)}/{name}"
    drain(df.writeStream.outputMode(mode), f"{out}-checkpoint", to_path=out)
    return spark.read.parquet(out)


@query("dedup_stream", "SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def dedup_stream(spark, sf_dir):
    """Streaming dropDuplicates with a watermark on the event-time key column."""
    s = ltz(_table_stream(spark, sf_dir, "lineitem"))
    d = (s.withWatermark("l_shipdate", "30 seconds")
         .dropDuplicates(["l_orderkey", "l_linenumber", "l_shipdate"])
         .select("l_orderkey", "l_linenumber", "l_shipdate"))
    return _run_to_parquet(spark, sf_dir, "dedup_stream", d)


@query("insert_only_merge", """
SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def insert_only_merge(spark, sf_dir):
    """Insert-only MERGE of a deduplicated stream into a table holding the
    pre-1998 rows: only new keys are appended (the change rows returned)."""
    from ..sources.tables import load
    keys = ["l_orderkey", "l_linenumber", "l_shipdate"]
    out = f"{table_root(spark, sf_dir)}/insert_only"
    seed = ltz(load(spark, sf_dir, "lineitem").select(*keys)).filter(
        "l_shipdate < TIMESTAMP'1998-01-01'").dropDuplicates()
    if not path_exists(spark, f"{out}/target/_SUCCESS"):  # create if absent
        seed.write.mode("overwrite").parquet(f"{out}/target")
    s = (ltz(_table_stream(spark, sf_dir, "lineitem")).withWatermark("l_shipdate", "30 seconds")
         .dropDuplicates(keys).select(*keys))
    log = BatchLog(spark, f"{out}/appended", s.schema)

    def upsert_data(mb, batch_id):
        earlier = log.read().filter(F.col("batch") < batch_id).select(*keys)  # a torn try of this batch is not read
        target = spark.read.parquet(f"{out}/target").unionByName(earlier)
        log.append(cdc.insert_only(target, mb, keys).changes, batch_id)

    drain(s.writeStream.foreachBatch(upsert_data), f"{out}/checkpoint")
    return log.read().select(*keys)


WINDOW_SQL = """
SELECT event_type AS author, time_bucket(INTERVAL 5 MINUTE, ts{off}) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts{off}) + INTERVAL 5 MINUTE AS window_end,
       count(event_id) AS orders_count, round(avg(value), 6) AS avg_quantity
FROM events GROUP BY ALL"""


@query("authors_window_stream", "SELECT * FROM (" + WINDOW_SQL.format(off="") + """)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def authors_window_stream(spark, sf_dir):
    """5-minute tumbling windows per key with a 10-minute watermark, append
    mode: only windows closed by the watermark are emitted."""
    s = ltz(_table_stream(spark, sf_dir, "events"))
    agg = (s.withWatermark("ts", "10 minutes")
           .groupBy(F.window("ts", "5 minutes").alias("time"), F.col("event_type").alias("author"))
           .agg(F.count("event_id").alias("orders_count"), F.avg("value").alias("avg_quantity")))
    out = _run_to_parquet(spark, sf_dir, "authors_stats", agg)
    return out.select("author", F.col("time.start").alias("window_start"),
                      F.col("time.end").alias("window_end"), "orders_count",
                      F.round("avg_quantity", 6).alias("avg_quantity"))


@query("authors_window_offset", WINDOW_SQL.format(off=", INTERVAL 2 MINUTE"))
def authors_window_offset(spark, sf_dir):
    """Batch tumbling windows with a 2-minute start offset."""
    from ..sources.tables import load
    e = ltz(load(spark, sf_dir, "events"))
    w = F.window("ts", "5 minutes", "5 minutes", "2 minutes")
    return (e.groupBy(F.col("event_type").alias("author"), w.alias("window"))
            .agg(F.count("event_id").alias("orders_count"),
                 F.round(F.avg("value"), 6).alias("avg_quantity"))
            .select("author", F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "orders_count", "avg_quantity"))


@query("streaming_sql_view", with_(CUST_P) + """
SELECT customer_id, balance, row_time FROM cust_p WHERE row_status = 'update' AND balance > 250""")
def streaming_sql_view(spark, sf_dir):
    """Streaming temp view queried with SQL, back to a stream writer."""
    from ..sources.bookstore import parse_topic
    from ..sources.ingest import bronze_stream, ensure_bronze
    s = parse_topic(bronze_stream(spark, ensure_bronze(spark, sf_dir)), "customers")
    s.createOrReplaceTempView("customers_stream_tmp")
    v = spark.sql("""SELECT customer_id, balance, row_time FROM customers_stream_tmp
                     WHERE row_status = 'update' AND balance > 250""")
    return _run_to_parquet(spark, sf_dir, "streaming_sql_view", v)


# --------------------------------------------------------------------------
# Governance

DELETE_REQ = """reqs AS (
  SELECT customer_id, row_time AS request_timestamp,
         CAST(row_time + INTERVAL 30 DAY AS DATE) AS deadline
  FROM cust_p WHERE row_status = 'delete')"""


@query("delete_requests", with_(CUST_P, DELETE_REQ) + "SELECT * FROM reqs")
def delete_requests(spark, sf_dir):
    """Delete requests stream: one row per delete event, 30-day deadline."""
    return st.delete_requests(spark, sf_dir).read().select(
        "customer_id", "request_timestamp", "deadline")


@query("delete_propagation", with_(CUST_P, DELETE_REQ, CUST_SILVER) + """
SELECT r.*, CASE WHEN r.customer_id IN (SELECT customer_id FROM cust_silver)
                 THEN 'deleted' ELSE 'requested' END AS status
FROM reqs r""")
def delete_propagation(spark, sf_dir):
    """Requests after the delete was propagated through the change feed."""
    _, _, dr = st.propagate_deletes(spark, sf_dir)
    return dr.read()


@query("delete_propagation_orders", with_(ORDERS_P, CUST_P, CUST_SILVER, DELETE_REQ) + """
SELECT o.order_id, o.customer_id FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id
WHERE o.quantity > 0 AND o.customer_id NOT IN (SELECT customer_id FROM reqs)""")
def delete_propagation_orders(spark, sf_dir):
    """customers_orders after deletes propagated from customers_silver."""
    _, co, _ = st.propagate_deletes(spark, sf_dir)
    return co.read().select("order_id", "customer_id")


@query("erase_history", with_(CUST_P, CUST_STEPS, DELETE_REQ, CUST_SILVER) + """
SELECT customer_id, _change_type, _commit_version FROM feed
WHERE customer_id NOT IN (SELECT r.customer_id FROM reqs r JOIN cust_silver s USING (customer_id))""")
def erase_history(spark, sf_dir):
    """Change feed rewritten without the erased customers' rows."""
    cs, _, _ = st.propagate_deletes(spark, sf_dir)
    erased = cs.changes().filter("_change_type = 'delete'").select("customer_id")
    return ch.erase_keys(st.customers_silver(spark, sf_dir).changes(start=1), erased, ["customer_id"]).select(
        "customer_id", "_change_type", "_commit_version")


SCD2_PRICE_SQL = with_(BOOKS_P) + """,
x AS (SELECT *, row_number() OVER w AS rn, lag(price) OVER w AS p
      FROM books_p WINDOW w AS (PARTITION BY book_id ORDER BY updated)),
v AS (SELECT * FROM x WHERE rn = 1 OR price <> p)
SELECT book_id, title, author, price,
       lead(updated) OVER w2 IS NULL AS current, updated AS effective_date,
       lead(updated) OVER w2 AS end_date
FROM v WINDOW w2 AS (PARTITION BY book_id ORDER BY updated)"""


@query("scd2_stream", SCD2_PRICE_SQL)
def scd2_stream(spark, sf_dir):
    """Type 2 history kept by a stream of landed updates (staged merge per
    micro-batch): equal to the one-batch result since updates arrive in order."""
    return st.books_scd2_stream(spark, sf_dir).read()


@query("auto_cdc_scd2_stream", with_(BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + "SELECT * FROM books_silver")
def auto_cdc_scd2_stream(spark, sf_dir):
    """AUTO CDC SCD2 kept by a stream of landed updates, one version per batch."""
    return cdc.scd2_rows(st.books_auto_cdc_stream(spark, sf_dir).read())


@query("erase_report", with_(CUST_P, CUST_STEPS, DELETE_REQ, CUST_SILVER) + """
SELECT _commit_version, _change_type, count(*) AS removed FROM feed
WHERE customer_id IN (SELECT r.customer_id FROM reqs r JOIN cust_silver s USING (customer_id))
GROUP BY ALL""")
def erase_report(spark, sf_dir):
    """Change rows that erasure removes from the history, per version and type."""
    cs, _, _ = st.propagate_deletes(spark, sf_dir)
    erased = cs.changes().filter("_change_type = 'delete'").select("customer_id").distinct()
    feed = st.customers_silver(spark, sf_dir).changes(start=1)
    return (feed.join(erased, "customer_id", "left_semi")
            .groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("removed")))


@query("delete_propagation_changes", with_(ORDERS_P, CUST_P, CUST_SILVER, DELETE_REQ) + """
SELECT o.order_id, o.customer_id, 'delete' AS _change_type
FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id
WHERE o.quantity > 0 AND o.customer_id IN (SELECT customer_id FROM reqs)""")
def delete_propagation_changes(spark, sf_dir):
    """Delete rows the propagation committed to customers_orders' change feed."""
    _, co, _ = st.propagate_deletes(spark, sf_dir)
    return (co.changes(start=1).filter("_change_type = 'delete'")
            .select("order_id", "customer_id", "_change_type"))


# --------------------------------------------------------------------------
# Gold statistics over books_sales

SALES = """sales AS (
  SELECT o.order_id, o.order_timestamp AS t, o.quantity, b.author
  FROM orders_p o JOIN lines_p l ON o.order_id = l.order_id
  JOIN books_silver b ON l.book_id = b.book_id AND b.__END_AT IS NULL
  WHERE o.quantity > 0)"""
SALES_CTES = (ORDERS_P, LINES_P, BOOKS_P, BOOKS_RAW, BOOKS_SCD2, SALES)
SALES_WINDOWS = """
SELECT author, time_bucket(INTERVAL 5 MINUTE, CAST(t AS TIMESTAMP){off}) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, CAST(t AS TIMESTAMP){off}) + INTERVAL 5 MINUTE AS window_end,
       count(order_id) AS orders_count, round(avg(quantity), 6) AS avg_quantity
FROM sales GROUP BY ALL"""


def _window_columns(stats):
    return stats.select("author", F.col("time.start").alias("window_start"), F.col("time.end").alias("window_end"),
                        "orders_count", F.round("avg_quantity", 6).alias("avg_quantity"))


@query("authors_stats", with_(*SALES_CTES) + "SELECT * FROM (" + SALES_WINDOWS.format(off="") + """)
WHERE window_end <= (SELECT max(CAST(t AS TIMESTAMP)) FROM sales) - INTERVAL 10 MINUTE""")
def authors_stats(spark, sf_dir):
    """The gold table kept by a stream over books_sales: closed windows per author."""
    return _window_columns(spark.read.parquet(st.authors_stats(spark, sf_dir)))


@query("authors_stats_offset", with_(*SALES_CTES) + SALES_WINDOWS.format(off=", INTERVAL 2 MINUTE")
       + " ORDER BY window_start, author")
def authors_stats_offset(spark, sf_dir):
    """All windows of books_sales, which start two minutes later, in order of time and author."""
    sales = spark.read.parquet(st.books_sales(spark, sf_dir))
    return _window_columns(st.author_windows(sales, "2 minutes")).orderBy("window_start", "author")


# --------------------------------------------------------------------------
# Land, run, land more, run again; AUTO CDC over batches

RERUN_CUT = "2024-01-16"


@query("incremental_rerun", with_(ORDERS_P, CUST_P, BOOKS_P) + f"""
SELECT topic, year_month, count(*) FILTER (t < TIMESTAMP '{RERUN_CUT}') AS n_first, count(*) AS n FROM (
  SELECT 'orders' AS topic, order_timestamp AS t, strftime(order_timestamp, '%Y-%m') AS year_month FROM orders_p
  UNION ALL SELECT 'customers', row_time, strftime(row_time, '%Y-%m') FROM cust_p
  UNION ALL SELECT 'books', updated, strftime(updated, '%Y-%m') FROM books_p)
GROUP BY ALL""")
def incremental_rerun(spark, sf_dir):
    """Messages before a date are landed and ingested, then the others: the second run of the
    same stream takes the new files only. Rows in bronze after the first run and after both."""
    from ..session import dataset_tag, fresh_path
    from ..sources.bookstore import raw_envelopes
    from ..sources.ingest import ingest_bronze, read_bronze
    base = fresh_path(spark, "rerun", dataset_tag(spark, sf_dir))
    early = F.col("timestamp") < F.unix_millis(F.lit(RERUN_CUT).cast("timestamp"))
    for step, part in enumerate((early, ~early)):
        raw_envelopes(spark, sf_dir).filter(part).write.json(f"{base}/landing/step={step}")
        ingest_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
        (read_bronze(spark, f"{base}/bronze").groupBy("topic", "year_month").agg(F.count(F.lit(1)).alias("n"))
         .write.parquet(f"{base}/count={step}"))
    first = spark.read.parquet(f"{base}/count=0").withColumnRenamed("n", "n_first")
    return (spark.read.parquet(f"{base}/count=1").join(first, ["topic", "year_month"], "left")
            .select("topic", "year_month", F.coalesce("n_first", F.lit(0)).alias("n_first"), "n"))


N_BATCHES = 3


def _customer_batches(spark, sf_dir):
    """The customer changes dealt to batches by hash: each batch holds rows that are older than
    those of batches before it, deletes among them. Balances in steps of 250 repeat."""
    from ..sources.bookstore import customers_payload
    c = customers_payload(spark, sf_dir).select(
        "customer_id", F.floor(F.col("balance") / 250).cast("bigint").alias("tier"), "row_status", "row_time")
    for b in range(N_BATCHES):
        yield c.filter(F.pmod(F.xxhash64("customer_id", "row_time"), F.lit(N_BATCHES)) == b)


TIERS = """tiers AS (
  SELECT customer_id, CAST(floor(balance / 250) AS BIGINT) AS tier, row_status = 'delete' AS del, row_time
  FROM cust_p)"""


@query("auto_cdc_scd1_batches", with_(CUST_P, TIERS) + """
SELECT customer_id, tier FROM tiers
QUALIFY rank() OVER (PARTITION BY customer_id ORDER BY row_time DESC) = 1 AND NOT del""")
def auto_cdc_scd1_batches(spark, sf_dir):
    """AUTO CDC SCD1 over three batches with late rows and deletes: equal to one batch."""
    stored = None
    for mb in _customer_batches(spark, sf_dir):
        stored = cdc.apply_changes_scd1(stored, mb, ["customer_id"], "row_time",
                                        except_columns=["row_status", "row_time"],
                                        delete_when="row_status = 'delete'")
    return cdc.scd1_rows(stored)


@query("auto_cdc_scd2_batches", with_(CUST_P, TIERS) + """,
x AS (SELECT *, row_number() OVER w AS rn, lag(tier) OVER w AS p, lag(del) OVER w AS p_del
      FROM tiers WINDOW w AS (PARTITION BY customer_id ORDER BY row_time)),
v AS (SELECT * FROM x WHERE del OR rn = 1 OR p_del OR tier IS DISTINCT FROM p)
SELECT customer_id, tier, row_time AS __START_AT, e AS __END_AT FROM (
  SELECT *, lead(row_time) OVER (PARTITION BY customer_id ORDER BY row_time) AS e FROM v)
WHERE NOT del""")
def auto_cdc_scd2_batches(spark, sf_dir):
    """AUTO CDC SCD2 over three batches with late rows and deletes: equal to one batch."""
    stored = None
    for mb in _customer_batches(spark, sf_dir):
        stored = cdc.apply_changes_scd2(stored, mb, ["customer_id"], "row_time",
                                        except_columns=["row_status", "row_time"],
                                        delete_when="row_status = 'delete'")
    return cdc.scd2_rows(stored)
