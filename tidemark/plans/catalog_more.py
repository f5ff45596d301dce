"""Registered UDF, governance, maintenance and ingest-robustness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import governance as gov
from ..operators import maintenance as mnt
from ..session import dataset_tag, fresh_path, path_exists, table_root, work_path
from ..sources import ingest, robust
from ..sources.tables import TABLES, load
from . import bookstore as bs
from . import streams as st
from .catalog import query
from .oracle_fragments import (BOOKS_P, BOOKS_RAW, BOOKS_SCD2, CUST_P, CUST_SILVER,
                               ORDERS_P, with_)

BOOKS_SILVER_SQL = with_(BOOKS_P, BOOKS_RAW, BOOKS_SCD2)


# --------------------------------------------------------------------------
# UDFs over books_silver

@query("udf_discount", BOOKS_SILVER_SQL + """
SELECT book_id, __START_AT, price, CAST(price * (1 - 50 / 100) AS VARCHAR) AS price_after_discount
FROM books_silver""")
def udf_discount(spark, sf_dir):
    """Untyped row UDF (result STRING) with a literal argument."""
    b = bs.books_silver(spark, sf_dir)
    return b.select("book_id", "__START_AT", "price",
                    udfs.apply_discount_udf()(F.col("price"), F.lit(50)).alias("price_after_discount"))


@query("udf_discount_sql", BOOKS_SILVER_SQL + """
SELECT book_id, __START_AT, price, CAST(price * (1 - 50 / 100) AS VARCHAR) AS price_after_discount
FROM books_silver""")
def udf_discount_sql(spark, sf_dir):
    """The same function registered for SQL and called from SQL."""
    udfs.register_sql_udfs(spark)
    bs.books_silver(spark, sf_dir).createOrReplaceTempView("books_silver_v")
    return spark.sql("""SELECT book_id, __START_AT, price,
                               apply_discount_sql_udf(price, 50) AS price_after_discount
                        FROM books_silver_v""")


@query("udf_typed", BOOKS_SILVER_SQL + """
SELECT book_id, __START_AT, price, price * (1 - 50 / 100) AS price_after_discount FROM books_silver""")
def udf_typed(spark, sf_dir):
    """Decorator UDF declared as DOUBLE."""
    b = bs.books_silver(spark, sf_dir)
    return b.select("book_id", "__START_AT", "price",
                    udfs.apply_discount_decorator_udf()(F.col("price"), F.lit(50)).alias("price_after_discount"))


@query("pandas_udf_discount", BOOKS_SILVER_SQL + """
SELECT book_id, __START_AT, price, price * (1 - 50 / 100) AS price_after_discount FROM books_silver""")
def pandas_udf_discount(spark, sf_dir):
    """Vectorized pandas UDF, called from SQL after registration."""
    udfs.register_sql_udfs(spark)
    bs.books_silver(spark, sf_dir).createOrReplaceTempView("books_silver_v")
    return spark.sql("""SELECT book_id, __START_AT, price,
                               sql_vectorized_udf(price, 50) AS price_after_discount
                        FROM books_silver_v""")


@query("apply_in_pandas_avg", with_(ORDERS_P, CUST_P, CUST_SILVER) + """
SELECT s.country, round(avg(o.quantity), 6) AS avg_quantity
FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id
WHERE o.quantity > 0 GROUP BY s.country""")
def apply_in_pandas_avg(spark, sf_dir):
    """Average order quantity per country of customers_orders, pandas per batch."""
    co = st.customers_orders(spark, sf_dir).read()
    return udfs.grouped_mean(co, "country", "quantity", "avg_quantity").select(
        "country", F.round("avg_quantity", 6).alias("avg_quantity"))


# --------------------------------------------------------------------------
# Governance views over customers_silver (caller in no group)

def _customers_view(spark, sf_dir):
    gov.set_groups(spark, [])
    st.customers_silver(spark, sf_dir).read().createOrReplaceTempView("customers_silver_v")


@query("redacted_view", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, 'REDACTED' AS email, 'REDACTED' AS name, segment, country, row_time
FROM cust_silver""")
def redacted_view(spark, sf_dir):
    """Dynamic view: PII columns redacted for callers outside the admin group."""
    _customers_view(spark, sf_dir)
    df = spark.table("customers_silver_v").select(
        "customer_id", "email", "name", "segment", "country", "row_time")
    return gov.redact(df, ["email", "name"], "admins_demo")


@query("row_filtered_view", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, 'REDACTED' AS email, 'REDACTED' AS name, segment, country, row_time
FROM cust_silver WHERE country = 'NATION_6' AND row_time > TIMESTAMP '2024-01-29'""")
def row_filtered_view(spark, sf_dir):
    """Dynamic view layered on the redacted one, restricting rows by group."""
    _customers_view(spark, sf_dir)
    df = gov.redact(spark.table("customers_silver_v").select(
        "customer_id", "email", "name", "segment", "country", "row_time"), ["email", "name"], "admins_demo")
    return gov.restrict_rows(df, "admins_demo",
                             "country = 'NATION_6' AND row_time > '2024-01-29'")


@query("mask_udf", with_(CUST_P, CUST_SILVER) + """
SELECT customer_id, 'REDACTED' AS email, name, segment, balance, country, row_time
FROM cust_silver WHERE country = 'NATION_6'""")
def mask_udf(spark, sf_dir):
    """Column mask and row filter SQL functions applied through a secured view."""
    _customers_view(spark, sf_dir)
    gov.create_mask_function(spark, "email_mask", "admins_demo")
    gov.create_row_filter_function(spark, "fr_filter", "admins_demo", "country STRING",
                                   "country = 'NATION_6'")
    return gov.secured_view(spark, "customers_silver_v", "customers_secured",
                            masks={"email": "email_mask"}, row_filter=("fr_filter", ["country"]))


# --------------------------------------------------------------------------
# Maintenance

@query("table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_profile(spark, sf_dir):
    """Row count of every table in the schema."""
    return mnt.table_profile({t: load(spark, sf_dir, t) for t in TABLES})


@query("file_stats", """
SELECT 'lineitem.parquet' AS file_name, count(*) AS num_records,
       min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate,
       count_if(l_shipdate IS NULL) AS nulls_l_shipdate,
       min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
       count_if(l_quantity IS NULL) AS nulls_l_quantity
FROM lineitem""")
def file_stats(spark, sf_dir):
    """Per-file record count, min, max and null count of chosen columns."""
    return mnt.file_stats(load(spark, sf_dir, "lineitem"), ["l_shipdate", "l_quantity"])


@query("partition_layout", with_(ORDERS_P, CUST_P, BOOKS_P) + """
SELECT topic, count(DISTINCT year_month) AS partitions, count(*) AS n FROM (
  SELECT 'orders' AS topic, strftime(order_timestamp, '%Y-%m') AS year_month FROM orders_p
  UNION ALL SELECT 'customers', strftime(row_time, '%Y-%m') FROM cust_p
  UNION ALL SELECT 'books', strftime(updated, '%Y-%m') FROM books_p)
GROUP BY topic""")
def partition_layout(spark, sf_dir):
    """Partition directories per topic of bronze and their rows."""
    lay = mnt.partition_layout(bs.bronze(spark, sf_dir), ["topic", "year_month"])
    return lay.groupBy("topic").agg(F.count(F.lit(1)).alias("partitions"),
                                    F.sum("n").alias("n"))


@query("compaction", with_(ORDERS_P, CUST_P, BOOKS_P) + """
SELECT topic, year_month, count(*) AS n FROM (
  SELECT 'orders' AS topic, strftime(order_timestamp, '%Y-%m') AS year_month FROM orders_p
  UNION ALL SELECT 'customers', strftime(row_time, '%Y-%m') FROM cust_p
  UNION ALL SELECT 'books', strftime(updated, '%Y-%m') FROM books_p)
GROUP BY ALL""")
def compaction(spark, sf_dir):
    """Bronze rewritten into one file set per partition; content unchanged."""
    out = f"{table_root(spark, sf_dir)}/bronze_compacted"
    if not path_exists(spark, f"{out}/_SUCCESS"):
        mnt.compact(bs.bronze(spark, sf_dir), out, ["topic", "year_month"])
    return (spark.read.parquet(out).groupBy("topic", "year_month")
            .agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------------------
# Ingest robustness: raw JSON lines derived from events

LINES_SQL = """lines AS (
  SELECT event_id, event_type, value, json_extract_string(props, '$.k') AS k,
    CASE event_type
      WHEN 'error' THEN '{"id": ' || event_id || ', "k": ' || json_extract_string(props, '$.k')
      WHEN 'view' THEN '{"id": ' || event_id || ', "k": "x' || json_extract_string(props, '$.k') || '"}'
      WHEN 'click' THEN '{"id": ' || event_id || '}'
      WHEN 'purchase' THEN '{"id": ' || event_id || ', "k": ' || json_extract_string(props, '$.k')
                           || ', "extra": ' || CAST(value AS VARCHAR) || '}'
      ELSE '{"id": ' || event_id || ', "k": ' || json_extract_string(props, '$.k') || '}'
    END AS line
  FROM events)"""
LINE_SCHEMA = "id BIGINT, k INT"


def json_line():
    """A JSON line per event: error events are truncated (malformed), view events carry a string ``k`` (type
    mismatch), click events lack ``k`` (missing field), purchase events add ``extra``."""
    k = F.get_json_object("props", "$.k")
    i = F.col("event_id").cast("string")
    return (F.when(F.col("event_type") == "error", F.concat(F.lit('{"id": '), i, F.lit(', "k": '), k))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit('{"id": '), i, F.lit(', "k": "x'), k, F.lit('"}')))
            .when(F.col("event_type") == "click", F.concat(F.lit('{"id": '), i, F.lit("}")))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.lit('{"id": '), i, F.lit(', "k": '), k, F.lit(', "extra": '),
                           F.col("value").cast("string"), F.lit("}")))
            .otherwise(F.concat(F.lit('{"id": '), i, F.lit(', "k": '), k, F.lit("}"))))


def raw_lines(spark, sf_dir):
    """``json_line`` of ``events``, landed once."""
    path = work_path(spark, "landing", dataset_tag(spark, sf_dir), "json-lines")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        load(spark, sf_dir, "events").select(json_line().alias("value")).write.mode("overwrite").text(path)
    return spark.read.text(path)


@query("bad_records", with_(LINES_SQL) + """
SELECT line AS _corrupt_record FROM lines WHERE event_type IN ('error', 'view')""")
def bad_records(spark, sf_dir):
    """Malformed and type-mismatched lines captured instead of failing the read."""
    _, bad = robust.split_bad_records(robust.parse_lines(raw_lines(spark, sf_dir), LINE_SCHEMA))
    return bad.filter(F.col(robust.CORRUPT).isNotNull()).select(robust.CORRUPT)


@query("required_fields", with_(LINES_SQL) + """
SELECT CAST(event_id AS BIGINT) AS id FROM lines WHERE event_type = 'click'""")
def required_fields(spark, sf_dir):
    """Well-formed lines missing a required field (the parser accepts them)."""
    parsed = robust.parse_lines(raw_lines(spark, sf_dir), LINE_SCHEMA)
    return parsed.filter(F.col(robust.CORRUPT).isNull() & F.col("k").isNull()).select("id")


@query("rescued_columns", with_(LINES_SQL) + """
SELECT CAST(event_id AS BIGINT) AS id, value AS extra FROM lines WHERE event_type = 'purchase'""")
def rescued_columns(spark, sf_dir):
    """``rescue`` mode: unknown fields kept as JSON in ``_rescued_data``."""
    r = robust.rescue(raw_lines(spark, sf_dir), LINE_SCHEMA)
    return (r.filter(F.col(robust.RESCUED).isNotNull())
            .select("id", F.get_json_object(robust.RESCUED, "$.extra").cast("double").alias("extra")))


@query("schema_add_columns", with_(LINES_SQL) + """
SELECT CAST(event_id AS BIGINT) AS id,
       CASE WHEN event_type = 'click' THEN NULL ELSE CAST(k AS INT) END AS k,
       CASE WHEN event_type = 'purchase' THEN value END AS extra
FROM lines WHERE event_type NOT IN ('error', 'view')""")
def schema_add_columns(spark, sf_dir):
    """``addNewColumns``: the first run fails on ``extra`` and extends the
    stored schema; the rerun parses it."""
    store = robust.SchemaStore(
        spark, f"{table_root(spark, sf_dir)}/json-lines-schema", LINE_SCHEMA)
    lines = raw_lines(spark, sf_dir)
    try:
        parsed = robust.evolve(lines, store, "addNewColumns")
    except robust.UnknownFieldsError:
        parsed = robust.evolve(lines, store, "addNewColumns")
    good, _ = robust.split_bad_records(parsed)
    return good.select("id", "k", F.col("extra").cast("double").alias("extra"))


@query("binary_file_scan", "SELECT page_id, strlen(html) + 1 AS length FROM pages")
def binary_file_scan(spark, sf_dir):
    """Binary-file scan with a name glob over files landed from ``pages``."""
    tag = dataset_tag(spark, sf_dir)
    path = work_path(spark, "landing", tag, "pages")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        ingest.land_files(load(spark, sf_dir, "pages"), "page_id", "html", path)
    page_id = F.nullif(F.regexp_extract("path", r"page_id=(-?\d+)", 1), F.lit("")).cast("bigint")
    return ingest.scan_files(spark, path, "*.txt", lambda files: files.select(page_id.alias("page_id"), "length"),
                             fresh_path(spark, "scans", tag, "pages"))


# --------------------------------------------------------------------------
# More of the inventory: staged SCD2 source, CDC deletes, P4 constraints,
# distinct keys, inferred JSON, rate-limited ingest, schema merge, IN-subquery

CUTOFF = "2024-01-15"


@query("union_staged", with_(BOOKS_P) + f""",
before AS (SELECT * FROM books_p WHERE updated < TIMESTAMP '{CUTOFF}'),
cur AS (SELECT book_id, price FROM before
        QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY updated DESC) = 1),
upd AS (SELECT * FROM books_p WHERE updated >= TIMESTAMP '{CUTOFF}')
SELECT book_id AS merge_key, book_id, price, updated FROM upd
UNION ALL
SELECT NULL AS merge_key, u.book_id, u.price, u.updated
FROM upd u JOIN cur c ON u.book_id = c.book_id WHERE u.price <> c.price""")
def union_staged(spark, sf_dir):
    """The SCD2 staged source: updates keyed by id UNION ALL updates with a NULL
    key where the current row's price differs (SET-1, JOI-6)."""
    raw = bs.books_raw(spark, sf_dir).drop("is_quarantined")
    empty = spark.createDataFrame([], "book_id BIGINT, title STRING, author STRING, price DOUBLE, "
                                      "current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP")
    from ..operators import cdc
    hist = cdc.scd2_merge(empty, raw.filter(F.col("updated") < F.lit(CUTOFF).cast("timestamp")),
                          "book_id", "updated").table
    upd = raw.filter(F.col("updated") >= F.lit(CUTOFF).cast("timestamp"))
    cur = hist.filter("current IS TRUE").select("book_id", F.col("price").alias("cur_price"))
    a = upd.select(F.col("book_id").alias("merge_key"), "book_id", "price", "updated")
    b = (upd.join(cur, "book_id").filter(F.col("price") != F.col("cur_price"))
         .select(F.lit(None).cast("bigint").alias("merge_key"), "book_id", "price", "updated"))
    return a.unionByName(b)


@query("cdc_upsert_with_deletes", with_(CUST_P) + """
SELECT customer_id, balance, row_time FROM cust_p
QUALIFY rank() OVER (PARTITION BY customer_id ORDER BY row_time DESC) = 1
        AND row_status <> 'delete'""")
def cdc_upsert_with_deletes(spark, sf_dir):
    """Upsert with ``WHEN MATCHED AND row_status = 'delete' THEN DELETE``: a
    customer whose newest change is a delete is absent (CDC-4)."""
    from ..operators import cdc
    from ..sources.bookstore import parse_topic
    c = parse_topic(bs.bronze(spark, sf_dir), "customers")
    empty = spark.createDataFrame([], "customer_id BIGINT, balance DOUBLE, row_time TIMESTAMP")
    return cdc.upsert(empty, c, ["customer_id"], "row_time",
                      delete_when=F.col("row_status") == "delete").table


@query("books_sales_quality", with_(ORDERS_P, BOOKS_P, BOOKS_RAW, BOOKS_SCD2) + """,
s AS (SELECT o.order_id, o.order_timestamp, o.total, l.l_extendedprice AS subtotal,
             CAST(l.l_quantity AS BIGINT) AS qty, b.price
      FROM orders_p o JOIN lineitem l ON o.order_id = l.l_orderkey
      JOIN books_silver b ON l.l_partkey = b.book_id AND b.__END_AT IS NULL
      WHERE o.quantity > 0)
SELECT 'valid_subtotal' AS rule, count_if(coalesce(subtotal = qty * price, false)) AS passed_records,
       count_if(NOT coalesce(subtotal = qty * price, false)) AS failed_records, 'books_sales' AS dataset FROM s
UNION ALL
SELECT 'valid_total', count_if(coalesce(total BETWEEN 0 AND 100000, false)),
       count_if(NOT coalesce(total BETWEEN 0 AND 100000, false)), 'books_sales' FROM s
UNION ALL
SELECT 'valid_date', count_if(coalesce(order_timestamp <= current_date AND year(order_timestamp) >= 2020, false)),
       count_if(NOT coalesce(order_timestamp <= current_date AND year(order_timestamp) >= 2020, false)),
       'books_sales' FROM s""")
def books_sales_quality(spark, sf_dir):
    """The books_sales constraints (subtotal vs quantity x price across the
    join, total range, date) as passed / failed counts (FLT-10, QUA-5/6/7)."""
    from ..operators import quality
    rules = {"valid_subtotal": "book.subtotal = book.quantity * price",
             "valid_total": "total BETWEEN 0 AND 100000",
             "valid_date": "order_timestamp <= current_date() AND year(order_timestamp) >= 2020"}
    return quality.expectation_metrics(bs.books_sales(spark, sf_dir), rules, "books_sales")


@query("count_distinct_keys", with_(CUST_P, CUST_SILVER) + """
SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_keys FROM cust_silver""")
def count_distinct_keys(spark, sf_dir):
    """Rows vs distinct keys of customers_silver: the uniqueness assertion (AGG-7)."""
    return st.customers_silver(spark, sf_dir).read().agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("customer_id").alias("n_keys"))


@query("json_inferred_lookup", "SELECT n_nationkey AS code, n_name AS country FROM nation")
def json_inferred_lookup(spark, sf_dir):
    """Batch JSON scan with an inferred schema (the country lookup, SRC-1)."""
    from ..sources.bookstore import country_lookup
    from ..sources.ingest import read_json_batch
    path = work_path(spark, "landing", dataset_tag(spark, sf_dir), "country_lookup")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        country_lookup(spark, sf_dir).write.mode("overwrite").json(path)
    return read_json_batch(spark, path).select("code", "country")


@query("bronze_ingest_limited", with_(ORDERS_P, CUST_P, BOOKS_P) + """
SELECT topic, count(*) AS n FROM (
  SELECT 'orders' AS topic FROM orders_p UNION ALL SELECT 'customers' FROM cust_p
  UNION ALL SELECT 'books' FROM books_p) GROUP BY topic""")
def bronze_ingest_limited(spark, sf_dir):
    """The same ingest with a micro-batch size limit (``maxFilesPerTrigger``):
    several batches, same content (SRC-8)."""
    from ..sources.ingest import ingest_bronze, land_raw
    out = f"{table_root(spark, sf_dir)}/bronze_limited"
    ingest_bronze(spark, land_raw(spark, sf_dir), out, f"{out}-checkpoint", max_files=4)
    return spark.read.parquet(out).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("merge_schema_read", """
SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events""")
def merge_schema_read(spark, sf_dir):
    """Appends with a widened schema read back with ``mergeSchema`` (SNK-3)."""
    path = f"{table_root(spark, sf_dir)}/events_evolving"
    e = load(spark, sf_dir, "events")
    if not path_exists(spark, f"{path}/part=2/_SUCCESS"):
        (e.filter("event_type <> 'purchase'").select("event_id", "event_type")
         .write.mode("overwrite").parquet(f"{path}/part=1"))
        (e.filter("event_type = 'purchase'").select("event_id", "event_type", "value")
         .write.mode("overwrite").parquet(f"{path}/part=2"))
    return (spark.read.option("mergeSchema", "true").parquet(path)
            .select("event_id", "event_type", "value"))


@query("in_subquery_semi", with_(CUST_P, CUST_SILVER) + """,
reqs AS (SELECT customer_id FROM cust_p WHERE row_status = 'delete')
SELECT customer_id, country FROM cust_silver WHERE customer_id IN (SELECT customer_id FROM reqs)""")
def in_subquery_semi(spark, sf_dir):
    """``WHERE k IN (SELECT k FROM requests WHERE status = 'requested')``:
    planned by Catalyst as a left-semi join (FLT-7, JOI-7)."""
    st.customers_silver(spark, sf_dir).read().createOrReplaceTempView("customers_silver_q")
    st.delete_requests(spark, sf_dir).read().createOrReplaceTempView("delete_requests_q")
    return spark.sql("""SELECT customer_id, country FROM customers_silver_q
                        WHERE customer_id IN (SELECT customer_id FROM delete_requests_q
                                              WHERE status = 'requested')""")
