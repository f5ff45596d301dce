"""Registered queries over the flows of ``flows.py`` (see catalog.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog_tables, cdc, quality
from ..operators.changes import rows_removed_since, snapshot_diff
from ..session import table_root
from ..sources.bookstore import orders_payload
from ..sources.robust import RESCUED
from ..sources.tables import TABLES, load
from ..streaming.batches import BatchLog
from ..streaming.table import AppendOnlyViolation, VersionedTable
from . import flows
from .catalog import ORACLE, query
from .catalog_more import LINES_SQL
from .catalog_streams import SALES_CTES, SCD2_PRICE_SQL, WINDOW_SQL
from .oracle_fragments import BOOKS_P, CUST_P, CUST_SILVER, LINES_P, ORDERS_P, with_


@query("stream_stream_join_bounded", with_(ORDERS_P, CUST_P, CUST_SILVER) + """
SELECT o.order_id, o.customer_id, o.quantity, o.total, o.n_books, s.email, s.name, s.balance,
       s.country, s.row_time
FROM orders_p o JOIN cust_silver s ON o.customer_id = s.customer_id WHERE o.quantity > 0""")
def stream_stream_join_bounded(spark, sf_dir):
    """Orders stream ⋈ customers stream over several micro-batches, in state of one row per customer and the
    orders that wait for one."""
    rows, _ = flows.customers_orders_bounded(spark, sf_dir)
    return rows.drop("order_timestamp")


@query("bad_records_stream", with_(LINES_SQL) + """
SELECT event_type AS folder, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'view' THEN 'type mismatch' WHEN 'click' THEN 'missing k' END AS reason,
       CASE WHEN event_type NOT IN ('error', 'view', 'click') THEN event_id END AS id,
       CASE WHEN event_type NOT IN ('error', 'view', 'click') THEN CAST(k AS INT) END AS k,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN line END AS line
FROM lines""")
def bad_records_stream(spark, sf_dir):
    """Good rows and bad lines of a stream, with the file they come from and what is wrong."""
    good, bad = flows.split_lines(spark, sf_dir)
    folder = F.regexp_extract("file", "event_type=([^/]*)/", 1).alias("folder")
    none = F.lit(None).cast("string")
    return good.read().select(folder, none.alias("reason"), "id", "k", none.alias("line")).unionByName(
        bad.read().select(folder, "reason", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("int").alias("k"), F.col("value").alias("line")))


_EARLY = "coalesce(user_id % 2 = 0, false)"


@query("schema_evolution_add", f"""
SELECT event_id AS id, CASE WHEN {_EARLY} THEN floor(value) ELSE value END AS amount, event_type AS kind,
       CASE WHEN NOT {_EARLY} THEN user_id END AS "user", CASE WHEN NOT {_EARLY} THEN event_type END AS tag FROM events""")
def schema_evolution_add(spark, sf_dir):
    """``addNewColumns`` on a stream: a run fails on new fields and wider types, the next one goes on."""
    table, _ = flows.evolving_lines(spark, sf_dir, "addNewColumns")
    return table.read().select("id", "amount", "info.kind", "info.user", F.col("tags")[0].alias("tag"))


@query("schema_evolution_rescue", f"""
SELECT event_id AS id, CASE WHEN {_EARLY} THEN CAST(floor(value) AS BIGINT) END AS amount, event_type AS kind,
       CASE WHEN NOT {_EARLY} THEN value END AS rescued_amount, CASE WHEN NOT {_EARLY} THEN user_id END AS rescued_user,
       CASE WHEN NOT {_EARLY} THEN '["' || event_type || '"]' END AS rescued_tags FROM events""")
def schema_evolution_rescue(spark, sf_dir):
    """``rescue`` on a stream: unknown fields at any depth and values of another type are kept as text."""
    table, _ = flows.evolving_lines(spark, sf_dir, "rescue")
    kept = F.from_json(RESCUED, "map<string,string>")
    return table.read().select("id", "amount", "info.kind", kept["amount"].cast("double").alias("rescued_amount"),
                               kept["info.user"].cast("bigint").alias("rescued_user"), kept["tags"].alias("rescued_tags"))


@query("schema_evolution_fail", f"""
SELECT event_id AS id, CAST(floor(value) AS BIGINT) AS amount, event_type AS kind FROM events WHERE {_EARLY}""")
def schema_evolution_fail(spark, sf_dir):
    """``failOnNewColumns`` on a stream: the landing with new fields is not taken until someone extends the schema."""
    table, _ = flows.evolving_lines(spark, sf_dir, "failOnNewColumns")
    return table.read().select("id", "amount", "info.kind")


@query("schema_evolution_none", f"""
SELECT event_id AS id, CASE WHEN {_EARLY} THEN CAST(floor(value) AS BIGINT) END AS amount, event_type AS kind FROM events""")
def schema_evolution_none(spark, sf_dir):
    """``none`` on a stream: new fields are ignored, values of another type are null."""
    table, _ = flows.evolving_lines(spark, sf_dir, "none")
    return table.read().select("id", "amount", "info.kind")


@query("erase_stored_history", with_(CUST_P) + """
SELECT c.customer_id, c.email, c.name, c.balance, n.n_name AS country, c.row_time
FROM cust_p c JOIN nation n ON c.country_code = n.n_nationkey
WHERE row_status IN ('insert', 'update') AND customer_id NOT IN (SELECT customer_id FROM cust_p WHERE row_status = 'delete')""")
def erase_stored_history(spark, sf_dir):
    """Stored history without the customers who asked for deletion; only files that held them were replaced."""
    return flows.erased_history(spark, sf_dir)


@query("scd2_log_stream", SCD2_PRICE_SQL)
def scd2_log_stream(spark, sf_dir):
    """Type 2 history kept by a stream that appends closed versions and never rewrites them."""
    return flows.books_history(spark, sf_dir).read()


@query("scd2_log_changes", "SELECT _change_type, count(*) AS n FROM (" + f"""
SELECT 'insert' AS _change_type FROM ({SCD2_PRICE_SQL}) UNION ALL
SELECT unnest(['update_preimage', 'update_postimage']) FROM (
  SELECT book_id, CAST(floor((epoch_us(effective_date) - lo) * 3 / (hi - lo + 1)) AS INT) AS s, CAST(floor((epoch_us(end_date) - lo) * 3 / (hi - lo + 1)) AS INT) AS e
  FROM ({SCD2_PRICE_SQL}), (SELECT epoch_us(min(e.ts)) AS lo, epoch_us(max(e.ts)) AS hi FROM events e JOIN part p ON e.user_id = p.p_partkey))
WHERE e > s) GROUP BY ALL""")
def scd2_log_changes(spark, sf_dir):
    """Change rows that the merges emitted: versions opened, and open rows closed by a later batch."""
    return flows.books_history(spark, sf_dir).changes.read().groupBy("_change_type").agg(F.count("*").alias("n"))


@query("auto_cdc_scd2_log", ORACLE["auto_cdc_scd2_stream"])
def auto_cdc_scd2_log(spark, sf_dir):
    """AUTO CDC SCD2 versions derived from stored changes of a stream."""
    return flows.books_changes(spark, sf_dir).scd2()


@query("auto_cdc_scd1_log", with_(BOOKS_P) + """
SELECT book_id, title, author, price, NOT (updated >= TIMESTAMP '2020-01-01' AND price BETWEEN 0 AND 100 AND book_id IS NOT NULL) AS is_quarantined
FROM books_p QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY updated DESC) = 1""")
def auto_cdc_scd1_log(spark, sf_dir):
    """AUTO CDC SCD1 rows derived from the same stored changes."""
    return flows.books_changes(spark, sf_dir).scd1()


@query("authors_window_update", WINDOW_SQL.format(off=""))
def authors_window_update(spark, sf_dir):
    """Windows in update mode: late rows correct a window that an earlier batch has emitted."""
    rows = flows.windows_updated(spark, sf_dir).newest(["time", "author"])
    return rows.select("author", F.col("time.start").alias("window_start"), F.col("time.end").alias("window_end"),
                       "orders_count", F.round("avg_quantity", 6).alias("avg_quantity"))


@query("stream_static_replaced", with_(ORDERS_P, LINES_P, BOOKS_P) + """
SELECT l.order_id, l.book_id, l.book_quantity AS quantity, b.price FROM lines_p l JOIN orders_p o USING (order_id) JOIN (
  SELECT book_id, price, 0 AS step FROM books_p WHERE updated < (SELECT date_trunc('day', min(updated)) FROM books_p) + INTERVAL 15 DAY
  QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY updated DESC, price DESC) = 1
  UNION ALL SELECT book_id, price, 1 FROM books_p QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY updated DESC, price DESC) = 1) b
ON b.book_id = l.book_id AND b.step = l.order_id % 2 WHERE o.quantity > 0""")
def stream_static_replaced(spark, sf_dir):
    """A stream joined with a table that is replaced between its runs: only later orders carry the new prices."""
    return flows.sales_with_replaced_books(spark, sf_dir).read().drop("batch")


@query("expectation_run_metrics", ORACLE["expect_warn_metrics"])
def expectation_run_metrics(spark, sf_dir):
    """Passed and failed counts per rule as the stream measured them, without a second scan."""
    return flows.book_rule_metrics(spark, sf_dir).groupBy("dataset", "rule").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))


@query("sorted_view_stored", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type AS author, count(event_id) AS orders_count
FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY ALL""")
def sorted_view_stored(spark, sf_dir):
    """Windows from a start on, out of a view stored in their order: other row groups are skipped."""
    return spark.read.parquet(flows.stored_windows(spark, sf_dir)).filter("window_start >= TIMESTAMP'2024-01-28'")


# --------------------------------------------------------------------------
# Customers with deletes: states after a batch, and what lies between them

CUST_N = """cust_n AS (
  SELECT c.*, n.n_name AS country, floor((epoch_us(row_time) - lo) * %d / (hi - lo + 1)) AS step
  FROM cust_p c JOIN nation n ON c.country_code = n.n_nationkey,
       (SELECT min(epoch_us(row_time)) AS lo, max(epoch_us(row_time)) AS hi FROM cust_p JOIN nation ON country_code = n_nationkey))""" % flows.CUSTOMER_STEPS


def _state(name: str, upto: int) -> str:
    return f"""{name} AS (
  SELECT customer_id, balance, country, row_time FROM (
    SELECT * FROM cust_n WHERE step <= {upto} QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC, row_status = 'delete' DESC) = 1)
  WHERE row_status <> 'delete')"""


BEFORE_LAST, HALF, QUARTER = flows.CUSTOMER_STEPS - 2, flows.CUSTOMER_STEPS // 2, flows.CUSTOMER_STEPS // 4
STATES = with_(CUST_P, CUST_N, _state("early", BEFORE_LAST), _state("late", flows.CUSTOMER_STEPS))


@query("state_as_of_batch", STATES + "SELECT * FROM early")
def state_as_of_batch(spark, sf_dir):
    """Customers as they were before the last batch."""
    return flows.customer_changes(spark, sf_dir).scd1(upto=BEFORE_LAST)


@query("rows_superseded", STATES + "SELECT * FROM early EXCEPT SELECT * FROM late")
def rows_superseded(spark, sf_dir):
    """``EXCEPT`` of two states: rows of the first one that are gone or changed; unchanged ones are subtracted."""
    log = flows.customer_changes(spark, sf_dir)
    return rows_removed_since(log.scd1(upto=BEFORE_LAST), log.scd1())


@query("state_changes", STATES + """
SELECT l.*, 'insert' AS _change_type FROM late l WHERE customer_id NOT IN (SELECT customer_id FROM early) UNION ALL
SELECT e.*, 'delete' FROM early e WHERE customer_id NOT IN (SELECT customer_id FROM late) UNION ALL
SELECT e.*, 'update_preimage' FROM early e JOIN late l USING (customer_id) WHERE (e.balance, e.country, e.row_time) IS DISTINCT FROM (l.balance, l.country, l.row_time) UNION ALL
SELECT l.*, 'update_postimage' FROM early e JOIN late l USING (customer_id) WHERE (e.balance, e.country, e.row_time) IS DISTINCT FROM (l.balance, l.country, l.row_time)""")
def state_changes(spark, sf_dir):
    """Change rows of all four types between two states."""
    log = flows.customer_changes(spark, sf_dir)
    return snapshot_diff(log.scd1(upto=BEFORE_LAST), log.scd1(), ["customer_id"])


@query("upsert_matched_deletes", with_(CUST_P, CUST_N) + f"""
, t AS (SELECT customer_id, balance, country, row_time FROM cust_n WHERE step < {HALF} AND row_status <> 'delete'
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) = 1),
s AS (SELECT customer_id, balance, country, row_time, row_status FROM cust_n WHERE step >= {HALF}
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) = 1)
SELECT t.* FROM t WHERE customer_id NOT IN (SELECT customer_id FROM s) UNION ALL
SELECT customer_id, balance, country, row_time FROM s WHERE row_status <> 'delete'""")
def upsert_matched_deletes(spark, sf_dir):
    """Upsert into a filled table: rows matched by a delete go, rows matched by an update change, others are inserted."""
    log = flows.customer_changes(spark, sf_dir)
    cols = ["customer_id", "balance", "country", "row_time"]
    changes = log.log.read()
    empty = changes.select(*cols).limit(0)
    first = changes.filter(f"batch < {HALF} AND row_status <> 'delete'").select(*cols)
    table = cdc.upsert(empty, first, ["customer_id"], "row_time").table
    return cdc.upsert(table, changes.filter(f"batch >= {HALF}").drop("batch"), ["customer_id"], "row_time", delete_when="row_status = 'delete'").table


@query("requests_partly_done", with_(CUST_P, CUST_N) + f"""
SELECT customer_id, CASE WHEN min(step) < {QUARTER} THEN 'deleted' ELSE 'requested' END AS status FROM cust_n WHERE row_status = 'delete' GROUP BY customer_id""")
def requests_partly_done(spark, sf_dir):
    """Matched-only update: requests whose delete was carried out are marked, the others stay as they were."""
    changes = flows.customer_changes(spark, sf_dir).log.read().filter("row_status = 'delete'")
    requests = changes.select("customer_id").distinct().withColumn("status", F.lit("requested"))
    return cdc.update_matched(requests, changes.filter(f"batch < {QUARTER}"), ["customer_id"], {"status": F.lit("deleted")}).table


# --------------------------------------------------------------------------
# Constraints, expectations, watermarks, ranks, the catalog

CONSTRAINTS = {"known_customer": "customer_id IS NOT NULL", "not_empty": "quantity > 0", "total_not_negative": "total >= 0"}


@query("constraint_lifecycle", with_(ORDERS_P) + """
SELECT * FROM (SELECT unnest(['known_customer', 'not_empty', 'total_not_negative']) AS name,
                      unnest([count_if(customer_id IS NULL), count_if(NOT quantity > 0), count_if(NOT total >= 0)]) AS violations FROM orders_p),
LATERAL (SELECT violations = 0 AS added, violations = 0 AND name <> 'known_customer' AS still_there)""")
def constraint_lifecycle(spark, sf_dir):
    """Constraints added to a filled table: existing rows are checked first, one that fails is not added; one is dropped."""
    orders = orders_payload(spark, sf_dir)
    have, added = {}, {}
    for name, rule in CONSTRAINTS.items():
        try:
            have = quality.add_constraint(orders, have, name, rule)
        except quality.ConstraintViolation:
            pass
        added[name] = name in have
    left = quality.drop_constraint(have, "known_customer")
    counts = quality.expectation_metrics(orders, CONSTRAINTS).select(F.col("rule").alias("name"), F.col("failed_records").alias("violations"))
    flags = F.create_map(*[F.lit(x) for n in CONSTRAINTS for x in (n, added[n])])
    kept = F.create_map(*[F.lit(x) for n in CONSTRAINTS for x in (n, n in left)])
    return counts.withColumn("added", flags[F.col("name")]).withColumn("still_there", kept[F.col("name")])


@query("insert_all_or_nothing", with_(ORDERS_P) + "SELECT order_id, quantity, total FROM orders_p WHERE quantity > 0")
def insert_all_or_nothing(spark, sf_dir):
    """An insert with one violating row writes nothing; the one without writes all its rows."""
    orders = orders_payload(spark, sf_dir).select("order_id", "quantity", "total")
    log = BatchLog(spark, f"{table_root(spark, sf_dir)}/checked-orders", orders.schema)
    rule = {"not_empty": CONSTRAINTS["not_empty"]}
    flows.checked_insert(log, orders, rule, 0)
    flows.checked_insert(log, orders.filter("quantity > 0"), rule, 1)
    return log.read().drop("batch")


@query("expect_fail_update", with_(ORDERS_P) + """
SELECT 'orders' AS dataset, count_if(NOT quantity > 0) > 0 AS failed, CASE WHEN count_if(NOT quantity > 0) = 0 THEN count(*) END AS n FROM orders_p
UNION ALL SELECT 'orders_silver', false, count(*) FROM orders_p WHERE quantity > 0""")
def expect_fail_update(spark, sf_dir):
    """``expect_or_fail``: a violating row fails the update; without one all rows pass."""
    orders, out = orders_payload(spark, sf_dir), []
    for name, df in (("orders", orders), ("orders_silver", orders.filter("quantity > 0"))):
        try:
            out.append((name, False, quality.expect(df, {"not_empty": "quantity > 0"}, "fail", name).count()))
        except Exception as e:
            if "expectation failed" not in str(e):
                raise
            out.append((name, True, None))
    return spark.createDataFrame(out, "dataset string, failed boolean, n bigint")


@query("late_rows_dropped", """
WITH e AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end FROM events),
w AS (SELECT max(ts) FILTER (WHERE event_id % 2 = 0) - INTERVAL 10 MINUTE AS first, max(ts) - INTERVAL 10 MINUTE AS last FROM e)
SELECT window_end, event_type, count(event_id) AS n FROM e, w
WHERE (event_id % 2 = 0 OR window_end > date_trunc('millisecond', first)) AND window_end <= date_trunc('millisecond', last) GROUP BY ALL""")
def late_rows_dropped(spark, sf_dir):
    """Rows whose window the watermark has passed change nothing any more."""
    return flows.late_windows(spark, sf_dir).select(F.col("w.end").alias("window_end"), "event_type", "n")


@query("rank_in_batches", with_(CUST_P, CUST_SILVER) + "SELECT customer_id, balance, country, row_time FROM cust_silver")
def rank_in_batches(spark, sf_dir):
    """The newest row per key by ranks inside micro-batches, then over them."""
    rows = flows.newest_in_batches(spark, sf_dir).newest(["customer_id"], "row_time")
    return rows.select("customer_id", "balance", "country", "row_time")


@query("catalog_profile", " UNION ALL ".join(f"SELECT 'spark_catalog' AS catalog, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def catalog_profile(spark, sf_dir):
    """Row counts of the tables that the catalog lists, from their stored statistics."""
    return catalog_tables.profile(spark, flows.listed_tables(spark, sf_dir))


ORDERS_CUT = "1995-06-17"


@query("pipeline_rerun", with_(*SALES_CTES) + f"""
SELECT CASE WHEN t < TIMESTAMP '{ORDERS_CUT}' THEN 0 ELSE 1 END AS run, count(*) AS n, count(DISTINCT order_id) AS orders,
       sum(quantity) AS quantity FROM sales GROUP BY ALL""")
def pipeline_rerun(spark, sf_dir):
    """Three runs of the same pipeline, orders landed before the first two: each takes the new files only, the third nothing."""
    return (flows.sales_of_runs(spark, sf_dir, ORDERS_CUT).groupBy(F.col("batch").cast("int").alias("run"))
            .agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("orders"), F.sum("quantity").alias("quantity")))


@query("full_refresh_protected", with_(*SALES_CTES, CUST_P) + """
SELECT t.name, g.generation, g.generation = 0 OR t.name = 'bronze' AS first_folder, t.n FROM (
  SELECT 'bronze' AS name, (SELECT count(*) FROM orders_p) + (SELECT count(*) FROM cust_p) + (SELECT count(*) FROM books_p) AS n
  UNION ALL SELECT 'books_sales', count(*) FROM sales) t, (VALUES (0), (1)) g(generation)""")
def full_refresh_protected(spark, sf_dir):
    """A full refresh rebuilds ``books_sales`` in a new folder; bronze, which is protected, stays as it is."""
    built = flows.refreshed(spark, sf_dir)
    first = {name: folder for name, g, folder, _ in built if g == 0}
    parts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit(g).alias("generation"),
                                                      F.lit(folder == first[name]).alias("first_folder"), "n")
             for name, g, folder, rows in built]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("append_only_table", with_(ORDERS_P) + """
SELECT count(*) AS n, sum(quantity) AS quantity, count(*) > 0 AS delete_refused, count(*) > 0 AS update_refused FROM orders_p WHERE quantity > 0""")
def append_only_table(spark, sf_dir):
    """Orders inserted into an append-only table, which refuses a delete and an update and keeps all its rows."""
    orders = orders_payload(spark, sf_dir).select("order_id", "quantity", "total").filter("quantity > 0")
    table = VersionedTable(spark, f"{table_root(spark, sf_dir)}/append-only-orders", orders.schema, keys=["order_id"], append_only=True)
    table.insert(orders, writer="orders", batch_id=0)
    refused = {}
    for name, change in (("delete", lambda cur: cdc.delete_by_keys(cur, orders, ["order_id"])),
                         ("update", lambda cur: cdc.update_matched(cur, orders, ["order_id"], {"quantity": F.lit(0)}))):
        try:
            table.merge(change, writer=name, source=orders)
            refused[name] = False
        except AppendOnlyViolation:
            refused[name] = True
    return table.read().agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity")).select(
        "n", "quantity", *[F.lit(refused[x]).alias(f"{x}_refused") for x in ("delete", "update")])


@query("current_catalog", "SELECT 'spark_catalog' AS catalog, count(*) AS n FROM customer")
def current_catalog(spark, sf_dir):
    """``current_catalog()`` over a table of the session."""
    return load(spark, sf_dir, "customer").agg(F.count("*").alias("n")).select(F.current_catalog().alias("catalog"), "n")
