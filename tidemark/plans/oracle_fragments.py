"""SQL fragments shared by the oracle queries: the bookstore payloads
written directly against the given tables (the same mapping as
``tidemark.sources.bookstore``)."""

ORDERS_P = """orders_p AS (
  SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_timestamp,
         o.o_custkey AS customer_id, CAST(coalesce(l.quantity, 0) AS BIGINT) AS quantity,
         o.o_totalprice AS total, coalesce(l.n_books, 0) AS n_books
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS quantity, count(*) AS n_books
    FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey)"""

LINES_P = """lines_p AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS book_id,
         CAST(l_quantity AS BIGINT) AS book_quantity, l_extendedprice AS subtotal
  FROM lineitem)"""

CUST_P = """cust_p AS (
  SELECT e.user_id AS customer_id, 'c' || CAST(e.user_id AS VARCHAR) || '@mail.test' AS email,
         c.c_name AS name, c.c_mktsegment AS segment, e.value AS balance,
         c.c_nationkey AS country_code,
         CASE WHEN e.event_type = 'signup' THEN 'insert'
              WHEN e.event_type = 'error' AND c.c_mktsegment = 'BUILDING' THEN 'delete'
              ELSE 'update' END AS row_status,
         e.ts AS row_time
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

BOOKS_P = """books_p AS (
  SELECT e.user_id AS book_id, p.p_name AS title, p.p_brand AS author,
         CAST(floor(e.value / 100) AS DOUBLE) AS price, e.ts AS updated
  FROM events e JOIN part p ON e.user_id = p.p_partkey)"""

BOOKS_RAW = """books_raw AS (
  SELECT *, NOT(updated >= TIMESTAMP '2020-01-01' AND price BETWEEN 0 AND 100
                AND book_id IS NOT NULL) AS is_quarantined
  FROM books_p)"""

# customers_silver: insert/update rows joined to the lookup, newest per key.
CUST_SILVER = """cust_silver AS (
  SELECT c.*, n.n_nationkey AS code, n.n_name AS country
  FROM cust_p c JOIN nation n ON c.country_code = n.n_nationkey
  WHERE c.row_status IN ('insert', 'update')
  QUALIFY rank() OVER (PARTITION BY c.customer_id ORDER BY c.row_time DESC) = 1)"""

# AUTO CDC SCD2 of books_raw: a version opens when any output column changes.
BOOKS_SCD2 = """b_lag AS (
  SELECT *, row_number() OVER w AS rn,
         lag(title) OVER w AS p_title, lag(author) OVER w AS p_author,
         lag(price) OVER w AS p_price, lag(is_quarantined) OVER w AS p_q
  FROM books_raw WINDOW w AS (PARTITION BY book_id ORDER BY updated)),
b_ver AS (
  SELECT * FROM b_lag
  WHERE rn = 1 OR title IS DISTINCT FROM p_title OR author IS DISTINCT FROM p_author
     OR price IS DISTINCT FROM p_price OR is_quarantined IS DISTINCT FROM p_q),
books_silver AS (
  SELECT book_id, title, author, price, is_quarantined, updated AS __START_AT,
         lead(updated) OVER (PARTITION BY book_id ORDER BY updated) AS __END_AT
  FROM b_ver)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
