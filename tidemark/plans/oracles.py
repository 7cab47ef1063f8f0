"""Plain SQL (DuckDB dialect) for every query in :mod:`tidemark.plans.analogues`.

Each text computes the same result by a different route than the Spark code:
interval joins with range conditions, LAG/LEAD and window aggregates, NOT IN
and NOT EXISTS, so the two check each other.
"""

from __future__ import annotations

_ORDER_VERSIONS = """
per_run AS (
  SELECT o_custkey, o_orderdate AS run, max(o_orderpriority) AS priority
  FROM orders GROUP BY o_custkey, o_orderdate),
marked AS (
  SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY run) AS prev,
         row_number() OVER (PARTITION BY o_custkey ORDER BY run) AS rn
  FROM per_run),
versions AS (
  SELECT o_custkey, priority, run AS valid_from,
         lead(run) OVER (PARTITION BY o_custkey ORDER BY run) AS valid_to
  FROM marked WHERE rn = 1 OR priority IS DISTINCT FROM prev),
dated AS (
  SELECT *, md5(CAST(o_custkey AS VARCHAR) || CAST(valid_from AS VARCHAR)) AS customer_sk,
         CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY o_custkey)
              THEN NULL ELSE valid_from END AS lower_bound
  FROM versions)"""

ASOF_FACT = f"""
WITH {_ORDER_VERSIONS},
facts AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, o.o_custkey
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_shipdate, f.o_custkey,
       v.customer_sk, v.priority AS cust_priority
FROM facts f
LEFT JOIN dated v
  ON f.o_custkey = v.o_custkey AND f.l_shipdate IS NOT NULL
 AND (v.lower_bound IS NULL OR f.l_shipdate >= v.lower_bound)
 AND (v.valid_to IS NULL OR f.l_shipdate < v.valid_to)
"""

ASOF_FACT_SKEWED = f"""
WITH {_ORDER_VERSIONS},
facts AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
         CASE WHEN l.l_linenumber <= 2 THEN CAST(7 AS BIGINT) ELSE o.o_custkey END AS o_custkey
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_shipdate, f.o_custkey,
       v.customer_sk, v.priority AS cust_priority
FROM facts f
LEFT JOIN dated v
  ON f.o_custkey = v.o_custkey AND f.l_shipdate IS NOT NULL
 AND (v.lower_bound IS NULL OR f.l_shipdate >= v.lower_bound)
 AND (v.valid_to IS NULL OR f.l_shipdate < v.valid_to)
"""

ASOF_NO_BACKDATE = """
WITH s AS (
  SELECT user_id, ts, max(event_id) AS signup_id FROM events
  WHERE event_type = 'signup' GROUP BY user_id, ts),
m AS (
  SELECT *, lag(signup_id) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM s),
v AS (
  SELECT user_id, signup_id, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM m WHERE rn = 1 OR signup_id IS DISTINCT FROM prev)
SELECT p.event_id, p.user_id, p.ts, v.signup_id
FROM events p
LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.valid_from
           AND (v.valid_to IS NULL OR p.ts < v.valid_to)
WHERE p.event_type = 'purchase'
"""


def _history(name: str, event_type: str, value_sql: str, col: str) -> str:
    return f"""
{name}_run AS (
  SELECT user_id, ts, arg_max({value_sql}, event_id) AS {col}
  FROM events WHERE event_type = '{event_type}' GROUP BY user_id, ts),
{name}_m AS (
  SELECT *, lag({col}) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM {name}_run),
{name} AS (
  SELECT user_id, {col}, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM {name}_m WHERE rn = 1 OR {col} IS DISTINCT FROM prev)"""


MERGE_TIMELINES = f"""
WITH {_history('h1', 'signup', "CASE WHEN value < 25 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END", 'status')},
{_history('h2', 'click', 'props', 'address')},
starts AS (
  SELECT DISTINCT user_id, t FROM (
    SELECT user_id, valid_from AS t FROM h1 UNION ALL SELECT user_id, valid_from AS t FROM h2)),
spans AS (
  SELECT user_id, t AS span_start,
         min(t) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS span_end
  FROM starts),
timeline AS (
  SELECT sp.user_id, sp.span_start, sp.span_end, s1.status, s2.address
  FROM spans sp
  LEFT JOIN h1 s1 ON s1.user_id = sp.user_id AND s1.valid_from <= sp.span_start
                 AND coalesce(sp.span_start < s1.valid_to, TRUE)
  LEFT JOIN h2 s2 ON s2.user_id = sp.user_id AND s2.valid_from <= sp.span_start
                 AND coalesce(sp.span_start < s2.valid_to, TRUE))
SELECT md5(CAST(user_id AS VARCHAR) || CAST(span_start AS VARCHAR)) AS customer_sk,
       user_id, status, address, span_start AS valid_from, span_end AS valid_to,
       span_end IS NULL AS is_current
FROM timeline
"""

REPLAY_SNAPSHOTS = """
WITH e AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r
  FROM events),
d AS (SELECT user_id, day, event_type FROM e WHERE r = 1),
m AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS prev,
         row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM d)
SELECT user_id, event_type, day AS valid_from,
       lead(day) OVER (PARTITION BY user_id ORDER BY day) AS valid_to
FROM m WHERE rn = 1 OR event_type IS DISTINCT FROM prev
"""


def _state_before(cutoff: str) -> str:
    return f"""
  SELECT user_id, event_type AS status, event_id AS last_event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
    FROM events WHERE ts < TIMESTAMP '{cutoff}') WHERE r = 1"""


SNAPSHOT_TWO_RUNS = f"""
WITH s1 AS ({_state_before('2024-01-15')}),
s2 AS ({_state_before('2024-01-30')}),
snap1 AS (
  SELECT user_id, status, last_event_id,
         md5(CAST(user_id AS VARCHAR) || '|' || CAST(TIMESTAMP '2024-01-15' AS VARCHAR)) AS scd_id,
         TIMESTAMP '2024-01-15' AS updated_at, TIMESTAMP '2024-01-15' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to
  FROM s1),
chg AS (
  SELECT s2.user_id FROM s2 JOIN snap1 o ON s2.user_id = o.user_id
  WHERE o.valid_to IS NULL AND s2.status IS DISTINCT FROM o.status)
SELECT o.user_id, o.status, o.last_event_id, o.scd_id, o.updated_at, o.valid_from,
       CASE WHEN o.user_id IN (SELECT user_id FROM chg) THEN TIMESTAMP '2024-01-30' ELSE o.valid_to END AS valid_to
FROM snap1 o
UNION ALL
SELECT s2.user_id, s2.status, s2.last_event_id,
       md5(CAST(s2.user_id AS VARCHAR) || '|' || CAST(TIMESTAMP '2024-01-30' AS VARCHAR)),
       TIMESTAMP '2024-01-30', TIMESTAMP '2024-01-30', CAST(NULL AS TIMESTAMP)
FROM s2
WHERE s2.user_id NOT IN (SELECT user_id FROM snap1) OR s2.user_id IN (SELECT user_id FROM chg)
"""

LATEST_OVERLAY = """
WITH l AS (
  SELECT user_id, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
    FROM events WHERE event_type = 'signup') WHERE r = 1)
SELECT c.c_custkey, c.c_name, COALESCE(l.props, c.c_mktsegment) AS c_mktsegment
FROM customer c LEFT JOIN l ON c.c_custkey = l.user_id
"""

STATE_AS_OF = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS batch_date FROM events),
adds AS (
  SELECT user_id AS c_custkey, 'user_' || CAST(user_id AS VARCHAR) AS c_name, 'active' AS status,
         batch_date, ts, event_id
  FROM ev WHERE event_type = 'signup' AND batch_date < DATE '2024-01-20'),
all_rows AS (
  SELECT c_custkey, c_name, c_mktsegment AS status, CAST(NULL AS DATE) AS batch_date,
         CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS event_id
  FROM customer
  UNION ALL SELECT * FROM adds),
cur AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey
                                 ORDER BY batch_date DESC NULLS LAST, ts DESC NULLS LAST,
                                          event_id DESC NULLS LAST) AS r
    FROM all_rows) WHERE r = 1),
chg AS (
  SELECT * FROM (
    SELECT user_id AS c_custkey, batch_date AS cb,
           row_number() OVER (PARTITION BY user_id ORDER BY batch_date DESC, ts DESC, event_id DESC) AS r
    FROM ev WHERE event_type = 'error' AND batch_date < DATE '2024-01-20') WHERE r = 1)
SELECT cur.c_custkey, cur.c_name,
       CASE WHEN chg.cb IS NOT NULL AND (cur.batch_date IS NULL OR chg.cb >= cur.batch_date)
            THEN 'blocked' ELSE cur.status END AS status
FROM cur LEFT JOIN chg ON cur.c_custkey = chg.c_custkey
"""


def _rollup(where: str) -> str:
    return f"""
  SELECT l_orderkey, count(*) AS n_lines,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity,
         max(l_shipdate) AS last_ship
  FROM lineitem {where} GROUP BY l_orderkey"""


_BASE = _rollup("WHERE l_shipdate < TIMESTAMP '1998-01-01'")
_BATCH = _rollup("WHERE l_shipdate >= TIMESTAMP '1998-01-01'")

UPSERT_LATEST = f"""
WITH base AS ({_BASE}), batch AS ({_BATCH})
SELECT * FROM base WHERE l_orderkey NOT IN (SELECT l_orderkey FROM batch)
UNION ALL SELECT * FROM batch
"""

INSERT_ABSENT = f"""
WITH base AS ({_BASE}), batch AS ({_BATCH})
SELECT * FROM base
UNION ALL SELECT * FROM batch WHERE l_orderkey NOT IN (SELECT l_orderkey FROM base)
"""

REPLACE_BY_KEY = """
WITH base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
  WHERE l_shipdate < TIMESTAMP '1998-01-01'),
batch AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-01-01')
SELECT * FROM base WHERE l_orderkey NOT IN (SELECT l_orderkey FROM batch)
UNION ALL SELECT * FROM batch
"""

MERGE_BY_KEY = f"""
WITH base AS ({_BASE}), src AS ({_rollup('')}),
delta AS (SELECT * FROM src WHERE last_ship > (SELECT max(last_ship) FROM base))
SELECT * FROM base WHERE l_orderkey NOT IN (SELECT l_orderkey FROM delta)
UNION ALL SELECT * FROM delta
"""

HIGH_WATER = """
SELECT * FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')
"""

APPEND_NEW = """
SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')
"""

DIM_ORDERS = """
SELECT md5(CAST(o.o_orderkey AS VARCHAR)) AS order_sk, o.o_orderkey, o.o_custkey, o.o_orderstatus,
       c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

DIM_CUSTOMER_NATION = """
SELECT md5(CAST(c.c_custkey AS VARCHAR)) AS customer_sk, c.c_custkey, c.c_name, n.n_name AS nation_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

DIM_SUPPLIER = """
SELECT md5(CAST(s.s_suppkey AS VARCHAR)) AS supplier_sk, s.s_suppkey, s.s_name AS supplier_name,
       n.n_name AS nation_name
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
"""

NULL_SAFE_KEY = """
SELECT event_id,
       CASE WHEN m IS NULL OR m = '' THEN NULL ELSE md5(m) END AS merchant_sk,
       md5(CAST(user_id AS VARCHAR)) AS account_sk
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN props WHEN event_type = 'click' THEN '' END AS m
      FROM events)
"""

MASK_NAME = """
SELECT c_custkey, LEFT(n, 1) || REPEAT('*', GREATEST(LENGTH(n) - 1, 0)) AS masked_name
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_name END AS n FROM customer)
"""

MASK_PHONE = """
SELECT c_custkey, REPEAT('*', GREATEST(LENGTH(p) - 4, 0)) || RIGHT(p, 4) AS masked_phone
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS p FROM customer)
"""

MASK_EMAIL = """
WITH e AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN lower(replace(c_name, '#', '.'))
              ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' END AS email
  FROM customer)
SELECT c_custkey, LEFT(email, 1) || '***@' || SPLIT_PART(email, '@', 2) AS masked_email FROM e
"""

REDACT_DIGITS = r"""
SELECT doc_id, regexp_replace(text, '\d+', '###', 'g') AS text FROM documents
"""

AGE_BRACKET = """
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              ELSE DATE '1940-01-01' + CAST((c_custkey * 17) % 25000 AS INTEGER) END AS dob
  FROM customer),
a AS (
  SELECT c_custkey, dob,
         CAST(year(DATE '2026-07-13') - year(dob)
              - CASE WHEN month(DATE '2026-07-13') < month(dob)
                       OR (month(DATE '2026-07-13') = month(dob) AND day(DATE '2026-07-13') < day(dob))
                     THEN 1 ELSE 0 END AS INTEGER) AS age
  FROM c)
SELECT c_custkey, dob, age,
       CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
            WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_bracket
FROM a
"""

TYPED_CASTS = """
SELECT event_id, CAST(ts AS VARCHAR) AS ts_text,
       CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_back,
       CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS day,
       CAST(CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) AS DECIMAL(12, 2)) AS amount
FROM events
"""

QUALITY_CHECKS = """
SELECT 'lineitem' AS "table", 'l_orderkey' AS "column", 'not_null' AS "check",
       CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS failures FROM lineitem
UNION ALL
SELECT 'orders', 'o_custkey', 'not_null', CAST(count(*) FILTER (WHERE o_custkey IS NULL) AS BIGINT) FROM orders
UNION ALL
SELECT 'orders', 'o_orderstatus', 'accepted_values',
       CAST(count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) AS BIGINT)
FROM orders
UNION ALL
SELECT 'lineitem', 'l_returnflag', 'accepted_values',
       CAST(count(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R')) AS BIGINT)
FROM lineitem
UNION ALL
SELECT 'lineitem_orders', 'l_shipdate,o_orderdate', 'ship_before_order',
       CAST(count(*) FILTER (WHERE l_shipdate < o_orderdate) AS BIGINT)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'customer', 'c_name', 'max_length',
       CAST(count(*) FILTER (WHERE c_name IS NOT NULL AND length(c_name) > 255) AS BIGINT) FROM customer
UNION ALL
SELECT 'lineitem', 'l_orderkey,l_linenumber', 'unique', CAST(count(*) AS BIGINT) FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL
SELECT 'orders', 'o_orderkey', 'unique', CAST(count(*) AS BIGINT) FROM (
  SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL
SELECT 'lineitem', 'l_orderkey', 'relationships', CAST(count(*) AS BIGINT) FROM lineitem l
WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'orders', 'o_custkey', 'relationships', CAST(count(*) AS BIGINT) FROM orders o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
"""

ELIGIBLE = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey FROM lineitem l
WHERE l.l_linestatus = 'O'
  AND l.l_orderkey IN (
    SELECT o.o_orderkey FROM orders o
    WHERE o.o_orderstatus = 'O'
      AND o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
"""

LINES_PER_ORDER = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS ordinal,
       CAST(count(*) OVER (PARTITION BY l_orderkey) AS BIGINT) AS group_size
FROM lineitem
"""

NEXT_IDS = """
SELECT c_custkey,
       CAST((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS new_id
FROM customer WHERE c_acctbal < 0
"""

STREAM_LANDING = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id,
       event_type, props
FROM events
"""

def _order_history(name: str, col: str, src: str) -> str:
    return f"""
{name}_run AS (
  SELECT o_custkey AS customer_id, o_orderdate AS run, max({src}) AS {col}
  FROM orders GROUP BY o_custkey, o_orderdate),
{name}_m AS (
  SELECT *, lag({col}) OVER (PARTITION BY customer_id ORDER BY run) AS prev,
         row_number() OVER (PARTITION BY customer_id ORDER BY run) AS rn FROM {name}_run),
{name} AS (
  SELECT customer_id, {col}, run AS valid_from,
         lead(run) OVER (PARTITION BY customer_id ORDER BY run) AS valid_to
  FROM {name}_m WHERE rn = 1 OR {col} IS DISTINCT FROM prev)"""


_GOLD_DIM = f"""
{_order_history('h1', 'priority', 'o_orderpriority')},
{_order_history('h2', 'order_status', 'o_orderstatus')},
starts AS (
  SELECT DISTINCT customer_id, t FROM (
    SELECT customer_id, valid_from AS t FROM h1 UNION ALL SELECT customer_id, valid_from AS t FROM h2)),
spans AS (
  SELECT customer_id, t AS span_start,
         min(t) OVER (PARTITION BY customer_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS span_end
  FROM starts),
timeline AS (
  SELECT sp.customer_id, sp.span_start, sp.span_end, s1.priority, s2.order_status
  FROM spans sp
  LEFT JOIN h1 s1 ON s1.customer_id = sp.customer_id AND s1.valid_from <= sp.span_start
                 AND coalesce(sp.span_start < s1.valid_to, TRUE)
  LEFT JOIN h2 s2 ON s2.customer_id = sp.customer_id AND s2.valid_from <= sp.span_start
                 AND coalesce(sp.span_start < s2.valid_to, TRUE)),
phonebook AS (
  SELECT c_custkey AS customer_id,
         REPEAT('*', GREATEST(LENGTH(CAST(c_custkey AS VARCHAR)) - 4, 0)) || RIGHT(CAST(c_custkey AS VARCHAR), 4) AS phone,
         LEFT(e, 1) || '***@' || SPLIT_PART(e, '@', 2) AS email
  FROM (SELECT *, lower(replace(c_name, '#', '.')) || '@mail.example' AS e FROM customer)),
dim_customers AS (
  SELECT md5(CAST(tl.customer_id AS VARCHAR) || CAST(tl.span_start AS VARCHAR)) AS customer_sk,
         tl.customer_id, tl.priority, tl.order_status, pb.phone, pb.email,
         tl.span_start AS valid_from, tl.span_end AS valid_to, (tl.span_end IS NULL) AS is_current
  FROM timeline tl LEFT JOIN phonebook pb ON pb.customer_id = tl.customer_id)"""

GOLD_DIM_CUSTOMERS = f"""
WITH {_GOLD_DIM}
SELECT * FROM dim_customers
"""

GOLD_FACT_TRANSACTIONS = f"""
WITH {_GOLD_DIM},
windows AS (
  SELECT customer_id, customer_sk, valid_to,
         CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY customer_id) THEN NULL
              ELSE valid_from END AS lower_bound
  FROM dim_customers),
owners AS (SELECT CAST(o_orderkey AS VARCHAR) AS account_id, o_custkey AS owner FROM orders),
flags AS (SELECT DISTINCT l_returnflag AS code, 'flag ' || l_returnflag AS label FROM lineitem),
states AS (SELECT DISTINCT l_linestatus AS code, 'status ' || l_linestatus AS label FROM lineitem),
tx AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         l_shipdate AS transaction_timestamp, CAST(l_orderkey AS VARCHAR) AS account_id,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS card_id,
         CAST(l_suppkey AS VARCHAR) AS merchant_id, l_returnflag AS transaction_type,
         l_linestatus AS currency_code, CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(12, 2)) AS amount,
         'approved' AS status, l_shipdate AS dwh_load_date
  FROM lineitem)
SELECT tx.transaction_id, tx.transaction_timestamp, md5(tx.account_id) AS account_sk,
       CASE WHEN coalesce(tx.card_id, '') = '' THEN NULL ELSE md5(tx.card_id) END AS card_sk,
       CASE WHEN coalesce(tx.merchant_id, '') = '' THEN NULL ELSE md5(tx.merchant_id) END AS merchant_sk,
       w.customer_sk, tx.transaction_type, f.label AS transaction_type_description, tx.currency_code,
       st.label AS currency_name, tx.amount, tx.status, tx.dwh_load_date
FROM tx
LEFT JOIN flags f ON f.code = tx.transaction_type
LEFT JOIN states st ON st.code = tx.currency_code
LEFT JOIN owners ow ON ow.account_id = tx.account_id
LEFT JOIN windows w
  ON w.customer_id = ow.owner
 AND coalesce(tx.transaction_timestamp >= w.lower_bound, tx.transaction_timestamp IS NOT NULL)
 AND coalesce(tx.transaction_timestamp < w.valid_to, TRUE)
"""

OVERLAPPING_VERSIONS = """
WITH v AS (
  SELECT o_custkey, max(o_orderkey) AS o_orderkey, o_orderdate AS valid_from,
         o_orderdate + INTERVAL 60 DAY AS valid_to
  FROM orders GROUP BY o_custkey, o_orderdate),
w AS (
  SELECT *, max(valid_to) OVER (PARTITION BY o_custkey ORDER BY valid_from
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM v)
SELECT o_custkey, o_orderkey, valid_from, valid_to FROM w WHERE prev_end > valid_from
"""

_BRONZE_CHANGES = """
chg AS (
  SELECT CAST(event_id AS VARCHAR) AS change_id, CAST(user_id AS VARCHAR) AS customer_id,
         CASE WHEN event_type = 'error' THEN 'status' ELSE 'address' END AS change_type,
         CASE WHEN event_type = 'error' THEN 'blocked' END AS status,
         CASE WHEN event_type = 'click' THEN props END AS address_line,
         CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS city,
         CASE WHEN event_type = 'click' THEN 'KZ' END AS country,
         CAST(ts AS VARCHAR) AS change_timestamp
  FROM events WHERE event_type IN ('error', 'click'))"""

SILVER_CUSTOMERS_CURRENT = f"""
WITH {_BRONZE_CHANGES},
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, split_part(c_name, '#', 1) AS fn,
         split_part(c_name, '#', 2) AS ln,
         DATE '1940-01-01' + CAST((c_custkey * 17) % 25000 AS INTEGER) AS born
  FROM customer),
newest AS (
  SELECT customer_id, status FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY change_timestamp DESC NULLS FIRST, change_id DESC) AS r
    FROM chg WHERE change_type = 'status') WHERE r = 1),
aged AS (
  SELECT *, year(DATE '2026-07-13') - year(born)
            - CASE WHEN month(DATE '2026-07-13') < month(born)
                     OR (month(DATE '2026-07-13') = month(born) AND day(DATE '2026-07-13') < day(born))
                   THEN 1 ELSE 0 END AS years
  FROM cust)
SELECT a.customer_id,
       LEFT(fn, 1) || REPEAT('*', GREATEST(LENGTH(fn) - 1, 0)) AS first_name,
       LEFT(ln, 1) || REPEAT('*', GREATEST(LENGTH(ln) - 1, 0)) AS last_name,
       CASE WHEN years < 25 THEN '18-24' WHEN years < 35 THEN '25-34' WHEN years < 45 THEN '35-44'
            WHEN years < 55 THEN '45-54' WHEN years < 65 THEN '55-64' ELSE '65+' END AS age_bracket,
       coalesce(n.status, 'active') AS status,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM aged a LEFT JOIN newest n ON n.customer_id = a.customer_id
"""

SILVER_ADDRESSES_CURRENT = rf"""
WITH {_BRONZE_CHANGES},
newest AS (
  SELECT customer_id, address_line, city, country FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY change_timestamp DESC NULLS FIRST, change_id DESC) AS r
    FROM chg WHERE change_type = 'address') WHERE r = 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
       regexp_replace(coalesce(n.address_line, c.c_name), '\d+', '###', 'g') AS address_line,
       coalesce(n.city, CAST(c.c_nationkey AS VARCHAR)) AS city,
       coalesce(n.country, 'KZ') AS country,
       DATE '2024-01-01' AS created_at
FROM customer c LEFT JOIN newest n ON n.customer_id = CAST(c.c_custkey AS VARCHAR)
"""

STREAM_UPSERT = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type, event_id,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r
  FROM events),
latest_day AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS d
  FROM daily WHERE r = 1)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS status, CAST(event_id AS VARCHAR) AS last_event
FROM latest_day WHERE d = 1
"""

DUPLICATE_KEYS = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""

FAILING_ROWS = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate < o.o_orderdate
"""

STREAM_FIRST = "SELECT DISTINCT event_id, ts, user_id, event_type FROM events"

SQL_FUNCTIONS = """
WITH c AS (
  SELECT c_custkey, c_name, CAST(c_custkey AS VARCHAR) AS k, lower(replace(c_name, '#', '.')) || '@post.example' AS email,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN DATE '1940-01-01' + CAST((c_custkey * 17) % 25000 AS INTEGER) END AS born,
         CASE c_custkey % 3 WHEN 1 THEN c_mktsegment END AS segment
  FROM customer),
aged AS (SELECT *, CAST(date_part('year', age(DATE '2026-07-13', born)) AS INTEGER) AS years FROM c)
SELECT c_custkey, left(c_name, 1) || repeat('*', length(c_name) - 1) AS masked_name,
       repeat('*', greatest(length(k) - 4, 0)) || right(k, 4) AS masked_phone,
       left(email, 1) || '***@' || split_part(email, '@', 2) AS masked_email, regexp_replace(c_name, '[0-9]+', '###', 'g') AS redacted,
       years AS age, CASE WHEN years < 25 THEN '18-24' WHEN years < 35 THEN '25-34' WHEN years < 45 THEN '35-44'
         WHEN years < 55 THEN '45-54' WHEN years < 65 THEN '55-64' ELSE '65+' END AS age_bracket,
       md5(k) AS sk, md5(k || '2024-01-15 00:00:00') AS version_sk, md5(segment) AS segment_sk,
       md5(k || '|2024-01-30 00:00:00') AS scd
FROM aged
"""

ORACLES: dict[str, str] = {
    "asof_fact": ASOF_FACT,
    "asof_fact_join": ASOF_FACT,
    "asof_fact_skewed": ASOF_FACT_SKEWED,
    "asof_no_backdate": ASOF_NO_BACKDATE,
    "merge_timelines": MERGE_TIMELINES,
    "merge_timelines_join": MERGE_TIMELINES,
    "replay_snapshots": REPLAY_SNAPSHOTS,
    "snapshot_two_runs": SNAPSHOT_TWO_RUNS,
    "latest_overlay": LATEST_OVERLAY,
    "state_as_of": STATE_AS_OF,
    "upsert_latest": UPSERT_LATEST,
    "insert_absent": INSERT_ABSENT,
    "replace_by_key": REPLACE_BY_KEY,
    "merge_by_key": MERGE_BY_KEY,
    "high_water": HIGH_WATER,
    "append_new": APPEND_NEW,
    "dim_orders": DIM_ORDERS,
    "dim_customer_nation": DIM_CUSTOMER_NATION,
    "dim_supplier": DIM_SUPPLIER,
    "null_safe_key": NULL_SAFE_KEY,
    "mask_name": MASK_NAME,
    "mask_phone": MASK_PHONE,
    "mask_email": MASK_EMAIL,
    "redact_digits": REDACT_DIGITS,
    "age_bracket": AGE_BRACKET,
    "typed_casts": TYPED_CASTS,
    "quality_checks": QUALITY_CHECKS,
    "duplicate_keys": DUPLICATE_KEYS,
    "failing_rows": FAILING_ROWS,
    "quality_checks_one_by_one": QUALITY_CHECKS,
    "eligible": ELIGIBLE,
    "lines_per_order": LINES_PER_ORDER,
    "lines_per_order_sort": LINES_PER_ORDER,
    "next_ids": NEXT_IDS,
    "stream_landing": STREAM_LANDING,
    "stream_upsert": STREAM_UPSERT,
    "overlapping_versions": OVERLAPPING_VERSIONS,
    "silver_customers_current": SILVER_CUSTOMERS_CURRENT,
    "silver_addresses_current": SILVER_ADDRESSES_CURRENT,
    "gold_dim_customers": GOLD_DIM_CUSTOMERS,
    "gold_fact_transactions": GOLD_FACT_TRANSACTIONS,
    "stream_first": STREAM_FIRST,
    "bucketed_upsert": UPSERT_LATEST,
    "indexed_insert": INSERT_ABSENT,
    "sql_functions": SQL_FUNCTIONS,
}
