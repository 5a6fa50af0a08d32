"""Independent DuckDB SQL for each registered query.

The SQL rebuilds the derived inputs as CTEs straight from ``orders``,
``customer`` and ``nation`` and evaluates the merge the textbook way (a
full outer join with a CASE for the action), sharing no code with the
Spark plans. Keys are unique in the driver's tables, so the textbook
join is exact here.
"""

from __future__ import annotations

STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' "
    "WHEN 'O' THEN 'refunded' END"
)


def _stg(where: str = "TRUE") -> str:
    return f"""
  SELECT 'TXN-' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'CUST-' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS transaction_date,
         {STATUS} AS status
  FROM orders WHERE {where}"""


CTE = f"""
WITH stg AS ({_stg()}
), mstg AS ({_stg("o_orderkey % 4 <> 1")}
), cust AS (
  SELECT 'CUST-' || CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS customer_name,
         'cust' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         n_name AS country,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), kcust AS (
  SELECT * FROM cust WHERE CAST(substr(customer_id, 6) AS BIGINT) % 17 <> 0
), tgt AS (
  SELECT 'TXN-' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'CUST-' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE c_name END AS customer_name,
         n_name AS country,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS DECIMAL(38,9)) AS amount,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CASE WHEN o_orderkey % 7 = 0 THEN 'pending' ELSE {STATUS} END AS status,
         TIMESTAMP '2024-01-01 00:00:00' AS last_updated
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 5 <> 0
), src_all AS (
  SELECT t.transaction_id, t.customer_id, c.customer_name, c.country,
         CAST(t.amount AS DECIMAL(38,9)) AS amount,
         CAST(t.transaction_date AS DATE) AS transaction_date,
         t.status,
         TIMESTAMP '2024-02-01 00:00:00' AS last_updated
  FROM stg t LEFT JOIN kcust c ON t.customer_id = c.customer_id
), src AS (
  SELECT * FROM src_all WHERE transaction_id IN (SELECT transaction_id FROM mstg)
), m AS (
  SELECT
    CASE WHEN t.present IS NULL THEN 'INSERT'
         WHEN s.present IS NULL THEN 'KEEP'
         WHEN coalesce(t.status <> s.status OR t.customer_name <> s.customer_name OR t.amount <> s.amount, false)
           THEN 'UPDATE'
         ELSE 'NOOP' END AS action,
    t.transaction_id AS t_transaction_id, t.customer_id AS t_customer_id, t.customer_name AS t_customer_name,
    t.country AS t_country, t.amount AS t_amount, t.transaction_date AS t_transaction_date,
    t.status AS t_status, t.last_updated AS t_last_updated,
    s.transaction_id AS s_transaction_id, s.customer_id AS s_customer_id, s.customer_name AS s_customer_name,
    s.country AS s_country, s.amount AS s_amount, s.transaction_date AS s_transaction_date,
    s.status AS s_status, s.last_updated AS s_last_updated
  FROM (SELECT *, 1 AS present FROM tgt) t
  FULL OUTER JOIN (SELECT *, 1 AS present FROM src) s ON t.transaction_id = s.transaction_id
), merged AS (
  SELECT
    CASE WHEN action = 'INSERT' THEN s_transaction_id ELSE t_transaction_id END AS transaction_id,
    CASE WHEN action = 'INSERT' THEN s_customer_id ELSE t_customer_id END AS customer_id,
    CASE WHEN action IN ('INSERT', 'UPDATE') THEN s_customer_name ELSE t_customer_name END AS customer_name,
    CASE WHEN action IN ('INSERT', 'UPDATE') THEN s_country ELSE t_country END AS country,
    CASE WHEN action IN ('INSERT', 'UPDATE') THEN s_amount ELSE t_amount END AS amount,
    CASE WHEN action = 'INSERT' THEN s_transaction_date ELSE t_transaction_date END AS transaction_date,
    CASE WHEN action IN ('INSERT', 'UPDATE') THEN s_status ELSE t_status END AS status,
    CASE WHEN action IN ('INSERT', 'UPDATE') THEN s_last_updated ELSE t_last_updated END AS last_updated,
    action
  FROM m
), stg_even AS ({_stg("o_orderkey % 2 = 0")}
), stg_odd AS ({_stg("o_orderkey % 2 = 1")}
), stg_ninth AS ({_stg("o_orderkey % 9 = 0")}
)
"""

FINAL_COLS = "transaction_id, customer_id, customer_name, country, amount, transaction_date, status, last_updated"

# Duplicate keys on both sides, evaluated pairwise: per target row, count the
# source rows of its key for which the change test holds.
DUP_CTE = CTE.rstrip() + """, tgt2 AS (
  SELECT * FROM tgt
  UNION ALL SELECT * FROM tgt WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 3 = 0
), src2 AS (
  SELECT * FROM src
  UNION ALL
  SELECT transaction_id, customer_id, CAST(NULL AS VARCHAR) AS customer_name, country,
         CAST(NULL AS DECIMAL(38,9)) AS amount, transaction_date, CAST(NULL AS VARCHAR) AS status, last_updated
  FROM src WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 8 = 0
  UNION ALL
  SELECT transaction_id, customer_id, CAST(NULL AS VARCHAR), country, CAST(NULL AS DECIMAL(38,9)), transaction_date, CAST(NULL AS VARCHAR), last_updated
  FROM src WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 8 = 4
  UNION ALL
  SELECT transaction_id, customer_id, customer_name, CAST(NULL AS VARCHAR), CAST(NULL AS DECIMAL(38,9)), transaction_date, CAST(NULL AS VARCHAR), last_updated
  FROM src WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 8 = 4
), t AS (
  SELECT *, row_number() OVER () AS rid FROM tgt2
), pairs AS (
  SELECT t.rid, s.customer_name AS s_name, s.country AS s_country, s.amount AS s_amount,
         s.status AS s_status, s.last_updated AS s_ts,
         coalesce(t.status <> s.status OR t.customer_name <> s.customer_name OR t.amount <> s.amount, false) AS chg
  FROM t JOIN src2 s ON t.transaction_id = s.transaction_id
), per_t AS (
  SELECT rid, count(*) AS n_match, count(*) FILTER (WHERE chg) AS q,
         any_value(s_name) FILTER (WHERE chg) AS s_name, any_value(s_country) FILTER (WHERE chg) AS s_country,
         any_value(s_amount) FILTER (WHERE chg) AS s_amount, any_value(s_status) FILTER (WHERE chg) AS s_status,
         any_value(s_ts) FILTER (WHERE chg) AS s_ts
  FROM pairs GROUP BY rid
)
"""

DUP_MERGE = DUP_CTE + """
SELECT t.transaction_id, t.customer_id,
       CASE WHEN p.q = 1 THEN p.s_name ELSE t.customer_name END AS customer_name,
       CASE WHEN p.q = 1 THEN p.s_country ELSE t.country END AS country,
       CASE WHEN p.q = 1 THEN p.s_amount ELSE t.amount END AS amount,
       t.transaction_date,
       CASE WHEN p.q = 1 THEN p.s_status ELSE t.status END AS status,
       CASE WHEN p.q = 1 THEN p.s_ts ELSE t.last_updated END AS last_updated,
       CASE WHEN p.rid IS NULL THEN 'KEEP' WHEN p.q = 1 THEN 'UPDATE' ELSE 'NOOP' END AS action
FROM t LEFT JOIN per_t p ON t.rid = p.rid
UNION ALL
SELECT s.transaction_id, s.customer_id, s.customer_name, s.country, s.amount, s.transaction_date, s.status,
       s.last_updated, 'INSERT' AS action
FROM src2 s WHERE NOT EXISTS (SELECT 1 FROM tgt2 WHERE tgt2.transaction_id = s.transaction_id)
"""


# The merge of the pending source rows, by correlated lookups on unique keys.
DELTA_MERGE = CTE.rstrip() + """, delta AS (
  SELECT *, 1 AS present FROM src_all WHERE status = 'pending'
), j AS (
  SELECT t.*, d.present AS hit, d.customer_name AS d_name, d.country AS d_country, d.amount AS d_amount, d.status AS d_status, d.last_updated AS d_ts,
         coalesce(t.status <> d.status OR t.customer_name <> d.customer_name OR t.amount <> d.amount, false) AS chg
  FROM tgt t LEFT JOIN delta d ON t.transaction_id = d.transaction_id
)
SELECT transaction_id, customer_id, CASE WHEN chg THEN d_name ELSE customer_name END AS customer_name,
       CASE WHEN chg THEN d_country ELSE country END AS country, CASE WHEN chg THEN d_amount ELSE amount END AS amount, transaction_date,
       CASE WHEN chg THEN d_status ELSE status END AS status, CASE WHEN chg THEN d_ts ELSE last_updated END AS last_updated,
       CASE WHEN hit IS NULL THEN 'KEEP' WHEN chg THEN 'UPDATE' ELSE 'NOOP' END AS action
FROM j
UNION ALL
SELECT transaction_id, customer_id, customer_name, country, amount, transaction_date, status, last_updated, 'INSERT'
FROM delta WHERE transaction_id NOT IN (SELECT transaction_id FROM tgt)
"""


def _q(body: str) -> str:
    return CTE + body


ORACLE_SQL: dict[str, str] = {
    "merge_upsert": _q(f"SELECT {FINAL_COLS} FROM merged"),
    "merge_inserts": _q(f"SELECT {FINAL_COLS} FROM merged WHERE action = 'INSERT'"),
    "merge_updates": _q(f"SELECT {FINAL_COLS} FROM merged WHERE action = 'UPDATE'"),
    "merge_noop": _q(f"SELECT {FINAL_COLS} FROM merged WHERE action = 'NOOP'"),
    "merge_kept": _q(f"SELECT {FINAL_COLS} FROM merged WHERE action = 'KEEP'"),
    "merge_duplicate_keys": DUP_MERGE,
    "merge_delta": DELTA_MERGE,
    "merge_partitioned": _q(f"SELECT {FINAL_COLS} FROM merged"),
    "merge_bucketed": _q(f"SELECT {FINAL_COLS} FROM merged"),
    "merge_action_counts": _q("SELECT action, COUNT(*) AS rows FROM merged GROUP BY action"),
    "merge_affected_rows": _q("SELECT COUNT(*) AS affected_rows FROM merged WHERE action IN ('INSERT', 'UPDATE')"),
    "merge_source": _q("SELECT * FROM src_all"),
    "enriched_star": _q(
        "SELECT t.*, c.customer_name, c.country FROM stg t LEFT JOIN kcust c ON t.customer_id = c.customer_id"
    ),
    "enrich_left_join": _q(
        "SELECT t.transaction_id, t.customer_id, c.customer_name "
        "FROM stg t LEFT JOIN kcust c ON t.customer_id = c.customer_id"
    ),
    "change_detect": _q(
        "SELECT t.transaction_id, coalesce(t.status <> s.status OR t.customer_name <> s.customer_name "
        "OR t.amount <> s.amount, false) AS changed FROM tgt t JOIN src s ON t.transaction_id = s.transaction_id"
    ),
    "change_detect_repeated": DUP_CTE + "SELECT t.transaction_id, p.q > 0 AS changed FROM t JOIN per_t p ON t.rid = p.rid",
    "cast_numeric": _q("SELECT transaction_id, CAST(amount AS DECIMAL(38,9)) AS amount FROM stg"),
    "to_date": _q("SELECT transaction_id, CAST(transaction_date AS DATE) AS transaction_date FROM stg"),
    "not_null_check": _q("SELECT transaction_id FROM stg WHERE transaction_id IS NOT NULL"),
    "pk_duplicates": _q(
        "SELECT transaction_id, COUNT(*) AS n FROM (SELECT * FROM stg UNION ALL SELECT * FROM stg_ninth) "
        "GROUP BY transaction_id HAVING COUNT(*) > 1"
    ),
    "status_summary": _q(
        "SELECT status, COUNT(*) AS total_records, SUM(amount) AS total_amount, MAX(last_updated) AS latest_update "
        "FROM merged GROUP BY status ORDER BY total_records DESC, status"
    ),
    "status_totals": _q("SELECT status, COUNT(*) AS total, SUM(amount) AS total_amount FROM merged GROUP BY status"),
    "summary_by_version": _q("SELECT status, COUNT(*) AS total, SUM(CAST(amount AS DECIMAL(38,9))) AS total_amount FROM stg GROUP BY status"),
    "row_count": _q(
        "SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders "
        "UNION ALL SELECT 'customer', COUNT(*) FROM customer "
        "UNION ALL SELECT 'nation', COUNT(*) FROM nation "
        "UNION ALL SELECT 'transactions_staging', COUNT(*) FROM stg "
        "UNION ALL SELECT 'customers', COUNT(*) FROM cust "
        "UNION ALL SELECT 'final_table', COUNT(*) FROM tgt"
    ),
    "sample_rows": _q("SELECT * FROM stg ORDER BY transaction_id LIMIT 10"),
    "seed_if_empty": _q("SELECT * FROM cust"),
    "insert_append": _q("SELECT * FROM cust UNION ALL SELECT * FROM cust"),
    "staging_full_refresh": _q("SELECT * FROM stg"),
    "snapshot_export": _q("SELECT * FROM stg"),
    "export_range_scan": _q("SELECT * FROM stg WHERE transaction_date BETWEEN '1995-01-01' AND '1995-12-31'"),
    "external_parquet_scan": _q("SELECT * FROM stg"),
    "external_table_refresh": _q("SELECT * FROM stg"),
    "commit_append": _q("SELECT * FROM stg"),
    "snapshot_latest": _q("SELECT * FROM stg"),
    "commit_overwrite": _q("SELECT * FROM stg_odd"),
    "external_lake_scan": _q("SELECT * FROM stg"),
    "external_lake_catalog": _q("SELECT * FROM stg"),
    "union_versions": _q("SELECT * FROM stg_even UNION ALL SELECT * FROM stg_odd"),
    "version_from_name": (
        "SELECT name, CASE WHEN regexp_matches(name, '^([0-9]{20})\\.json$') "
        "THEN CAST(regexp_extract(name, '^([0-9]{20})\\.json$', 1) AS BIGINT) END AS version "
        "FROM (SELECT lpad(CAST(o_orderkey AS VARCHAR), 20, '0') || "
        "CASE WHEN o_orderkey % 10 = 0 THEN '.checkpoint.parquet' ELSE '.json' END AS name FROM orders)"
    ),
    "path_basename": "SELECT page_id, string_split(url, '/')[-1] AS basename FROM pages",
    "path_trim": "SELECT page_id, trim(url, '/') AS trimmed, rtrim(url, '/') AS rtrimmed FROM pages",
    "uri_rewrite": (
        "SELECT c_custkey, 'azure://lakeacct.blob.core.windows.net/container' || CAST(c_custkey % 7 AS VARCHAR) "
        "|| '/data/' || CAST(c_custkey AS VARCHAR) || '/' AS blob_uri FROM customer"
    ),
    "job_final_table": _q(f"SELECT {FINAL_COLS} FROM merged"),
    "table_info": _q(
        "SELECT 'transactions_staging' AS table_name, 'MANAGED' AS table_type, COUNT(*) AS num_rows FROM mstg "
        "UNION ALL SELECT 'customers', 'MANAGED', COUNT(*) FROM kcust "
        "UNION ALL SELECT 'final_table', 'EXTERNAL', COUNT(*) FROM merged"
    ),
}
