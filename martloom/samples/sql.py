"""The same derived tables as SQL, for the side-by-side check. One common table expression per table."""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-01-31 12:00:00'"
BATCH_ID = "BATCH_20240131120000"
JOB_NAME = "RETAIL_DATA_MART_Job"
POLICY_RUN_DATE = "DATE '2000-06-30'"

# table -> (tables it is built from, its select)
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "customer_dim": (
        (),
        """
SELECT CAST(c_custkey AS INTEGER) AS customer_id,
  CASE WHEN c_custkey % 97 = 5 THEN '   ' ELSE c_name END AS customername,
  CASE WHEN c_custkey % 59 = 7 THEN NULL ELSE CAST(c_custkey % 111 AS INTEGER) END AS spending_score,
  CAST(floor(c_acctbal / 100) AS INTEGER) AS annual_incomek,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 53 = 11 THEN NULL ELSE CAST(c_custkey % 130 AS INTEGER) END AS age,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'citizen' WHEN 'AUTOMOBILE' THEN 'Citizen'
    WHEN 'MACHINERY' THEN 'foriegn' WHEN 'HOUSEHOLD' THEN 'FORIEGN' WHEN 'FURNITURE' THEN 'non-citizen'
  END AS customertype
FROM customer""",
    ),
    "retail_dim": (
        (),
        """
SELECT CAST(s_suppkey AS INTEGER) AS stockid, s_name AS name,
  CASE WHEN s_suppkey % 37 = 9 THEN NULL ELSE CAST(s_suppkey % 7 AS INTEGER) END AS rating,
  n_name AS location, CAST(floor(s_acctbal / 10) AS INTEGER) AS noofemployees
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "product_dim": (
        (),
        """
SELECT CAST(p_partkey AS INTEGER) AS productid,
  CASE WHEN p_partkey % 89 = 3 THEN '' ELSE p_name END AS productname,
  p_type AS category, p_brand AS subcategory,
  CASE WHEN p_partkey % 41 = 0 THEN -1 ELSE CAST(floor(p_retailprice) AS INTEGER) END AS sales,
  CASE WHEN p_partkey % 67 = 1 THEN NULL ELSE p_size END AS quantity
FROM part""",
    ),
    "transactions_fact": (
        (),
        """
SELECT CAST(l_suppkey AS INTEGER) AS stockid,
  CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE 'INV' || CAST(l_orderkey AS VARCHAR) END AS invoiceid,
  l_returnflag || '-' || l_linestatus AS description,
  CASE WHEN l_orderkey % 307 = 1 THEN NULL WHEN l_orderkey % 73 = 0 THEN 0
    ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  CASE WHEN l_orderkey % 10 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
    ELSE strftime(l_shipdate, '%Y%m%d') END AS invoice_date,
  CASE WHEN l_orderkey % 83 = 0 THEN -1 ELSE CAST(floor(l_extendedprice) AS INTEGER) END AS price,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS customer_id,
  n_name AS country, CAST(l_partkey AS INTEGER) AS productid
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "policy_src": (
        (),
        """
SELECT CASE WHEN o_orderkey % 199 = 0 THEN NULL ELSE o_orderkey END AS policy_id,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'HOLDER_' || CAST(o_custkey AS VARCHAR) END AS policy_holder_name,
  o_orderpriority AS policy_type, CAST(o_totalprice AS DECIMAL(10,2)) AS premium_amount,
  CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 365 END AS end_date,
  o_orderdate AS updated_date, 'POLICY_SYS' AS source_system
FROM orders""",
    ),
    "dim_policy": (
        (),
        """
SELECT CASE WHEN is_current THEN o_orderkey + 1 ELSE -(o_orderkey + 1) END AS policy_key,
  o_orderkey AS policy_id,
  CASE WHEN o_orderkey % 31 = 0 OR o_orderkey % 7 = 0 THEN NULL
    ELSE 'HOLDER_' || CAST(o_custkey AS VARCHAR) END AS policy_holder_name,
  o_orderpriority AS policy_type,
  CAST(CAST(o_totalprice AS DECIMAL(10,2)) + CASE WHEN o_orderkey % 5 = 0 THEN 10.00 ELSE 0.00 END
    AS DECIMAL(10,2)) AS premium_amount,
  CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 365 END AS end_date,
  CASE WHEN is_current THEN DATE '1995-01-01' ELSE DATE '1994-01-01' END AS effective_from,
  CASE WHEN is_current THEN NULL ELSE DATE '1994-12-31' END AS effective_to,
  CASE WHEN is_current THEN 'Y' ELSE 'N' END AS current_flag,
  CASE WHEN is_current AND o_orderkey % 4 = 1 THEN 2 ELSE 1 END AS version_no,
  'POLICY_SYS' AS source_system, o_orderdate AS updated_date, 'BATCH_19950101000000' AS batch_id
FROM (SELECT *, true AS is_current FROM orders UNION ALL
      SELECT *, false AS is_current FROM orders WHERE o_orderkey % 4 = 1) AS versions
WHERE o_orderkey % 3 <> 0""",
    ),
    "job_audit_log": (
        (),
        """
SELECT 'BATCH_E' || CAST(event_id AS VARCHAR) AS batch_id, event_type AS job_name, ts AS start_time,
  CASE WHEN event_id % 4 = 3 THEN NULL
    ELSE ts + to_microseconds(CAST(CAST("value" AS DECIMAL(18,6)) * 1000000 AS BIGINT)) END AS end_time,
  CASE event_id % 4 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SUCCESS_WITH_REJECTS'
    ELSE 'RUNNING' END AS status,
  user_id AS source_count, event_id % 1000 AS target_inserts, CAST(0 AS BIGINT) AS target_updates,
  CASE WHEN event_id % 4 = 1 THEN 'failed' END AS error_message
FROM events""",
    ),
    "data_quality_metrics": (
        (),
        """
SELECT event_id AS metric_id, 'TABLE_' || CAST(user_id % 10 AS VARCHAR) AS table_name,
  'metric_' || event_type AS metric_name, CAST("value" AS DECIMAL(18,2)) AS metric_value,
  CASE event_id % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' ELSE 'WARNING' END AS status,
  ts AS check_timestamp
FROM events""",
    ),
    "customer_dim_audit": (
        ("customer_dim",),
        """
SELECT b.batch_id, customer_id, customername,
  spending_score + CASE WHEN customer_id % 4 = 0 THEN 5 ELSE 0 END AS spending_score,
  CASE WHEN customer_id % 17 <> 0 THEN annual_incomek END AS annual_incomek
FROM customer_dim JOIN (VALUES ('BATCH_20240129120000', 0), ('BATCH_20240130120000', 1),
  ('BATCH_20240201120000', 2)) AS b(batch_id, n)
  ON (n = 0 AND customer_id % 2 = 0) OR (n = 1 AND customer_id % 3 <> 0) OR (n = 2 AND customer_id % 5 = 0)""",
    ),
    "previous_customer_dim": (
        ("customer_dim",),
        """
SELECT CASE WHEN customer_id % 29 = 1 THEN customer_id + 1000000000 ELSE customer_id END AS customer_id,
  customername, spending_score, annual_incomek,
  CASE WHEN customer_id % 19 <> 0 THEN gender END AS gender,
  CASE WHEN customer_id % 6 = 0 THEN age - 1 ELSE age END AS age, customertype
FROM customer_dim WHERE customer_id % 13 <> 0""",
    ),
    "job_parameters": (
        (),
        """
SELECT c_custkey + 1 AS parameter_id, 'JOB_' || CAST(c_custkey AS VARCHAR) AS job_name, 'commit_batch' AS parameter_name,
  CAST(c_custkey * 10 AS VARCHAR) AS parameter_value, 'INTEGER' AS parameter_type,
  'kept as set' AS description, true AS is_active
FROM customer WHERE c_custkey % 3 = 0""",
    ),
}


def with_tables(names: str, body: str) -> str:
    """``WITH <named tables and what they need> <body>``.

    ``body`` is either a select or further common table expressions starting with a comma.
    """
    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        for other in _TABLES[name][0]:
            need(other)
        wanted.append(name)

    for name in names.split():
        need(name)
    ctes = ",\n".join(f"{name} AS ({_TABLES[name][1]})" for name in wanted)
    return f"WITH {ctes}\n{body.strip()}"


RETAIL_TABLES = "customer_dim retail_dim transactions_fact product_dim"
