"""DuckDB SQL for the correctness check of every registered query.

The driver runs these against the same parquet tables (registered as views).
The raw feeds are the portable SQL of FIXTURES.md §7 (sales in an equivalent
single-scan form that unnests the duplicate copies); silver and gold are
written here as plain SQL so the check is independent of the Spark code.
"""

from __future__ import annotations

CUSTOMERS_RAW = """
SELECT concat('  C', lpad(cast(c_custkey AS varchar), 6, '0'), ' ') AS customer_id,
       concat(' ', split_part(c_name, '#', 1))                     AS first_name,
       split_part(c_name, '#', 2)                                  AS last_name,
       CASE WHEN c_custkey % 20 = 0 THEN NULL
            WHEN c_custkey % 20 = 1 THEN 'no-at-sign.example.com'
            ELSE concat(upper(replace(c_name, '#', '.')), '@Example.COM ') END AS email,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            WHEN c_custkey % 17 = 1 THEN lpad(cast(c_custkey AS varchar), 9, '8')
            ELSE lpad(cast(c_custkey AS varchar), 10, '9') END       AS phone,
       concat(c_mktsegment, ' ')                                   AS city,
       n_name                                                      AS country,
       CASE WHEN c_custkey % 101 = 7 THEN date '2099-01-01'
            ELSE date '2015-01-01' + cast(c_custkey % 3000 AS int) END AS signup_date,
       CASE WHEN c_custkey % 97 = 3 THEN 400
            WHEN c_custkey % 31 = 2 THEN 12
            ELSE cast(18 + c_custkey % 60 AS int) END               AS age
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

# Lines of every 50th order arrive twice: one scan, each line unnested into one or two copies.
SALES_RAW = """
SELECT concat('S', cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar), '-', cast(l_partkey AS varchar), ' ') AS sale_id,
       concat(' C', lpad(cast(o_custkey AS varchar), 6, '0'))       AS customer_id,
       CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE concat('P', cast(l_partkey AS varchar)) END AS product_id,
       cast(o_orderdate AS date)                                   AS sale_date,
       cast(CASE WHEN l_partkey % 60 = 5 THEN -l_quantity WHEN l_partkey % 211 = 9 THEN l_quantity * 40 ELSE l_quantity END AS int) AS quantity,
       CASE WHEN l_partkey % 75 = 3 THEN 0 ELSE cast(floor(l_extendedprice) AS int) END AS amount
FROM (SELECT *, unnest(CASE WHEN l_orderkey % 50 = 0 THEN [1, 2] ELSE [1] END) AS copy_no
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

TRANSACTIONS_RAW = """
SELECT concat(' T', cast(event_id AS varchar))                      AS transaction_id,
       CASE WHEN event_id % 90 = 0 THEN NULL ELSE concat('C', lpad(cast(user_id AS varchar), 6, '0')) END AS customer_id,
       cast(ts AS date)                                            AS transaction_date,
       CASE event_id % 5 WHEN 0 THEN 'UPI ' WHEN 1 THEN 'Card' WHEN 2 THEN 'NetBanking' WHEN 3 THEN ' wallet' ELSE CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Cheque' END END AS payment_method,
       CASE event_type WHEN 'purchase' THEN ' SUCCESS' WHEN 'error' THEN 'Failed ' ELSE event_type END AS status,
       CASE WHEN event_id % 70 = 4 THEN 0 ELSE cast(floor(value) AS int) END AS amount
FROM events
"""

CUSTOMERS_SILVER = """
SELECT trim(customer_id) AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, cast(phone AS varchar) AS phone, trim(city) AS city,
       trim(country) AS country, cast(signup_date AS date) AS signup_date, cast(age AS int) AS age
FROM customers_raw WHERE trim(customer_id) IS NOT NULL
"""

SALES_SILVER = """
SELECT DISTINCT trim(sale_id) AS sale_id, trim(customer_id) AS customer_id, trim(product_id) AS product_id,
       cast(sale_date AS date) AS sale_date, cast(quantity AS int) AS quantity, cast(amount AS int) AS amount
FROM sales_raw WHERE trim(sale_id) IS NOT NULL
"""

TRANSACTIONS_SILVER = """
SELECT DISTINCT trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id,
       cast(transaction_date AS date) AS transaction_date, lower(trim(payment_method)) AS payment_method,
       lower(trim(status)) AS status, cast(amount AS int) AS amount
FROM transactions_raw WHERE trim(transaction_id) IS NOT NULL
"""

# customers deduplicated on the key: the greatest row wins (all columns compared)
CUSTOMERS_DEDUP = """
SELECT customer_id, first_name, last_name, email, phone, city, country, signup_date, age FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY first_name DESC NULLS LAST,
         last_name DESC NULLS LAST, email DESC NULLS LAST, phone DESC NULLS LAST, city DESC NULLS LAST,
         country DESC NULLS LAST, signup_date DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM customers_silver) WHERE rn = 1
"""

BASE_CTES = {
    "customers_raw": CUSTOMERS_RAW,
    "sales_raw": SALES_RAW,
    "transactions_raw": TRANSACTIONS_RAW,
    "customers_silver": CUSTOMERS_SILVER,
    "sales_silver": SALES_SILVER,
    "transactions_silver": TRANSACTIONS_SILVER,
    "customers_dedup": CUSTOMERS_DEDUP,
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the feed/silver CTEs (DuckDB skips unused ones)."""
    ctes = {**BASE_CTES, **(extra or {})}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body
