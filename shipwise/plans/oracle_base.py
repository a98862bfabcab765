"""DuckDB SQL building blocks for the oracle queries.

These are independent re-statements of the engine's semantics in plain SQL
(plain windows, self-joins); the engine itself uses DataFrame plans.
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)"


def dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


SHIPMENTS = f"""
shipments AS (
  SELECT row_key, order_id, customer_id, product_name,
    CASE WHEN u2 < {dbl(0.001)} THEN NULL ELSE c_name END AS customer_lname,
    CAST(CASE WHEN u2 >= {dbl(0.001)} AND u2 < {dbl(0.0015)} THEN NULL
         ELSE 10000 + c_custkey % 90000 END AS BIGINT) AS customer_zipcode,
    CAST(CASE WHEN u3 < {dbl(0.86)} THEN NULL ELSE 10000 + o_orderkey % 90000 END AS BIGINT)
      AS order_zipcode,
    CAST(NULL AS VARCHAR) AS product_description,
    o_orderpriority AS shipping_mode,
    CAST(days_scheduled AS INTEGER) AS days_scheduled,
    CAST(late AS INTEGER) AS late_delivery_risk,
    CAST(days_scheduled + CASE WHEN late = 1 THEN 1 + l_linenumber % 3 ELSE 0 END AS INTEGER)
      AS days_real,
    CASE WHEN u3 >= {dbl(0.99)} THEN NULL
         WHEN u3 >= {dbl(0.95)} THEN 'Shipping canceled'
         WHEN late = 1 THEN 'Late' ELSE 'On time' END AS delivery_status,
    r_name AS order_region, n_name AS order_country,
    n_name || '-' || CAST(c_custkey % 50 AS VARCHAR) AS order_city,
    CASE WHEN u2 > {dbl(0.999)} THEN NULL ELSE p_type END AS category_name,
    p_brand AS department_name, c_mktsegment AS customer_segment,
    l_linestatus AS payment_type, o_orderstatus AS order_status,
    CAST(o_orderdate AS TIMESTAMP) AS order_date, CAST(l_shipdate AS TIMESTAMP) AS shipping_date,
    CAST(floor(l_extendedprice / l_quantity + 0.5) AS DOUBLE) / 100.0 AS price,
    CAST(floor((l_extendedprice * (1.0 - l_discount) - p_retailprice * l_quantity) / 10.0 + 0.5)
         AS DOUBLE) / 100.0 AS profit
  FROM (
    SELECT *,
      CASE WHEN u1 < p_late THEN 1 ELSE 0 END AS late,
      CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
           WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS days_scheduled
    FROM (
      SELECT *,
        CASE WHEN p_type = 'PROMO' THEN base_p + {dbl(0.03)}
             WHEN p_type = 'SMALL' THEN base_p - {dbl(0.03)} ELSE base_p END AS p_late
      FROM (
        SELECT *,
          CAST(('0x' || substr(row_key, 1, 8))::UBIGINT AS DOUBLE) / {dbl(4294967296)} AS u1,
          CAST(('0x' || substr(row_key, 9, 8))::UBIGINT AS DOUBLE) / {dbl(4294967296)} AS u2,
          CAST(('0x' || substr(row_key, 17, 8))::UBIGINT AS DOUBLE) / {dbl(4294967296)} AS u3,
          CASE o_orderpriority WHEN '1-URGENT' THEN {dbl(0.95)} WHEN '2-HIGH' THEN {dbl(0.76)}
               WHEN '3-MEDIUM' THEN {dbl(0.50)} WHEN '4-NOT SPECIFIED' THEN {dbl(0.45)}
               ELSE {dbl(0.40)} END AS base_p
        FROM (
          SELECT l.*, o.*, c.*, n.*, r.*, p.*, l_orderkey AS order_id, o_custkey AS customer_id,
            p_name AS product_name,
            md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS row_key
          FROM lineitem l
          JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey
          JOIN part p ON l.l_partkey = p.p_partkey
        ) base
      ) hashed
    ) probs
  ) labelled
)"""

CLEANED = """
cleaned AS (
  SELECT * EXCLUDE (product_description, order_zipcode) FROM shipments
  WHERE delivery_status IS DISTINCT FROM 'Shipping canceled'
    AND customer_lname IS NOT NULL AND customer_zipcode IS NOT NULL
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
