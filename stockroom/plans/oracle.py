"""DuckDB oracle SQL for the registered queries.

Written separately from the Spark side (windows and EXISTS where Spark uses
aggregates and semi joins), so agreement means something.  Tables are the
views ``part customer nation orders lineitem ...`` over the same parquet
files.  Money is summed as decimal and presented as DOUBLE, as on the
Spark side.
"""

_CUSTOMER_BATCH = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey * 10 AS seq
      FROM customer WHERE c_custkey % 10 = 0
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey * 10 + 1
      FROM customer WHERE c_custkey % 100 = 1
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey * 10 + 2
      FROM customer WHERE c_custkey % 50 = 0
    UNION ALL
    SELECT c_custkey + 1000000, c_name, CAST(99 AS INTEGER), c_acctbal, c_mktsegment, c_custkey * 10 + 3
      FROM customer WHERE c_custkey % 75 = 0
    UNION ALL
    SELECT CAST(NULL AS BIGINT), c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey * 10 + 4
      FROM customer WHERE c_custkey % 50 = 3
"""

_CUSTOMER_VERDICTS = f"""
    WITH batch AS ({_CUSTOMER_BATCH}),
    ranked AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY seq) AS rn FROM batch
    )
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, seq,
      CASE
        WHEN c_custkey IS NULL THEN 'null_key'
        WHEN rn > 1 THEN 'duplicate_in_batch'
        WHEN EXISTS (SELECT 1 FROM customer e
                     WHERE e.c_custkey % 10 <> 0 AND e.c_custkey = ranked.c_custkey)
          THEN 'already_exists'
        WHEN NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = ranked.c_nationkey)
          THEN 'unknown_nation'
        ELSE 'accepted'
      END AS verdict
    FROM ranked
"""

_ORDER_VERDICTS = """
    WITH batch AS (
      SELECT o_orderkey,
             CASE WHEN o_orderkey % 100 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS o_custkey,
             o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderkey * 10 AS seq
      FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 1000 = 7
    ),
    ranked AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY seq) AS rn FROM batch
    )
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, seq,
      CASE
        WHEN o_orderkey IS NULL THEN 'null_key'
        WHEN rn > 1 THEN 'duplicate_in_batch'
        WHEN EXISTS (SELECT 1 FROM orders e
                     WHERE e.o_orderkey % 10 <> 0 AND e.o_orderkey = ranked.o_orderkey)
          THEN 'already_exists'
        WHEN NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = ranked.o_custkey)
          THEN 'unknown_customer'
        ELSE 'accepted'
      END AS verdict
    FROM ranked
"""

_ORDER_TOTALS = """
    SELECT o_custkey, COUNT(*) AS n_orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price,
           MAX(o_orderdate) AS last_order_date, CAST(0 AS BIGINT) AS n_unfit
    FROM orders GROUP BY o_custkey
"""

_PRICED = """
    SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN 1e11 WHEN o_orderkey % 11 = 0 THEN 1e30
                           WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice) FROM orders
"""

_PRODUCT_COLS = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"

ORACLE = {
    "product_list": f"SELECT {_PRODUCT_COLS} FROM part",
    "product_page": f"SELECT {_PRODUCT_COLS} FROM part ORDER BY p_name, p_partkey LIMIT 50",
    "upsert_products": """
        WITH batch AS (
          SELECT p_partkey, p_name, p_brand, p_type, p_size,
                 CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice
          FROM part WHERE p_partkey % 10 < 2
          UNION ALL
          SELECT p_partkey + 1000000, p_name, p_brand, p_type, p_size, p_retailprice
          FROM part WHERE p_partkey % 20 = 5
        )
        SELECT COALESCE(b.p_partkey, c.p_partkey) AS p_partkey,
               CASE WHEN b.p_partkey IS NULL THEN c.p_name ELSE b.p_name END AS p_name,
               CASE WHEN b.p_partkey IS NULL THEN c.p_brand ELSE b.p_brand END AS p_brand,
               CASE WHEN b.p_partkey IS NULL THEN c.p_type ELSE b.p_type END AS p_type,
               CASE WHEN b.p_partkey IS NULL THEN c.p_size ELSE b.p_size END AS p_size,
               CASE WHEN b.p_partkey IS NULL THEN c.p_retailprice ELSE b.p_retailprice END AS p_retailprice,
               CASE
                 WHEN c.p_partkey IS NULL THEN 'inserted'
                 WHEN b.p_partkey IS NULL THEN 'kept'
                 WHEN c.p_name IS NOT DISTINCT FROM b.p_name
                  AND c.p_brand IS NOT DISTINCT FROM b.p_brand
                  AND c.p_type IS NOT DISTINCT FROM b.p_type
                  AND c.p_size IS NOT DISTINCT FROM b.p_size
                  AND c.p_retailprice IS NOT DISTINCT FROM b.p_retailprice THEN 'unchanged'
                 ELSE 'updated'
               END AS action
        FROM part c FULL OUTER JOIN batch b ON c.p_partkey = b.p_partkey
    """,
    "add_customers": _CUSTOMER_VERDICTS,
    "customers_after_add": f"""
        WITH v AS ({_CUSTOMER_VERDICTS})
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 10 <> 0
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v WHERE verdict = 'accepted'
    """,
    "get_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
        WHERE o_custkey = 7 AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'
    """,
    "accept_orders": _ORDER_VERDICTS,
    "accept_orders_repeats": """
        WITH once AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey,
                             o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderkey * 2 AS seq
                      FROM orders),
             batch AS (SELECT * FROM once UNION ALL SELECT * REPLACE (seq + 1 AS seq) FROM once)
        SELECT b.*, CASE WHEN o_orderkey IS NULL THEN 'null_key'
                         WHEN seq % 2 = 1 THEN 'duplicate_in_batch'
                         WHEN o_orderkey % 10 <> 0 AND o_orderkey % 3 = 0 THEN 'already_exists'
                         WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'unknown_customer'
                         ELSE 'accepted' END AS verdict
        FROM batch b
    """,
    "upsert_products_seq": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice + 3 AS p_retailprice,
               CASE WHEN p_partkey % 4 = 0 THEN 'inserted' ELSE 'updated' END AS action
        FROM part
    """,
    "call_orders_of_year": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
        WHERE o_custkey = 7 AND o_orderdate >= TIMESTAMP '1996-01-01 12:00:00'
          AND o_orderdate < TIMESTAMP '1998-01-01 12:00:00'
    """,
    "customer_orders": """
        SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    """,
    "order_lines": """
        SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_partkey, p_name, p_brand,
               l_quantity, l_extendedprice, l_discount,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(7,6)))
                         AS DECIMAL(20,8)) AS DOUBLE) AS amount
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
    """,
    "order_totals": _ORDER_TOTALS,
    "order_totals_wide": f"""
        SELECT o_custkey, COUNT(*) AS n_orders,
               CAST(SUM(TRY_CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) AS total_price,
               MAX(o_orderdate) AS last_order_date,
               COUNT(*) FILTER (WHERE abs(o_totalprice) >= 1e26) AS n_unfit
        FROM ({_PRICED}) GROUP BY o_custkey
    """,
    "order_lines_wide": """
        SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_partkey, p_name, p_brand, l_quantity,
               CASE WHEN l_orderkey % 7 = 0 THEN 1e11 WHEN l_orderkey % 11 = 0 THEN 1e30
                    ELSE l_extendedprice END AS l_extendedprice,
               l_discount,
               CAST(CASE WHEN l_orderkey % 7 = 0 THEN CAST(100000000000 AS DECIMAL(28,2))
                         WHEN l_orderkey % 11 = 0 THEN NULL
                         ELSE CAST(l_extendedprice AS DECIMAL(28,2)) END
                    * CAST(1 - CAST(l_discount AS DECIMAL(7,6)) AS DECIMAL(8,6)) AS DOUBLE) AS amount
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
    """,
    "accept_orders_prices": f"""
        SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN 1e11 ELSE o_totalprice END AS o_totalprice,
                          CASE WHEN verdict = 'accepted' AND o_orderkey % 7 = 0 THEN 'bad_value'
                               ELSE verdict END AS verdict)
        FROM ({_ORDER_VERDICTS})
    """,
    "keep_customers": f"""
        WITH v AS ({_CUSTOMER_VERDICTS})
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 10 <> 0
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v WHERE verdict = 'accepted'
    """,
    "keep_orders": f"""
        SELECT *, 'stored' AS verdict FROM orders WHERE o_orderkey % 10 <> 0
        UNION ALL
        SELECT * EXCLUDE (seq) REPLACE (CASE verdict WHEN 'accepted' THEN 'stored' ELSE verdict END AS verdict)
        FROM ({_ORDER_VERDICTS})
    """,
    "keep_products": """
        WITH one AS (
          SELECT * REPLACE (CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice)
          FROM part
          UNION ALL
          SELECT * REPLACE (p_partkey + 1000000 AS p_partkey) FROM part WHERE p_partkey % 20 = 5
        )
        SELECT one.p_partkey, one.p_name, one.p_brand, one.p_type, one.p_size,
               CASE WHEN part.p_partkey % 3 = 0 THEN part.p_retailprice * 2 ELSE one.p_retailprice END AS p_retailprice
        FROM one LEFT JOIN part USING (p_partkey)
    """,
    "call_customer_orders": """
        SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    """,
    "call_product_page": f"""
        SELECT {_PRODUCT_COLS}, CAST(CASE WHEN place <= 20 THEN 1 ELSE 2 END AS INTEGER) AS page
        FROM (SELECT *, row_number() OVER (ORDER BY p_name, p_partkey) AS place FROM part) WHERE place <= 40
    """,
    "call_get_orders": """
        SELECT c_custkey, c_name, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
        FROM customer JOIN orders ON o_custkey = c_custkey
    """,
    "call_order_lines": """
        SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_quantity
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """,
    "trigger_accepted_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST(CASE WHEN o_orderdate < DATE '1998-01-01' THEN 0 ELSE 1 END AS BIGINT) AS batch_id
        FROM orders
    """,
    "trigger_audit": """
        SELECT o_orderkey AS key, 'accepted' AS verdict, CAST(0 AS BIGINT) AS batch_id
        FROM orders WHERE o_orderdate < DATE '1998-01-01'
        UNION ALL
        SELECT o_orderkey,
               CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'already_exists' ELSE 'accepted' END,
               CAST(1 AS BIGINT)
        FROM orders WHERE o_orderdate >= DATE '1997-07-01'
    """,
    "trigger_order_totals": _ORDER_TOTALS,
    # The parts land as files of their own: a repeat of a key that an earlier
    # file brought in exists by then.
    "trigger_add_customers": f"""
        WITH v AS ({_CUSTOMER_VERDICTS})
        SELECT c_custkey AS key,
               CASE WHEN verdict = 'duplicate_in_batch'
                     AND EXISTS (SELECT 1 FROM v e WHERE e.c_custkey = v.c_custkey AND e.seq < v.seq
                                 AND e.verdict IN ('accepted', 'already_exists'))
                    THEN 'already_exists' ELSE verdict END AS verdict,
               CAST(0 AS BIGINT) AS batch_id
        FROM v
    """,
    "trigger_orders_split": """
        SELECT o_orderkey AS key, CASE WHEN o_orderkey % 10 = 0 THEN 'unknown_customer'
                                       WHEN o_orderkey % 7 = 0 THEN 'bad_value' ELSE 'accepted' END AS verdict
        FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 THEN 'accepted'
                                ELSE 'already_exists' END
        FROM orders
    """,
}
ORACLE["order_lines_salted"] = ORACLE["order_lines"]
ORACLE["sql_add_customers"] = _CUSTOMER_VERDICTS
ORACLE["sql_customers_after"] = ORACLE["customers_after_add"]
ORACLE["sql_accept_orders"] = _ORDER_VERDICTS
