"""The operational tables as SQL, for the check queries."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
STORED: set[str] = set()


def define(name: str, sql: str, stored: bool = False) -> None:
    """A table definition; it may refer to itself. ``stored`` has it computed once where it is read many times."""
    CTES[name] = sql.strip()
    if stored:
        STORED.add(name)


def with_ctes(body: str) -> str:
    """Prefix a statement with every table definition it mentions, directly or not."""
    wanted: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"\b[a-z_][a-z0-9_]*\b", sql):
            if word in CTES and word not in wanted and CTES[word] is not sql:
                visit(CTES[word])
                if word not in wanted:
                    wanted.append(word)

    visit(body)
    if not wanted:
        return body
    heads = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in STORED else ''}(\n{CTES[name]}\n)" for name in wanted)
    recursive = "RECURSIVE " if any(re.search(rf"\b{name}\b", CTES[name]) for name in wanted) else ""
    return f"WITH {recursive}{heads}\n{body}"


define("ops_warehouses", """
SELECT CAST(n_nationkey AS BIGINT) AS warehouse_id, n_name AS warehouse_name, r_name AS region
FROM nation JOIN region ON r_regionkey = n_regionkey""")
define("ops_suppliers", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier")
define("ops_products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS sku_group, p_type AS category,
       CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, CAST(p_size AS BIGINT) AS reorder_point
FROM part""")
define("ops_customers", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment,
       MIN(CAST(o_orderdate AS DATE)) AS signup_date
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_name, c_mktsegment""")
define("ops_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS warehouse_id,
       o_orderpriority AS employee_id, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' ELSE 'unfulfilled' END AS order_status
FROM orders JOIN customer ON c_custkey = o_custkey""")
define("ops_order_items", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
       p.unit_price
FROM lineitem JOIN ops_products AS p ON p.product_id = l_partkey""")
define("ops_deliveries", """
SELECT concat(CAST(order_id AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR)) AS delivery_id,
       order_id, l_suppkey AS supplier_id, warehouse_id,
       CAST(order_date + CAST(ship_lag AS INT) AS DATE) AS shipped_date,
       CASE WHEN order_status = 'fulfilled'
            THEN CAST(order_date + CAST(ship_lag + transit AS INT) AS DATE) END AS delivered_date,
       CAST(order_date + 14 AS DATE) AS promised_delivery_date,
       supplier_late,
       CASE WHEN order_status = 'fulfilled' THEN 'delivered' ELSE 'backordered' END AS delivery_status
FROM (
    SELECT o.order_id, o.order_date, o.order_status, o.warehouse_id, l.l_suppkey,
           MAX(l.l_linenumber) + o.warehouse_id % 4 AS ship_lag,
           CAST(MAX(l.l_quantity) AS INT) % 9 + 1 AS transit,
           MAX(l.l_returnflag = 'R') AS supplier_late
    FROM ops_orders AS o JOIN lineitem AS l ON l.l_orderkey = o.order_id
    GROUP BY o.order_id, o.order_date, o.order_status, o.warehouse_id, l.l_suppkey
) AS g""")
define("ops_inventory_snapshots", """
SELECT concat(CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR), '-',
              strftime(l_shipdate, '%Y%m%d')) AS snapshot_id,
       CAST(l_shipdate AS DATE) AS snapshot_date, l_partkey AS product_id,
       CAST(s_nationkey AS BIGINT) AS warehouse_id, l_suppkey AS supplier_id,
       CASE WHEN MIN(l_quantity) <= 5 THEN 0 ELSE CAST(MIN(l_quantity) AS BIGINT) END AS quantity_on_hand,
       CAST(p_size AS BIGINT) AS reorder_point, MIN(l_quantity) <= 5 AS stockout_flag
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
GROUP BY l_partkey, l_suppkey, l_shipdate, s_nationkey, p_size""")
define("ops_support_tickets", """
SELECT event_id AS ticket_id, user_id AS customer_id, CAST(ts AS DATE) AS ticket_date,
       event_type AS issue_type,
       CASE WHEN value >= 100 THEN 'high' WHEN value >= 30 THEN 'medium' ELSE 'low' END AS priority,
       CASE WHEN event_id % 8 = 0 THEN 'open' ELSE 'resolved' END AS resolution_status
FROM events""")
