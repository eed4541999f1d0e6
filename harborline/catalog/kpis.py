"""KPI queries and reporting views."""

from __future__ import annotations

from harborline.catalog.ctes import define, with_ctes
from harborline.catalog.registry import query, rounded
from harborline.plans import kpi

SQL: dict[str, tuple[str, tuple[str, ...]]] = {}

# Every statement is written from the definition of its KPI, in another form than the plan it
# checks: filtered counts, arg_max, row positions and correlated look-ups.
_BREACH = "delivered_date > promised_delivery_date IS NOT FALSE"
_ON_TIME = "delivered_date <= promised_delivery_date"


def _tile(order: str) -> str:
    """The tile of five from a row's position: the first n % 5 tiles hold one row more."""
    at = f"(ROW_NUMBER() OVER (ORDER BY {order}) - 1)"
    wide = "(n // 5 + 1)"
    return (f"1 + CASE WHEN {at} < n % 5 * {wide} THEN {at} // {wide} "
            f"ELSE ({at} - n % 5) // greatest(n // 5, 1) END")


define("kpi_monthly_fulfilment", """
SELECT order_date.strftime('%Y-%m') AS month, COUNT(*) AS total_orders,
       COUNT(*) FILTER (order_status = 'fulfilled') AS fulfilled_orders
FROM ops_orders GROUP BY ALL""")
define("order_money", """
SELECT order_id, COUNT(*) AS lines, SUM(quantity)::BIGINT AS pieces, SUM(unit_price * quantity) AS money
FROM ops_order_items GROUP BY ALL""")
define("kpi_supplier", """
SELECT t.*, m.mean AS average_supplier_late_rate, supplier_late_rate - m.mean AS difference_from_average
FROM (SELECT supplier_id, any_value(supplier_name) AS supplier_name, COUNT(late) AS delivery_count,
             COUNT(*) FILTER (late) AS late_deliveries,
             COUNT(*) FILTER (late) / greatest(COUNT(late), 1)::DOUBLE AS supplier_late_rate
      FROM (SELECT supplier_id, supplier_name, NULL::BOOLEAN AS late FROM ops_suppliers
            UNION ALL BY NAME
            SELECT supplier_id, supplier_late AS late FROM ops_deliveries SEMI JOIN ops_suppliers USING (supplier_id))
      GROUP BY supplier_id) AS t,
     (SELECT SUM(share) / (SELECT COUNT(*) FROM ops_suppliers) AS mean
      FROM (SELECT AVG(supplier_late::INT) AS share FROM ops_deliveries SEMI JOIN ops_suppliers USING (supplier_id)
            GROUP BY supplier_id)) AS m""")
define("kpi_stockout", """
SELECT snapshot_date.strftime('%Y-%m') AS month, sku_group, COUNT(*) AS snapshot_count,
       COUNT(*) FILTER (stockout_flag) AS stockout_snapshots, AVG(stockout_flag::INT) AS stockout_rate
FROM ops_products JOIN ops_inventory_snapshots USING (product_id) GROUP BY ALL""")
define("kpi_rfm", f"""
SELECT customer_id, customer_name, customer_segment, recency_days, frequency, monetary,
       {_tile("recency_days, customer_id")} AS recency_score, {_tile("frequency DESC, customer_id")} AS frequency_score,
       {_tile("monetary DESC, customer_id")} AS monetary_score
FROM (SELECT customer_id, customer_name, customer_segment, coalesce(latest - own.last_day, 99999) AS recency_days,
             coalesce(own.orders, 0) AS frequency, coalesce(own.money, 0) AS monetary, COUNT(*) OVER () AS n
      FROM ops_customers
      LEFT JOIN (SELECT customer_id, MAX(order_date) AS last_day, COUNT(*) AS orders, SUM(money) AS money
                 FROM ops_orders LEFT JOIN order_money USING (order_id)
                 WHERE order_status = 'fulfilled' GROUP BY customer_id) AS own USING (customer_id)
      CROSS JOIN (SELECT MAX(order_date) AS latest FROM ops_orders WHERE order_status = 'fulfilled')) AS measured""")
define("kpi_orders_enriched", """
SELECT order_id, order_date, order_date.strftime('%Y-%m') AS order_month, order_status, customer_id, customer_name,
       customer_segment, warehouse_id, warehouse_name, employee_id, coalesce(lines, 0) AS line_count,
       coalesce(pieces, 0) AS units, if(order_status = 'fulfilled', coalesce(money, 0), 0) AS sales_value,
       sent.first_shipped_date, sent.last_delivered_date, sent.promised_delivery_date, sent.supplier_id,
       sent.delivery_status
FROM ops_orders JOIN ops_customers USING (customer_id) JOIN ops_warehouses USING (warehouse_id)
LEFT JOIN order_money USING (order_id)
LEFT JOIN (SELECT order_id, list_min(list(shipped_date)) AS first_shipped_date,
                  list_max(list(delivered_date)) AS last_delivered_date,
                  list_min(list(promised_delivery_date)) AS promised_delivery_date,
                  list_max(list(supplier_id)) AS supplier_id, list_max(list(delivery_status)) AS delivery_status
           FROM ops_deliveries GROUP BY order_id) AS sent USING (order_id)""")
define("kpi_monthly", f"""
SELECT month, SUM(placed)::BIGINT AS order_count, SUM(done)::BIGINT AS fulfilled_orders,
       SUM(done) / SUM(placed)::DOUBLE AS fulfilment_rate, coalesce(SUM(money), 0) AS sales_value,
       coalesce(SUM(sent), 0)::BIGINT AS delivery_count, coalesce(SUM(timely), 0)::BIGINT AS on_time_deliveries,
       SUM(timely) / SUM(sent)::DOUBLE AS on_time_rate
FROM (SELECT order_date.strftime('%Y-%m') AS month, 1 AS placed, (order_status = 'fulfilled')::INT AS done,
             if(order_status = 'fulfilled', money, NULL) AS money FROM ops_orders LEFT JOIN order_money USING (order_id)
      UNION ALL BY NAME
      SELECT shipped_date.strftime('%Y-%m') AS month, 1 AS sent, coalesce({_ON_TIME}, FALSE)::INT AS timely
      FROM ops_deliveries) AS happened
GROUP BY month HAVING COUNT(placed) > 0""")
define("kpi_warehouse", f"""
SELECT warehouse_id, warehouse_name, month, coalesce(pairs, 0)::BIGINT AS order_count, days AS avg_processing_days,
       coalesce(breaches, 1)::BIGINT AS sla_breach_count, breaches / nullif(sent, 0)::DOUBLE AS sla_breach_rate
FROM ops_warehouses
LEFT JOIN (SELECT ops_orders.warehouse_id, order_date.strftime('%Y-%m') AS month, COUNT(*) AS pairs,
                  COUNT(delivery_id) AS sent, SUM(date_diff('day', order_date, shipped_date)) / COUNT(shipped_date)::DOUBLE AS days,
                  COUNT(*) FILTER ({_BREACH}) AS breaches
           FROM ops_orders LEFT JOIN ops_deliveries USING (order_id) GROUP BY ALL) AS own USING (warehouse_id)""")
define("kpi_inventory_status", """
SELECT last.snapshot_id, last.snapshot_date, product_id, product_name, sku_group, category, warehouse_id,
       warehouse_name, last.supplier_id, supplier_name, last.quantity_on_hand, last.reorder_point, last.stockout_flag,
       if(last.stockout_flag OR last.quantity_on_hand = 0, 'stockout',
          if(last.quantity_on_hand > last.reorder_point, 'healthy', 'reorder')) AS inventory_status
FROM (SELECT product_id, warehouse_id, arg_max(s, (snapshot_date, snapshot_id)) AS last
      FROM ops_inventory_snapshots AS s GROUP BY ALL) AS newest
JOIN ops_products USING (product_id) JOIN ops_warehouses USING (warehouse_id)
JOIN ops_suppliers ON ops_suppliers.supplier_id = last.supplier_id""")

SQL["j01_fulfilment_rate"] = ("""
SELECT month, total_orders, fulfilled_orders, rate AS fulfilment_rate,
       rate - (SELECT arg_max(fulfilled_orders / total_orders::DOUBLE, month) FROM kpi_monthly_fulfilment AS older
               WHERE older.month < own.month) AS mom_change
FROM (SELECT *, fulfilled_orders / total_orders::DOUBLE AS rate FROM kpi_monthly_fulfilment) AS own""",
    ("fulfilment_rate", "mom_change"))
SQL["j02_on_time_delivery"] = (f"""
SELECT shipped_date.strftime('%Y-%m') AS month, warehouse_id, COUNT(*) AS delivery_count,
       COUNT(*) FILTER ({_ON_TIME}) AS on_time_deliveries, AVG(coalesce({_ON_TIME}, FALSE)::INT) AS on_time_rate
FROM ops_deliveries GROUP BY month, warehouse_id""", ("on_time_rate",))
SQL["j03_sla_breach"] = (f"""
SELECT shipped_date.strftime('%Y-%m') AS month, warehouse_id, supplier_id, any_value(supplier_name) AS supplier_name,
       COUNT(*) AS delivery_count, COUNT(*) FILTER ({_BREACH}) AS breached_deliveries,
       AVG(({_BREACH})::INT) AS sla_breach_rate
FROM ops_suppliers JOIN ops_deliveries USING (supplier_id) GROUP BY month, warehouse_id, supplier_id""",
    ("sla_breach_rate",))
SQL["j04_warehouse_ranking"] = (f"""
WITH own AS (
  SELECT ops_orders.warehouse_id, COUNT(*) AS order_count,
         AVG(date_diff('day', order_date, shipped_date)) AS avg_processing_days, AVG(({_BREACH})::INT) AS delay_rate
  FROM ops_deliveries JOIN ops_orders USING (order_id) GROUP BY ops_orders.warehouse_id)
SELECT *, (SELECT 1 + COUNT(*) FROM own AS x WHERE x.avg_processing_days > own.avg_processing_days) AS processing_rank,
       (SELECT 1 + COUNT(DISTINCT delay_rate) FROM own AS x WHERE x.delay_rate > own.delay_rate) AS delay_rank
FROM own""", ("avg_processing_days", "delay_rate"))
SQL["j05_supplier_delay"] = ("SELECT * EXCLUDE (late_deliveries) FROM kpi_supplier",
    ("supplier_late_rate", "average_supplier_late_rate", "difference_from_average"))
SQL["j06_stockout_by_sku_group"] = ("FROM kpi_stockout", ("stockout_rate",))
SQL["j07_inventory_turnover"] = ("""
WITH sold AS (
  SELECT warehouse_id, product_id, SUM(quantity)::BIGINT AS pieces, SUM(unit_price * quantity) AS money
  FROM ops_order_items JOIN ops_orders USING (order_id) WHERE order_status = 'fulfilled' GROUP BY ALL),
held AS (
  SELECT product_id, warehouse_id, SUM(quantity_on_hand) / COUNT(*)::DOUBLE AS level
  FROM ops_inventory_snapshots GROUP BY ALL)
SELECT product_id, product_name, warehouse_id, coalesce(pieces, 0) AS units_sold, coalesce(money, 0) AS sales_value,
       level AS avg_quantity_on_hand, level * unit_price::DOUBLE AS avg_inventory_value,
       coalesce(money, 0)::DOUBLE / nullif(level * unit_price::DOUBLE, 0) AS inventory_turnover
FROM held JOIN ops_products USING (product_id) LEFT JOIN sold USING (product_id, warehouse_id)""",
    ("sales_value", "avg_quantity_on_hand", "avg_inventory_value", "inventory_turnover"))
SQL["j08_customer_cohorts"] = ("""
WITH joined AS (SELECT customer_id, date_trunc('month', signup_date) AS born FROM ops_customers),
active AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS seen FROM ops_orders)
SELECT born.strftime('%Y-%m') AS cohort_month, seen.strftime('%Y-%m') AS activity_month,
       date_diff('month', born, seen) AS months_since_signup, any_value(members) AS cohort_customers,
       COUNT(*) AS active_customers, COUNT(*) / any_value(members)::DOUBLE AS retention_rate
FROM joined JOIN active USING (customer_id)
JOIN (SELECT born, COUNT(*) AS members FROM joined GROUP BY born) USING (born)
WHERE seen >= born GROUP BY born, seen""", ("retention_rate",))
SQL["j09_customer_rfm"] = ("SELECT * EXCLUDE (customer_segment) FROM kpi_rfm", ("recency_days", "monetary"))
SQL["j10_support_tickets"] = ("""
SELECT issue_type AS category, priority, COUNT(*) AS ticket_count,
       COUNT(*) FILTER (resolution_status = 'resolved') AS resolved_ticket_count, NULL::DOUBLE AS avg_resolution_time_days
FROM ops_support_tickets GROUP BY ALL""", ())
SQL["j11_orders_enriched"] = ("FROM kpi_orders_enriched", ("sales_value",))
SQL["j12_monthly_kpis"] = ("FROM kpi_monthly", ("fulfilment_rate", "sales_value", "on_time_rate"))
SQL["j13_warehouse_performance"] = ("FROM kpi_warehouse", ("avg_processing_days", "sla_breach_rate"))
SQL["j14_supplier_performance"] = ("FROM kpi_supplier",
    ("supplier_late_rate", "average_supplier_late_rate", "difference_from_average"))
SQL["j15_inventory_status"] = ("FROM kpi_inventory_status", ())
SQL["j16_customer_rfm_view"] = ("FROM kpi_rfm", ("recency_days", "monetary"))

PLANS = {
    "j01_fulfilment_rate": kpi.fulfilment_rate,
    "j02_on_time_delivery": kpi.on_time_delivery,
    "j03_sla_breach": kpi.sla_breach,
    "j04_warehouse_ranking": kpi.warehouse_ranking,
    "j05_supplier_delay": kpi.supplier_delay,
    "j06_stockout_by_sku_group": kpi.stockout_by_sku_group,
    "j07_inventory_turnover": kpi.inventory_turnover,
    "j08_customer_cohorts": kpi.customer_cohorts,
    "j09_customer_rfm": kpi.customer_rfm,
    "j10_support_tickets": kpi.support_tickets,
    "j11_orders_enriched": kpi.orders_enriched,
    "j12_monthly_kpis": kpi.monthly_kpis,
    "j13_warehouse_performance": kpi.warehouse_performance,
    "j14_supplier_performance": kpi.supplier_performance,
    "j15_inventory_status": kpi.inventory_status,
    "j16_customer_rfm_view": kpi.customer_rfm_view,
}

for _name, _plan in PLANS.items():
    _body, _doubles = SQL[_name]
    query(_name, with_ctes(rounded(_body, _doubles)))(_plan)
