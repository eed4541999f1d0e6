"""Decomposition of the fulfilment change between two months."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog.analytics import erfc_sql
from harborline.catalog.ctes import define, with_ctes
from harborline.catalog.registry import query, rounded
from harborline.functions.dates import in_month
from harborline.operators.storage import staged
from harborline.plans import decompose

# The two latest observed months, in SQL.
define("periods", """
SELECT MIN(m) AS period_a, MAX(m) AS period_b
FROM (SELECT DISTINCT strftime(order_date, '%Y-%m') AS m FROM ops_orders ORDER BY m DESC LIMIT 2) AS latest""")
SQL_A, SQL_B = "(SELECT period_a FROM periods)", "(SELECT period_b FROM periods)"


def periods(ops) -> tuple[str, str]:
    """The two latest observed months of the orders."""
    return tuple(decompose.latest_two_months(ops["order_headers"]).first())

define("order_facts", """
SELECT o.order_id, o.order_date, o.order_status = 'fulfilled' AS fulfilled, o.warehouse_id,
       CAST(o.warehouse_id AS VARCHAR) AS warehouse,
       COALESCE(CAST(s.supplier_id AS VARCHAR), 'Unknown supplier') AS supplier,
       COALESCE(g.sku_group, 'Unknown') AS sku_group, COALESCE(w.region, 'Unknown') AS region
FROM ops_orders AS o
LEFT JOIN (SELECT order_id, MIN(supplier_id) AS supplier_id FROM ops_deliveries GROUP BY 1) AS s
    ON s.order_id = o.order_id
LEFT JOIN (
    SELECT order_id, sku_group FROM (
        SELECT order_id, sku_group, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY COUNT(*) DESC, sku_group) AS rn
        FROM ops_order_items AS i JOIN ops_products AS p ON p.product_id = i.product_id GROUP BY 1, 2
    ) AS n WHERE rn = 1
) AS g ON g.order_id = o.order_id
LEFT JOIN ops_warehouses AS w ON w.warehouse_id = o.warehouse_id""")
define("overall", f"""
SELECT total_a, total_b, hits_a, hits_b, CAST(hits_a AS DOUBLE) / total_a AS value_a,
       CAST(hits_b AS DOUBLE) / total_b AS value_b,
       CAST(hits_b AS DOUBLE) / total_b - CAST(hits_a AS DOUBLE) / total_a AS change
FROM (SELECT COUNT(*) FILTER (WHERE m = {SQL_A}) AS total_a, COUNT(*) FILTER (WHERE m = {SQL_B}) AS total_b,
             COUNT(*) FILTER (WHERE m = {SQL_A} AND fulfilled) AS hits_a,
             COUNT(*) FILTER (WHERE m = {SQL_B} AND fulfilled) AS hits_b
      FROM (SELECT *, strftime(order_date, '%Y-%m') AS m FROM order_facts) AS f) AS c""")
_COUNTS = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS segment, strftime(order_date, '%Y-%m') AS m, fulfilled FROM order_facts"
    for d in decompose.DIMENSIONS
)
_PROPORTION = erfc_sql("abs((h_b / n_b - h_a / n_a) / sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b))) / sqrt(2.0::DOUBLE)")
define("factors", f"""
SELECT dimension, segment, rate_a, rate_b, orders_a, orders_b, contribution, contribution * 100 AS contribution_pp,
       CASE WHEN change <> 0 THEN contribution / change * 100 ELSE 0 END AS share_of_drop,
       rate_b - value_b AS rate_vs_overall, share AS share_of_unfulfilled, share AS share_of_delayed,
       CASE WHEN n_a > 0 AND n_b > 0 AND pooled * (1 - pooled) > 0 THEN {_PROPORTION} ELSE 1 END AS p_value,
       ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY ROUND(contribution, 12), segment) AS dimension_rank,
       ROW_NUMBER() OVER (ORDER BY ROUND(contribution, 12), dimension, segment) AS overall_rank
FROM (
    SELECT c.*, o.change, o.value_b, CAST(n_a AS BIGINT) AS orders_a, CAST(n_b AS BIGINT) AS orders_b,
           (h_a + h_b) / (n_a + n_b) AS pooled,
           COALESCE(h_a / NULLIF(n_a, 0), 0) AS rate_a, COALESCE(h_b / NULLIF(n_b, 0), 0) AS rate_b,
           n_b / total_b * COALESCE(h_b / NULLIF(n_b, 0), 0) - n_a / total_a * COALESCE(h_a / NULLIF(n_a, 0), 0)
               AS contribution,
           COALESCE((n_b - h_b) / NULLIF(total_b - hits_b, 0), 0) AS share
    FROM (SELECT dimension, segment, CAST(COUNT(*) FILTER (WHERE m = {SQL_A}) AS DOUBLE) AS n_a,
                 CAST(COUNT(*) FILTER (WHERE m = {SQL_B}) AS DOUBLE) AS n_b,
                 CAST(COUNT(*) FILTER (WHERE m = {SQL_A} AND fulfilled) AS DOUBLE) AS h_a,
                 CAST(COUNT(*) FILTER (WHERE m = {SQL_B} AND fulfilled) AS DOUBLE) AS h_b
          FROM ({_COUNTS}) AS u WHERE m IN ({SQL_A}, {SQL_B}) GROUP BY 1, 2) AS c, overall AS o
) AS r""")

NUMBERS = ("rate_a", "rate_b", "contribution", "contribution_pp", "share_of_drop", "rate_vs_overall",
           "share_of_unfulfilled", "share_of_delayed", "p_value")


def factors(ops):
    return decompose.decompose_months(ops, *periods(ops))


@query("l01_order_facts", with_ctes("SELECT * FROM order_facts"))
def order_facts(ops):
    """Orders with one segment per dimension."""
    return decompose.order_facts(ops)


@query("l02_period_rates", with_ctes(rounded("SELECT * FROM overall", ("value_a", "value_b", "change"))))
def period_rates(ops):
    """Totals and rates of both months."""
    facts = ops["order_headers"].withColumn("fulfilled", F.col("order_status") == "fulfilled")
    return decompose.overall_rates(facts, *(in_month("order_date", p) for p in periods(ops)))


@query("l03_contribution", with_ctes(rounded("SELECT * FROM factors", NUMBERS)))
def contribution(ops):
    """All factors of the change, all dimensions in one aggregation."""
    return factors(ops)


@query("l04_share_of_drop", with_ctes(rounded("SELECT dimension, segment, share_of_drop FROM factors", ("share_of_drop",))))
def share_of_drop(ops):
    """Contribution as a percentage of the change."""
    return factors(ops).select("dimension", "segment", "share_of_drop")


@query("l05_rate_vs_overall", with_ctes(rounded(
    "SELECT dimension, segment, rate_vs_overall, share_of_unfulfilled, share_of_delayed FROM factors",
    ("rate_vs_overall", "share_of_unfulfilled", "share_of_delayed"))))
def rate_vs_overall(ops):
    """Rate against the overall rate and share of missed orders."""
    return factors(ops).select("dimension", "segment", "rate_vs_overall", "share_of_unfulfilled", "share_of_delayed")


@query("l06_two_proportion_p", with_ctes(rounded("SELECT dimension, segment, p_value FROM factors", ("p_value",))))
def two_proportion_p(ops):
    """Significance of the change of each segment's rate."""
    return factors(ops).select("dimension", "segment", "p_value")


@query("l07_region_is_warehouse", with_ctes("""
SELECT COUNT(*) > 0 AND COUNT(DISTINCT warehouse_id) = COUNT(*) AND COUNT(DISTINCT region) = COUNT(*) AS one_to_one
FROM (SELECT DISTINCT warehouse_id, region FROM order_facts) AS p"""))
def region_is_warehouse(ops):
    """Whether region merely renames warehouse."""
    places = ops["orders"].select("warehouse_id").distinct().join(
        ops["warehouses"].select("warehouse_id", "region"), "warehouse_id", "left")
    return decompose.region_is_warehouse(places)


@query("l08_top_factors", with_ctes(rounded("SELECT * FROM factors WHERE dimension_rank <= 3", NUMBERS)))
def top_factors(ops):
    """The three most adverse factors of each dimension."""
    return decompose.top_factors(factors(ops))


@query("l09_additivity", with_ctes(rounded("""
SELECT dimension, SUM(contribution) AS contribution, SUM(share_of_drop) AS share_of_drop, MAX(change) AS change
FROM factors, overall GROUP BY 1""", ("contribution", "share_of_drop", "change"))))
def additivity(ops):
    """Contributions of each dimension add up to the change."""
    facts = ops["order_headers"].withColumn("fulfilled", F.col("order_status") == "fulfilled")
    overall = decompose.overall_rates(facts, *(in_month("order_date", p) for p in periods(ops)))
    return decompose.additivity(factors(ops)).withColumn("change", overall.select("change").scalar())


@query("l10_latest_two_months", with_ctes("""
SELECT MIN(m) AS period_a, MAX(m) AS period_b
FROM (SELECT DISTINCT strftime(order_date, '%Y-%m') AS m FROM ops_orders ORDER BY 1 DESC LIMIT 2) AS t"""))
def latest_two_months(ops):
    """The two latest observed months."""
    return decompose.latest_two_months(ops["order_headers"])


@query("a12_flattened_report", with_ctes(rounded(f"""
SELECT 'fulfilment' AS kpi, {SQL_A} AS period_a, {SQL_B} AS period_b, value_a, value_b, change,
       dimension, segment, rate_a, rate_b, orders_a, orders_b, contribution_pp, share_of_drop, rate_vs_overall,
       share_of_unfulfilled, p_value, dimension_rank, overall_rank
FROM factors, overall WHERE dimension_rank <= 3""",
    ("value_a", "value_b", "change", "rate_a", "rate_b", "contribution_pp", "share_of_drop", "rate_vs_overall",
     "share_of_unfulfilled", "p_value"))))
def flattened_report(ops):
    """The nested report written as JSON, read back and flattened."""
    from harborline.sources import reports

    months = periods(ops)
    a, b = (in_month("order_date", p) for p in months)
    facts = staged(decompose.order_facts(ops, a | b), "facts")
    overall = decompose.overall_rates(facts, a, b)
    nested = decompose.report(decompose.decompose_months(ops, *months), overall, *months)
    return reports.flatten_report(reports.round_trip(nested))
