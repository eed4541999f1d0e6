"""Measures of the reporting model."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import analytics, decomposition, kpis  # noqa: F401  (define the SQL tables)
from harborline.catalog.ctes import with_ctes
from harborline.catalog.registry import query, rounded
from harborline.functions import days_between, mean_of, safe_ratio
from harborline.operators.storage import staged
from harborline.plans import decompose, features, kpi, segments
from harborline.plans.measures import histogram, measure, share_of
from harborline.sources.calendar import calendar_of

# The year selected on the calendar: the latest one with orders.
LATEST_YEAR = "(SELECT strftime(MAX(order_date), '%Y') FROM ops_orders)"


def chosen_months(ops):
    """Months of the latest year with orders, as a calendar slicer yields them."""
    days = calendar_of(ops["order_headers"], "order_date")
    latest = days.agg(F.max("year")).scalar()
    return days.filter(F.col("year") == latest).select(F.date_format("date", "yyyy-MM").alias("month")).distinct()


def monthly_measures():
    return {
        "orders": F.sum("order_count"),
        "fulfilled_orders": F.sum("fulfilled_orders"),
        "fulfilment_rate": safe_ratio(F.sum("fulfilled_orders"), F.sum("order_count")),
        "sales_value": F.sum("sales_value"),
        "deliveries": F.sum("delivery_count"),
        "on_time_rate": safe_ratio(F.sum("on_time_deliveries"), F.sum("delivery_count")),
    }


MONTHLY_SQL = """
SELECT CAST(SUM(order_count) AS BIGINT) AS orders, CAST(SUM(fulfilled_orders) AS BIGINT) AS fulfilled_orders,
       CAST(SUM(fulfilled_orders) AS DOUBLE) / NULLIF(SUM(order_count), 0) AS fulfilment_rate,
       SUM(sales_value) AS sales_value, CAST(SUM(delivery_count) AS BIGINT) AS deliveries,
       CAST(SUM(on_time_deliveries) AS DOUBLE) / NULLIF(SUM(delivery_count), 0) AS on_time_rate
FROM kpi_monthly"""
RATES = ("fulfilment_rate", "sales_value", "on_time_rate")


@query("n01_monthly_measures", with_ctes(rounded(MONTHLY_SQL, RATES)))
def monthly_totals(ops):
    """Orders, sales and deliveries over all months, rates as ratios of sums."""
    return measure(kpi.monthly_kpis(ops), monthly_measures())


@query("n02_calendar_measures", with_ctes(rounded(f"{MONTHLY_SQL} WHERE substr(month, 1, 4) = {LATEST_YEAR}", RATES)))
def calendar_measures(ops):
    """The same for the months selected on the calendar."""
    return measure(kpi.monthly_kpis(ops), monthly_measures(), within=(chosen_months(ops), "month"))


WAREHOUSE_RATES = ("average_processing_days", "average_sla_breach_rate")
WAREHOUSE_SQL = """
SELECT warehouse_id, AVG(avg_processing_days) AS average_processing_days,
       AVG(sla_breach_rate) AS average_sla_breach_rate
FROM kpi_warehouse"""


def _warehouse(ops, **context):
    return measure(kpi.warehouse_performance(ops), {
        "average_processing_days": F.avg("avg_processing_days"),
        "average_sla_breach_rate": F.avg("sla_breach_rate"),
    }, by=["warehouse_id"], **context)


@query("n03_warehouse_measures", with_ctes(rounded(f"{WAREHOUSE_SQL} GROUP BY 1", WAREHOUSE_RATES)))
def warehouse_measures(ops):
    """Unweighted means over warehouse-months."""
    return _warehouse(ops)


@query("n03_calendar_warehouse_measures", with_ctes(rounded(
    f"{WAREHOUSE_SQL} WHERE substr(month, 1, 4) = {LATEST_YEAR} GROUP BY 1", WAREHOUSE_RATES)))
def calendar_warehouse_measures(ops):
    """The same for the selected months."""
    return _warehouse(ops, within=(chosen_months(ops), "month"))


@query("n04_order_measures", with_ctes(rounded("""
SELECT order_status, COUNT(DISTINCT order_id) AS operational_orders, AVG(processing_days) AS average_processing_days,
       AVG(CAST(is_late AS INT)) AS late_order_share FROM features GROUP BY 1""",
    ("average_processing_days", "late_order_share"))))
def order_measures(ops):
    """Orders, processing days and late share by status."""
    return measure(features.order_features(ops), {
        "operational_orders": F.count_distinct("order_id"),
        "average_processing_days": F.avg("processing_days"),
        "late_order_share": mean_of("is_late"),
    }, by=["order_status"])


@query("n05_daily_warehouse_load", with_ctes(rounded("""
SELECT AVG(load) AS average_daily_load FROM (
    SELECT MAX(warehouse_load) AS load FROM features GROUP BY warehouse_id, order_date) AS d""",
    ("average_daily_load",))))
def daily_warehouse_load(ops):
    """Mean over warehouse-days of the day's load."""
    daily = measure(features.order_features(ops), {"load": F.max("warehouse_load")}, by=["warehouse_id", "order_date"])
    return measure(daily, {"average_daily_load": F.avg("load")})


@query("n06_order_anomaly_rows", with_ctes(
    "SELECT 'order_processing_time' AS anomaly_type, COUNT(*) AS anomaly_rows FROM outliers WHERE iqr_flag OR z_score_flag"))
def order_anomaly_rows(ops):
    """Anomalous orders."""
    found = features.order_anomalies(staged(features.order_features(ops), "features"))
    return measure(found, {"anomaly_rows": F.count(F.lit(1))}, by=["anomaly_type"])


@query("n06_anomaly_rows", with_ctes("SELECT anomaly_type, COUNT(*) AS anomaly_rows FROM all_anomalies GROUP BY 1"))
def anomaly_rows(ops):
    """Anomalies by type, warehouse-days included."""
    found = features.anomalies(staged(features.order_features(ops), "features"))
    return measure(found, {"anomaly_rows": F.count(F.lit(1))}, by=["anomaly_type"])


@query("n07_inventory_measures", with_ctes(rounded("""
SELECT sku_group, CAST(SUM(snapshot_count) AS BIGINT) AS snapshots, CAST(SUM(stockout_snapshots) AS BIGINT) AS stockouts,
       CAST(SUM(stockout_snapshots) AS DOUBLE) / NULLIF(SUM(snapshot_count), 0) AS stockout_rate,
       CAST(SUM(stockout_snapshots) AS DOUBLE) / (SELECT SUM(stockout_snapshots) FROM kpi_stockout) AS share_of_stockouts
FROM kpi_stockout GROUP BY 1""", ("stockout_rate", "share_of_stockouts"))))
def inventory_measures(ops):
    """Stock-outs per SKU group and their share after removing the group filter."""
    groups = measure(kpi.stockout_by_sku_group(ops), {
        "snapshots": F.sum("snapshot_count"),
        "stockouts": F.sum("stockout_snapshots"),
        "stockout_rate": safe_ratio(F.sum("stockout_snapshots"), F.sum("snapshot_count")),
    }, by=["sku_group"])
    return share_of(groups, "stockouts", [], "share_of_stockouts")


@query("n08_latest_status_counts", with_ctes("""
SELECT warehouse_name, COUNT(*) FILTER (WHERE inventory_status = 'stockout') AS products_in_stockout,
       COUNT(*) FILTER (WHERE inventory_status = 'reorder') AS reorder_products
FROM kpi_inventory_status GROUP BY 1"""))
def latest_status_counts(ops):
    """Products in stock-out and to reorder, by warehouse."""
    return measure(kpi.inventory_status(ops), {
        "products_in_stockout": F.count_if(F.col("inventory_status") == "stockout"),
        "reorder_products": F.count_if(F.col("inventory_status") == "reorder"),
    }, by=["warehouse_name"])


@query("n09_customer_measures", with_ctes(rounded("""
SELECT (SELECT COUNT(DISTINCT customer_id) FROM rfm_base) AS customers,
       (SELECT AVG(monetary) FROM rfm_base) AS average_monetary,
       (SELECT AVG(churn_risk_score) FROM churn) AS average_churn_risk,
       (SELECT COUNT(*) FROM churn WHERE ticket_count > 0) AS customers_with_tickets""",
    ("average_monetary", "average_churn_risk"))))
def customer_measures(ops):
    """Customers, value, churn risk and ticket holders."""
    value = segments.customer_rfm(ops).select("customer_id", "monetary")
    return measure(value.join(segments.churn_risk(ops), "customer_id"), {
        "customers": F.count_distinct("customer_id"),
        "average_monetary": F.avg("monetary"),
        "average_churn_risk": F.avg("churn_risk_score"),
        "customers_with_tickets": F.count_if(F.col("ticket_count") > 0),
    })


@query("n09_at_risk_customers", with_ctes("SELECT segment_label, COUNT(DISTINCT customer_id) AS customers FROM segments GROUP BY 1"))
def at_risk_customers(ops):
    """Customers per segment label."""
    found = segments.customer_segments(ops)
    return measure(found, {"customers": F.count_distinct("customer_id")}, by=["segment_label"])


@query("n10_supplier_measures", with_ctes(rounded("""
SELECT AVG(supplier_late_rate) AS supplier_late_rate, AVG(difference_from_average) AS supplier_gap
FROM kpi_supplier""", ("supplier_late_rate", "supplier_gap"))))
def supplier_measures(ops):
    """Mean late rate and gap of all suppliers."""
    return measure(kpi.supplier_performance(ops), {
        "supplier_late_rate": F.avg("supplier_late_rate"),
        "supplier_gap": F.avg("difference_from_average"),
    })


@query("n11_delivery_measures", with_ctes(rounded("""
SELECT warehouse_name, COUNT(DISTINCT order_id) FILTER (WHERE last_delivered_date IS NOT NULL) AS delivered_orders,
       AVG(CAST(last_delivered_date - first_shipped_date AS DOUBLE)) AS average_delivery_days
FROM kpi_orders_enriched GROUP BY 1""", ("average_delivery_days",))))
def delivery_measures(ops):
    """Delivered orders and days from first shipment to last delivery, by warehouse."""
    done = F.col("last_delivered_date").isNotNull()
    return measure(kpi.orders_enriched(ops), {
        "delivered_orders": F.count_distinct(F.when(done, F.col("order_id"))),
        "average_delivery_days": F.avg(days_between("last_delivered_date", "first_shipped_date")),
    }, by=["warehouse_name"])


@query("n12_factor_measures", with_ctes(rounded("""
SELECT dimension, COUNT(*) AS factors, MAX(change) * 100 AS kpi_change_pp, SUM(contribution_pp) AS contribution_pp,
       MAX(share_of_unfulfilled) AS unfulfilled_share, MIN(p_value) AS factor_p_value
FROM factors, overall WHERE dimension_rank <= 3 GROUP BY 1""",
    ("kpi_change_pp", "contribution_pp", "unfulfilled_share", "factor_p_value"))))
def factor_measures(ops):
    """Measures over the reported factors."""
    facts = ops["order_headers"].withColumn("fulfilled", F.col("order_status") == "fulfilled")
    change = decompose.overall_rates(
        facts, *(decomposition.in_month("order_date", p) for p in decomposition.periods(ops))).select("change")
    top = decompose.top_factors(decomposition.factors(ops))
    return measure(top.withColumn("change", change.scalar()), {
        "factors": F.count(F.lit(1)),
        "kpi_change_pp": F.max("change") * 100,
        "contribution_pp": F.sum("contribution_pp"),
        "unfulfilled_share": F.max("share_of_unfulfilled"),
        "factor_p_value": F.min("p_value"),
    }, by=["dimension"])


@query("n13_processing_histogram", with_ctes("""
SELECT CASE WHEN processing_days < 0 THEN 0 WHEN processing_days >= 10 THEN 6
            ELSE CAST(floor(processing_days / 2) AS BIGINT) + 1 END AS bucket, COUNT(*) AS rows
FROM features WHERE processing_days IS NOT NULL GROUP BY 1"""))
def processing_histogram(ops):
    """Distribution of processing days in buckets of two days."""
    return histogram(features.order_features(ops), "processing_days", 0.0, 10.0, 5)


@query("n13_churn_histogram", with_ctes("""
SELECT CASE WHEN churn_risk_score >= 1 THEN 11 ELSE CAST(floor(churn_risk_score * 10) AS BIGINT) + 1 END AS bucket,
       COUNT(*) AS rows FROM churn GROUP BY 1"""))
def churn_histogram(ops):
    """Distribution of the churn risk in tenths."""
    return histogram(segments.churn_risk(ops), "churn_risk_score", 0.0, 1.0, 10)


@query("n13_segment_trend", with_ctes("""
SELECT order_month, customer_segment, COUNT(*) AS orders FROM kpi_orders_enriched GROUP BY 1, 2"""))
def segment_trend(ops):
    """Orders per month and customer segment."""
    return measure(
        ops["order_headers"].join(ops["customers"].select("customer_id", "customer_segment"), "customer_id")
        .withColumn("order_month", F.date_format("order_date", "yyyy-MM")),
        {"orders": F.count(F.lit(1))}, by=["order_month", "customer_segment"],
    )


@query("n13_warehouse_month_matrix", with_ctes(rounded("""
SELECT warehouse_id, month, AVG(avg_processing_days) AS avg_processing_days FROM kpi_warehouse GROUP BY 1, 2""",
    ("avg_processing_days",))))
def warehouse_month_matrix(ops):
    """Processing days of every warehouse and month, one row per cell of the matrix."""
    return measure(kpi.warehouse_performance(ops), {"avg_processing_days": F.avg("avg_processing_days")},
                   by=["warehouse_id", "month"])
