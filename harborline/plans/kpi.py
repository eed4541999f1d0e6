"""Monthly KPIs and reporting views.

Every function takes the operational tables it reads and returns a frame. Facts are
reduced to one row per join key before they are joined, and dimensions join last.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions import days_between, month_key, months_apart, safe_ratio
from harborline.operators.joins import fact_join, first_per_key
from harborline.operators.ordering import ntile_scaled
from harborline.operators.storage import staged

Tables = Mapping[str, DataFrame]

FULFILLED = "fulfilled"
NEVER_BOUGHT_DAYS = 99999  # recency of a customer without fulfilled orders


def order_lines(ops: Tables) -> DataFrame:
    """Order items without the price where the tables offer them so, else with it."""
    return ops["order_lines"] if "order_lines" in ops else ops["order_items"]


def supplier_marks(ops: Tables) -> DataFrame:
    """Deliveries with order, supplier and lateness only where the tables offer them so."""
    return ops["supplier_marks"] if "supplier_marks" in ops else ops["deliveries"]


def is_fulfilled() -> Column:
    return F.col("order_status") == FULFILLED


def on_time() -> Column:
    return F.col("delivered_date").isNotNull() & (
        F.col("delivered_date") <= F.col("promised_delivery_date")
    )


def breached() -> Column:
    return F.col("delivered_date").isNull() | (
        F.col("delivered_date") > F.col("promised_delivery_date")
    )


def stock_status() -> Column:
    return (
        F.when(F.col("stockout_flag") | (F.col("quantity_on_hand") == 0), "stockout")
        .when(F.col("quantity_on_hand") <= F.col("reorder_point"), "reorder")
        .otherwise("healthy")
    )


def fulfilment_rate(ops: Tables) -> DataFrame:
    """Orders and fulfilled orders per month; change against the previous observed month."""
    monthly = ops["order_headers"].groupBy(month_key("order_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(is_fulfilled()).alias("fulfilled_orders"),
    ).withColumn("fulfilment_rate", safe_ratio("fulfilled_orders", "total_orders"))
    previous = F.lag("fulfilment_rate").over(Window.orderBy("month"))
    return monthly.withColumn("mom_change", F.col("fulfilment_rate") - previous).orderBy("month")


def on_time_delivery(ops: Tables) -> DataFrame:
    """Share of deliveries on or before the promise, by shipping month and warehouse."""
    return ops["deliveries"].groupBy(month_key("shipped_date").alias("month"), "warehouse_id").agg(
        F.count(F.lit(1)).alias("delivery_count"),
        F.count_if(on_time()).alias("on_time_deliveries"),
    ).withColumn("on_time_rate", safe_ratio("on_time_deliveries", "delivery_count")).orderBy(
        "month", "warehouse_id"
    )


def sla_breach(ops: Tables) -> DataFrame:
    """Share of late or open deliveries by shipping month, warehouse and supplier."""
    counts = ops["deliveries"].groupBy(
        month_key("shipped_date").alias("month"), "warehouse_id", "supplier_id"
    ).agg(
        F.count(F.lit(1)).alias("delivery_count"),
        F.count_if(breached()).alias("breached_deliveries"),
    )
    return counts.join(ops["suppliers"].select("supplier_id", "supplier_name"), "supplier_id").select(
        "month", "warehouse_id", "supplier_id", "supplier_name", "delivery_count",
        "breached_deliveries",
        safe_ratio("breached_deliveries", "delivery_count").alias("sla_breach_rate"),
    ).orderBy("month", "warehouse_id", "supplier_id")


def _delivery_totals(deliveries: DataFrame) -> DataFrame:
    """Per order: number of deliveries, sum of shipping day numbers, breaches."""
    return deliveries.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_deliveries"),
        F.count("shipped_date").alias("n_shipped"),
        F.sum(F.unix_date("shipped_date")).alias("shipped_days"),
        F.count_if(breached()).alias("n_breached"),
    )


def _processing_days() -> Column:
    """Mean days from order to shipment over all order-delivery pairs of a group."""
    spent = F.col("shipped_days") - F.col("n_shipped") * F.unix_date("order_date")
    return safe_ratio(F.sum(spent), F.sum("n_shipped"))


def warehouse_ranking(ops: Tables) -> DataFrame:
    """Processing time and delay rate per warehouse over order-delivery pairs, ranked."""
    pairs = fact_join(ops["orders"], _delivery_totals(ops["deliveries"]), "order_id")
    rows = pairs.groupBy("warehouse_id").agg(
        F.sum("n_deliveries").alias("order_count"),
        _processing_days().alias("avg_processing_days"),
        safe_ratio(F.sum("n_breached"), F.sum("n_deliveries")).alias("delay_rate"),
    )
    # One row per warehouse is left, so the ranking windows are small.
    return rows.withColumn(
        "processing_rank", F.rank().over(Window.orderBy(F.desc_nulls_last("avg_processing_days")))
    ).withColumn(
        "delay_rank", F.dense_rank().over(Window.orderBy(F.desc_nulls_last("delay_rate")))
    ).orderBy("processing_rank", "delay_rank", "warehouse_id")


def supplier_performance(ops: Tables) -> DataFrame:
    """Late share per supplier against the unweighted mean over all suppliers.

    A supplier without deliveries counts into the mean with rate 0.
    """
    # A delivery's key is never null, so its rows are its deliveries.
    counts = supplier_marks(ops).groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("delivery_count"),
        F.count_if(F.col("supplier_late")).alias("late_deliveries"),
    )
    rates = ops["suppliers"].join(counts, "supplier_id", "left").select(
        "supplier_id",
        "supplier_name",
        F.coalesce("delivery_count", F.lit(0)).alias("delivery_count"),
        F.coalesce("late_deliveries", F.lit(0)).alias("late_deliveries"),
        F.coalesce(safe_ratio("late_deliveries", "delivery_count"), F.lit(0.0)).alias("supplier_late_rate"),
    )
    mean = rates.agg(F.avg("supplier_late_rate")).scalar()
    return rates.withColumn("average_supplier_late_rate", mean).withColumn(
        "difference_from_average",
        F.col("supplier_late_rate") - F.col("average_supplier_late_rate"),
    )


def supplier_delay(ops: Tables) -> DataFrame:
    """Supplier late rates, worst first."""
    return supplier_performance(ops).drop("late_deliveries").orderBy(
        F.desc("supplier_late_rate"), "supplier_id"
    )


def stockout_by_sku_group(ops: Tables) -> DataFrame:
    """Share of out-of-stock snapshots by month and SKU group."""
    # Product totals first: the join to products then sees one row per product and month.
    per_product = ops["inventory_snapshots"].groupBy(
        month_key("snapshot_date").alias("month"), "product_id"
    ).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("stockout_flag")).alias("out")
    )
    return per_product.join(ops["products"].select("product_id", "sku_group"), "product_id").groupBy(
        "month", "sku_group"
    ).agg(
        F.sum("n").alias("snapshot_count"), F.sum("out").alias("stockout_snapshots")
    ).withColumn("stockout_rate", safe_ratio("stockout_snapshots", "snapshot_count")).orderBy(
        "month", "sku_group"
    )


def inventory_turnover(ops: Tables) -> DataFrame:
    """Fulfilled sales value against average stock value per product and warehouse."""
    stock = ops["inventory_snapshots"].groupBy("product_id", "warehouse_id").agg(
        F.avg("quantity_on_hand").alias("avg_quantity_on_hand")
    )
    done = ops["orders"].filter(is_fulfilled()).select("order_id", "warehouse_id")
    sales = fact_join(ops["order_items"], done, "order_id").groupBy("product_id", "warehouse_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("sales_value"),
        F.sum("quantity").alias("units_sold"),
    )
    price = ops["products"].select("product_id", "product_name", "unit_price")
    value = F.col("avg_quantity_on_hand") * F.col("unit_price").cast("double")
    return stock.join(sales, ["product_id", "warehouse_id"], "left").join(price, "product_id").select(
        "product_id",
        "product_name",
        "warehouse_id",
        F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
        F.coalesce(F.col("sales_value").cast("double"), F.lit(0.0)).alias("sales_value"),
        "avg_quantity_on_hand",
        value.alias("avg_inventory_value"),
        safe_ratio(F.coalesce(F.col("sales_value").cast("double"), F.lit(0.0)), value)
        .alias("inventory_turnover"),
    )


def customer_cohorts(ops: Tables) -> DataFrame:
    """Customers of each signup month that ordered in a later month."""
    cohort = ops["customers"].select(
        "customer_id", month_key("signup_date").alias("cohort_month")
    )
    sizes = cohort.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_customers"))
    active = ops["order_headers"].select(
        "customer_id", month_key("order_date").alias("activity_month")
    ).distinct()
    # (customer, month) is distinct, so counting rows counts customers.
    retained = active.join(cohort, "customer_id").filter(
        F.col("activity_month") >= F.col("cohort_month")
    ).groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("active_customers"))
    return retained.join(sizes, "cohort_month").select(
        "cohort_month",
        "activity_month",
        months_apart(F.col("activity_month"), F.col("cohort_month")).alias("months_since_signup"),
        "cohort_customers",
        "active_customers",
        safe_ratio("active_customers", "cohort_customers").alias("retention_rate"),
    ).orderBy("cohort_month", "activity_month")


def order_totals(ops: Tables) -> DataFrame:
    """Lines, units and value per order, as the tables offer them or from the items."""
    if "order_totals" in ops:
        return ops["order_totals"]
    return ops["order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("value"),
    )


def order_values(ops: Tables) -> DataFrame:
    """Item value per order."""
    return order_totals(ops).select("order_id", F.col("value").alias("order_value"))


def customer_rfm_base(ops: Tables) -> DataFrame:
    """Recency, frequency and monetary value of fulfilled orders for every customer."""
    done = ops["order_headers"].filter(is_fulfilled())
    latest = done.agg(F.max("order_date")).scalar()
    per_customer = fact_join(done, order_values(ops), "order_id", "left").groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"),
        F.count("order_id").alias("frequency"),
        F.sum("order_value").alias("monetary"),
    )
    return ops["customers"].join(per_customer, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "customer_segment",
        F.coalesce(days_between(latest, F.col("last_order")), F.lit(float(NEVER_BOUGHT_DAYS)))
        .alias("recency_days"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.coalesce(F.col("monetary").cast("double"), F.lit(0.0)).alias("monetary"),
    )


def customer_rfm_view(ops: Tables, score_high_is_best: bool = False) -> DataFrame:
    """RFM measures with quintile scores; 1 is the best fifth unless turned around."""
    base = staged(customer_rfm_base(ops), "rfm")
    scored = ntile_scaled(base, "customer_id", 5, {
        "recency_score": F.col("recency_days"),
        "frequency_score": -F.col("frequency"),
        "monetary_score": -F.col("monetary"),
    })
    if score_high_is_best:
        for name in ("recency_score", "frequency_score", "monetary_score"):
            scored = scored.withColumn(name, 6 - F.col(name))
    return scored


def customer_rfm(ops: Tables, score_high_is_best: bool = False) -> DataFrame:
    """RFM report, one row per customer in no particular order."""
    return customer_rfm_view(ops, score_high_is_best).drop("customer_segment")


def support_tickets(ops: Tables) -> DataFrame:
    """Tickets by category and priority; the source has no resolution time."""
    return ops["support_tickets"].groupBy(F.col("issue_type").alias("category"), "priority").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        F.count_if(F.col("resolution_status") == "resolved").alias("resolved_ticket_count"),
    ).withColumn("avg_resolution_time_days", F.lit(None).cast("double")).orderBy(
        "category", "priority"
    )


def orders_enriched(ops: Tables) -> DataFrame:
    """One row per order with customer, warehouse, item and delivery attributes."""
    items = order_totals(ops)
    shipped = ops["deliveries"].groupBy("order_id").agg(
        F.min("shipped_date").alias("first_shipped_date"),
        F.max("delivered_date").alias("last_delivered_date"),
        F.min("promised_delivery_date").alias("promised_delivery_date"),
        F.max("supplier_id").alias("supplier_id"),
        F.max("delivery_status").alias("delivery_status"),
    )
    customers = ops["customers"].select("customer_id", "customer_name", "customer_segment")
    warehouses = ops["warehouses"].select("warehouse_id", "warehouse_name")
    return (
        fact_join(fact_join(ops["orders"], items, "order_id", "left"), shipped, "order_id", "left")
        .join(customers, "customer_id")
        .join(warehouses, "warehouse_id")
        .select(
            "order_id", "order_date", month_key("order_date").alias("order_month"), "order_status",
            "customer_id", "customer_name", "customer_segment", "warehouse_id", "warehouse_name",
            "employee_id",
            F.coalesce("line_count", F.lit(0)).alias("line_count"),
            F.coalesce("units", F.lit(0)).alias("units"),
            F.when(is_fulfilled(), F.coalesce(F.col("value").cast("double"), F.lit(0.0)))
            .otherwise(0.0).alias("sales_value"),
            "first_shipped_date", "last_delivered_date", "promised_delivery_date", "supplier_id",
            "delivery_status",
        )
    )


def monthly_kpis(ops: Tables) -> DataFrame:
    """Orders, sales and deliveries per order month; deliveries by shipping month."""
    orders = ops["order_headers"].groupBy(month_key("order_date").alias("month")).agg(
        F.count(F.lit(1)).alias("order_count"), F.count_if(is_fulfilled()).alias("fulfilled_orders")
    )
    done = ops["order_headers"].filter(is_fulfilled())
    sales = fact_join(done, order_values(ops), "order_id").groupBy(month_key("order_date").alias("month")).agg(
        F.sum("order_value").alias("sales_value")
    )
    shipped = ops["deliveries"].groupBy(month_key("shipped_date").alias("month")).agg(
        F.count(F.lit(1)).alias("delivery_count"), F.count_if(on_time()).alias("on_time_deliveries")
    )
    return orders.join(sales, "month", "left").join(shipped, "month", "left").select(
        "month",
        "order_count",
        "fulfilled_orders",
        safe_ratio("fulfilled_orders", "order_count").alias("fulfilment_rate"),
        F.coalesce(F.col("sales_value").cast("double"), F.lit(0.0)).alias("sales_value"),
        F.coalesce("delivery_count", F.lit(0)).alias("delivery_count"),
        F.coalesce("on_time_deliveries", F.lit(0)).alias("on_time_deliveries"),
        safe_ratio("on_time_deliveries", "delivery_count").alias("on_time_rate"),
    )


def warehouse_performance(ops: Tables) -> DataFrame:
    """Warehouse and order month over order-delivery pairs.

    An order without delivery is one pair: it counts as an order and as a breach but
    not in the denominator of the breach rate. An idle warehouse keeps one row with a
    null month, which is such a pair as well.
    """
    pairs = fact_join(ops["orders"], _delivery_totals(ops["deliveries"]), "order_id", "left")
    known = F.coalesce("n_deliveries", F.lit(0))
    monthly = pairs.groupBy("warehouse_id", month_key("order_date").alias("month")).agg(
        F.sum(F.greatest(known, F.lit(1))).alias("order_count"),
        _processing_days().alias("avg_processing_days"),
        F.sum(F.coalesce("n_breached", F.lit(1))).alias("sla_breach_count"),
        F.sum(known).alias("_deliveries"),
    )
    return ops["warehouses"].select("warehouse_id", "warehouse_name").join(
        monthly, "warehouse_id", "left"
    ).select(
        "warehouse_id",
        "warehouse_name",
        "month",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        "avg_processing_days",
        F.coalesce("sla_breach_count", F.lit(1)).alias("sla_breach_count"),
        safe_ratio("sla_breach_count", "_deliveries").alias("sla_breach_rate"),
    )


def latest_snapshots(ops: Tables) -> DataFrame:
    """Last snapshot per product and warehouse."""
    kept = ["snapshot_id", "snapshot_date", "supplier_id", "quantity_on_hand", "reorder_point",
            "stockout_flag"]
    # The order comes first in the struct, so it is not carried beside it.
    order = ["snapshot_date", "snapshot_id"]
    picked = F.max(F.struct(*order, *[c for c in kept if c not in order])).alias("last")
    return ops["inventory_snapshots"].groupBy("product_id", "warehouse_id").agg(picked).select(
        "product_id", "warehouse_id", *[f"last.{c}" for c in kept]
    )


def inventory_status(ops: Tables) -> DataFrame:
    """Latest snapshot per product and warehouse with its stock status."""
    return (
        latest_snapshots(ops)
        .join(ops["products"].select("product_id", "product_name", "sku_group", "category"), "product_id")
        .join(ops["warehouses"].select("warehouse_id", "warehouse_name"), "warehouse_id")
        .join(ops["suppliers"], "supplier_id")
        .select(
            "snapshot_id", "snapshot_date", "product_id", "product_name", "sku_group", "category",
            "warehouse_id", "warehouse_name", "supplier_id", "supplier_name", "quantity_on_hand",
            "reorder_point", "stockout_flag", stock_status().alias("inventory_status"),
        )
    )


def first_deliveries(deliveries: DataFrame) -> DataFrame:
    """First delivery per order by shipping date, ties by delivery id."""
    return first_per_key(
        deliveries, ["order_id"],
        [F.col("shipped_date").isNull(), F.col("shipped_date"), F.col("delivery_id")],
        ["supplier_id", "shipped_date", "delivered_date", "promised_delivery_date", "supplier_late"],
    )
