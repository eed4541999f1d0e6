"""Joins, aggregates, windows, sorting and set operations, each over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from harborline.catalog import analytics, decomposition, kpis, raw_ctes  # noqa: F401  (define the SQL tables)
from harborline.catalog.ctes import with_ctes
from harborline.catalog.registry import query, rounded
from harborline.functions import mean_of, month_key, number_tokens, safe_ratio
from harborline.functions.dates import in_month
from harborline.operators import joins, keysets, ordering
from harborline.operators.hypothesis import contingency
from harborline.operators.storage import staged
from harborline.plans import decompose, kpi, segments
from harborline.plans.measures import share_of
from harborline.sources import sinks
from harborline.sources.calendar import calendar_of
from harborline.sources.raw import RawTables

# Joins


@query("e01_fact_to_dimension", with_ctes("""
SELECT s.supplier_name, COUNT(*) AS deliveries FROM ops_deliveries AS d
JOIN ops_suppliers AS s ON s.supplier_id = d.supplier_id GROUP BY 1"""))
def fact_to_dimension(ops):
    """Inner join of a fact with a dimension, reduced per key first."""
    counts = ops["supplier_marks"].groupBy("supplier_id").agg(F.count(F.lit(1)).alias("deliveries"))
    return counts.join(ops["suppliers"], "supplier_id").groupBy("supplier_name").agg(
        F.sum("deliveries").alias("deliveries"))


@query("e02_fact_to_fact", with_ctes("""
SELECT o.order_id, o.order_status, i.product_id, i.quantity FROM ops_orders AS o
JOIN ops_order_items AS i ON i.order_id = o.order_id"""))
def fact_to_fact(ops):
    """Inner join of two facts; one order has many items."""
    return ops["order_headers"].select("order_id", "order_status").join(ops["order_lines"], "order_id").select(
        "order_id", "order_status", "product_id", "quantity")


@query("e03_dimension_preserved", with_ctes("""
SELECT c.customer_id, COUNT(t.ticket_id) AS tickets FROM ops_customers AS c
LEFT JOIN ops_support_tickets AS t ON t.customer_id = c.customer_id GROUP BY 1"""))
def dimension_preserved(ops):
    """Left join that keeps members without activity."""
    return segments.ticket_counts(ops).withColumnRenamed("ticket_count", "tickets")


@query("e04_left_to_aggregate", with_ctes("""
SELECT o.order_id, COALESCE(i.units, 0) AS units FROM ops_orders AS o LEFT JOIN (
    SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS units FROM ops_order_items GROUP BY 1) AS i ON i.order_id = o.order_id"""))
def left_to_aggregate(ops):
    """Left join to a side reduced to one row per key."""
    units = ops["order_lines"].groupBy("order_id").agg(F.sum("quantity").alias("units"))
    return ops["order_headers"].select("order_id").join(units, "order_id", "left").select(
        "order_id", F.coalesce("units", F.lit(0)).alias("units"))


@query("e05_checked_join", with_ctes("""
SELECT o.order_id, w.region FROM ops_orders AS o LEFT JOIN ops_warehouses AS w ON w.warehouse_id = o.warehouse_id"""))
def checked_join(ops):
    """Left join after checking that the right side has one row per key."""
    return joins.join_checked(
        ops["orders"].select("order_id", "warehouse_id"), ops["warehouses"].select("warehouse_id", "region"),
        ["warehouse_id"], "left",
    ).select("order_id", "region")


@query("e06_semi_anti", with_ctes("""
SELECT customer_id, customer_id IN (SELECT customer_id FROM ops_support_tickets) AS has_ticket FROM ops_customers"""))
def semi_anti(ops):
    """Customers with and without tickets."""
    customers, tickets = ops["customers"].select("customer_id"), ops["support_tickets"].select("customer_id")
    yes = customers.join(tickets, "customer_id", "left_semi").withColumn("has_ticket", F.lit(True))
    return yes.union(customers.join(tickets, "customer_id", "left_anti").withColumn("has_ticket", F.lit(False)))


@query("e06_bitmap_membership", """
SELECT event_type, COUNT(*) AS events, COUNT(*) FILTER (WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS of_members
FROM events GROUP BY 1""")
def bitmap_membership(ops):
    """Events of customers with a positive balance, whose keys travel as bitmaps."""
    keys = ops.source("customer").filter("c_acctbal > 0").select("c_custkey")
    marked = keysets.with_membership(ops.source("events").select("event_type", "user_id"), "user_id", keys, "c_custkey", "member")
    return marked.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_if("member").alias("of_members"))


@query("e07_key_lookup", with_ctes(rounded("""
SELECT delivery_id, rate AS supplier_late_rate FROM ops_deliveries AS d JOIN (
    SELECT supplier_id, AVG(CAST(supplier_late AS INT)) AS rate FROM ops_deliveries GROUP BY 1) AS r
    ON r.supplier_id = d.supplier_id""", ("supplier_late_rate",))))
def key_lookup(ops):
    """A per-key value attached to every row; its size is known before the join."""
    rates = staged(ops["deliveries"].groupBy("supplier_id").agg(
        mean_of("supplier_late").alias("supplier_late_rate")), "rates")
    return ops["deliveries"].select("delivery_id", "supplier_id").join(rates, "supplier_id", "left").select(
        "delivery_id", "supplier_late_rate")


@query("e08_scalar_subquery", with_ctes("""
SELECT order_id, (SELECT MAX(order_date) FROM ops_orders WHERE order_status = 'fulfilled') - order_date AS days_ago
FROM ops_orders"""))
def scalar_subquery(ops):
    """Age of every order against the latest fulfilled one."""
    latest = ops["order_headers"].filter(kpi.is_fulfilled()).agg(F.max("order_date")).scalar()
    return ops["order_headers"].select("order_id", F.datediff(latest, "order_date").alias("days_ago"))


@query("e09_two_period_union", with_ctes(f"""
SELECT COALESCE(a.warehouse_id, b.warehouse_id) AS warehouse_id, COALESCE(a.n, 0) AS orders_a, COALESCE(b.n, 0) AS orders_b
FROM (SELECT warehouse_id, COUNT(*) AS n FROM ops_orders WHERE strftime(order_date, '%Y-%m') = {decomposition.SQL_A} GROUP BY 1) AS a
FULL JOIN (SELECT warehouse_id, COUNT(*) AS n FROM ops_orders WHERE strftime(order_date, '%Y-%m') = {decomposition.SQL_B} GROUP BY 1) AS b
ON a.warehouse_id = b.warehouse_id"""))
def two_period_union(ops):
    """Keys of either period with the counts of both, without a join."""
    a, b = (in_month("order_date", p) for p in decomposition.periods(ops))
    return ops["orders"].filter(a | b).groupBy("warehouse_id").agg(
        F.count_if(a).alias("orders_a"), F.count_if(b).alias("orders_b"))


@query("e10_calendar_selection", with_ctes("""
SELECT month, order_count FROM kpi_monthly WHERE month IN (
    SELECT DISTINCT strftime(signup_date, '%Y-%m') FROM ops_customers WHERE customer_segment = 'BUILDING')"""))
def calendar_selection(ops):
    """Monthly rows limited to the months found in another table."""
    months = ops["customers"].filter("customer_segment = 'BUILDING'").select(month_key("signup_date").alias("month"))
    return kpi.monthly_kpis(ops).join(months.distinct(), "month", "left_semi").select("month", "order_count")


@query("e11_star_join", with_ctes(rounded("""
SELECT w.region, c.customer_segment, year(o.order_date) AS year, SUM(i.quantity * i.unit_price) AS value
FROM ops_order_items AS i JOIN ops_orders AS o ON o.order_id = i.order_id
JOIN ops_customers AS c ON c.customer_id = o.customer_id JOIN ops_warehouses AS w ON w.warehouse_id = o.warehouse_id
GROUP BY 1, 2, 3""", ("value",))))
def star_join(ops):
    """A fact seen through its date, customer and warehouse dimensions."""
    orders = ops["orders"].select("order_id", "customer_id", "warehouse_id", "order_date")
    customers = ops["customers"].select("customer_id", "customer_segment")
    return (
        orders.join(kpi.order_values(ops), "order_id").join(customers, "customer_id")
        .join(ops["warehouses"].select("warehouse_id", "region"), "warehouse_id")
        .groupBy("region", "customer_segment", F.year("order_date").alias("year"))
        .agg(F.sum("order_value").alias("value"))
    )


# Aggregates


@query("f01_counts", with_ctes("""
SELECT warehouse_id, order_status, COUNT(*) AS n_rows, COUNT(delivered_date) AS delivered FROM (
    SELECT o.warehouse_id, o.order_status, d.delivered_date FROM ops_orders AS o
    JOIN ops_deliveries AS d ON d.order_id = o.order_id) AS j GROUP BY 1, 2"""))
def counts(ops):
    """Row count and null-skipping count."""
    return ops["deliveries"].withColumn(
        "order_status", F.when(F.col("delivery_status") == "delivered", "fulfilled").otherwise("unfulfilled")
    ).groupBy("warehouse_id", "order_status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("delivered_date").alias("delivered"))


@query("f02_conditional_sum", with_ctes("""
SELECT warehouse_id, CAST(SUM(CASE WHEN order_status = 'fulfilled' THEN 1 ELSE 0 END) AS BIGINT) AS fulfilled
FROM ops_orders GROUP BY 1"""))
def conditional_sum(ops):
    """Conditional count per key."""
    return ops["orders"].groupBy("warehouse_id").agg(F.count_if(kpi.is_fulfilled()).alias("fulfilled"))


@query("f03_basic_aggregates", with_ctes(rounded("""
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total, AVG(quantity) AS mean, MIN(quantity) AS least,
       MAX(quantity) AS most FROM ops_order_items GROUP BY 1""", ("mean",))))
def basic_aggregates(ops):
    """Sum, mean, least and most."""
    return ops["order_lines"].groupBy("product_id").agg(
        F.sum("quantity").alias("total"), F.avg("quantity").alias("mean"), F.min("quantity").alias("least"),
        F.max("quantity").alias("most"))


@query("f04_count_distinct", with_ctes("""
SELECT supplier_id, COUNT(DISTINCT order_id) AS orders FROM ops_deliveries GROUP BY 1"""))
def count_distinct(ops):
    """Exact distinct count."""
    return ops["supplier_marks"].groupBy("supplier_id").agg(F.count_distinct("order_id").alias("orders"))


@query("f05_distinct", with_ctes("SELECT DISTINCT customer_id, strftime(order_date, '%Y-%m') AS month FROM ops_orders"))
def distinct(ops):
    """Distinct customer and month."""
    return ops["order_headers"].select("customer_id", month_key("order_date").alias("month")).distinct()


@query("f06_global_aggregate", with_ctes(rounded("""
SELECT MAX(order_date) AS latest, COUNT(*) AS orders, AVG(CASE WHEN order_status = 'fulfilled' THEN 1 ELSE 0 END) AS rate
FROM ops_orders""", ("rate",))))
def global_aggregate(ops):
    """Aggregates without a key."""
    return ops["order_headers"].agg(
        F.max("order_date").alias("latest"), F.count(F.lit(1)).alias("orders"),
        mean_of(kpi.is_fulfilled()).alias("rate"))


@query("f07_mean_of_flag", with_ctes(rounded(
    "SELECT supplier_id, AVG(CAST(supplier_late AS INT)) AS late_rate FROM ops_deliveries GROUP BY 1", ("late_rate",))))
def mean_of_flag(ops):
    """Mean of a boolean per key."""
    return ops["supplier_marks"].groupBy("supplier_id").agg(mean_of("supplier_late").alias("late_rate"))


@query("f08_two_level", with_ctes(rounded("""
SELECT warehouse_id, AVG(rate) AS mean_of_months FROM (
    SELECT warehouse_id, strftime(order_date, '%Y-%m') AS m,
           AVG(CASE WHEN order_status = 'fulfilled' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS rate
    FROM ops_orders GROUP BY 1, 2) AS r GROUP BY 1""", ("mean_of_months",))))
def two_level(ops):
    """Mean of monthly rates."""
    monthly = ops["orders"].groupBy("warehouse_id", month_key("order_date").alias("m")).agg(
        mean_of(kpi.is_fulfilled()).alias("rate"))
    return monthly.groupBy("warehouse_id").agg(F.avg("rate").alias("mean_of_months"))


@query("f09_quantile", rounded("""
SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS q2, quantile_cont(l_quantity, 0.75) AS q3
FROM lineitem""", ("q1", "q2", "q3")))
def quantile(ops):
    """Exact interpolated quantiles of a value with few distinct levels."""
    return ops.source("lineitem").agg(*[
        F.percentile("l_quantity", F.lit(p)).alias(n) for n, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])


@query("f09_grouped_quantiles", rounded("""
SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.05) AS q05, quantile_cont(l_extendedprice, 0.5) AS q50,
       quantile_cont(l_extendedprice, 0.99) AS q99 FROM lineitem GROUP BY 1, 2""", ("q05", "q50", "q99")))
def grouped_quantiles(ops):
    """Exact interpolated quantiles per group of a value with about as many levels as rows."""
    return ordering.grouped_quantiles(ops.source("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
                                      {"q05": 0.05, "q50": 0.5, "q99": 0.99})


@query("f10_population_moments", rounded("""
SELECT l_returnflag, AVG(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sd FROM lineitem GROUP BY 1""",
    ("mean", "sd")))
def population_moments(ops):
    """Mean and population deviation."""
    return ops.source("lineitem").groupBy("l_returnflag").agg(
        F.avg("l_extendedprice").alias("mean"), F.stddev_pop("l_extendedprice").alias("sd"))


@query("f11_mode_per_key", with_ctes("""
SELECT order_id, sku_group FROM (
    SELECT order_id, sku_group, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY COUNT(*) DESC, sku_group) AS rn
    FROM ops_order_items AS i JOIN ops_products AS p ON p.product_id = i.product_id GROUP BY 1, 2) AS n WHERE rn = 1"""))
def mode_per_key(ops):
    """Most frequent SKU group of each order, ties by name."""
    lines = ops["order_lines"].select("order_id", "product_id").join(
        ops["products"].select("product_id", "sku_group"), "product_id")
    return joins.mode_per_key(lines, ["order_id"], "sku_group")


@query("f12_first_per_key", with_ctes("""
SELECT order_id, supplier_id, shipped_date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY shipped_date NULLS LAST, delivery_id) AS rn
    FROM ops_deliveries) AS d WHERE rn = 1"""))
def first_per_key(ops):
    """First delivery of each order."""
    return kpi.first_deliveries(ops["deliveries"]).select("order_id", "supplier_id", "shipped_date")


@query("f13_least_key", with_ctes("SELECT order_id, MIN(supplier_id) AS supplier_id FROM ops_deliveries GROUP BY 1"))
def least_key(ops):
    """Least supplier of each order."""
    return ops["supplier_marks"].groupBy("order_id").agg(F.min("supplier_id").alias("supplier_id"))


@query("f14_contingency", with_ctes("SELECT * FROM chi_cells"))
def contingency_table(ops):
    """Supplier against late delivery, in long form."""
    return contingency(ops["supplier_marks"], "supplier_id", "supplier_late")


@query("f15_rows_per_key", with_ctes("SELECT customer_id, COUNT(*) AS size FROM ops_support_tickets GROUP BY 1"))
def rows_per_key(ops):
    """Rows per key."""
    return ops["support_tickets"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("size"))


@query("f16_rollup", with_ctes("""
SELECT issue_type, priority, COUNT(*) AS tickets FROM ops_support_tickets GROUP BY ROLLUP (issue_type, priority)"""))
def rollup(ops):
    """Counts with subtotals and the grand total in one pass."""
    return ops["support_tickets"].rollup("issue_type", "priority").agg(F.count(F.lit(1)).alias("tickets"))


@query("f17_share_of_total", with_ctes(rounded("""
SELECT month, sku_group, CAST(stockout_snapshots AS DOUBLE)
    / NULLIF(SUM(stockout_snapshots) OVER (PARTITION BY month), 0) AS share FROM kpi_stockout""", ("share",))))
def share_of_total(ops):
    """Share of each group after removing the group filter."""
    return share_of(kpi.stockout_by_sku_group(ops), "stockout_snapshots", ["month"], "share").select(
        "month", "sku_group", "share")


@query("f18_ratio_of_sums", with_ctes(rounded("""
SELECT substr(month, 1, 4) AS year, CAST(SUM(on_time_deliveries) AS DOUBLE) / NULLIF(SUM(delivery_count), 0) AS rate
FROM kpi_monthly GROUP BY 1""", ("rate",))))
def ratio_of_sums(ops):
    """Ratio of sums under a grouping."""
    return kpi.monthly_kpis(ops).groupBy(F.substring("month", 1, 4).alias("year")).agg(
        safe_ratio(F.sum("on_time_deliveries"), F.sum("delivery_count")).alias("rate"))


# Windows and global order


@query("g01_lag", with_ctes("""
SELECT month, total_orders - LAG(total_orders) OVER (ORDER BY month) AS change FROM kpi_monthly_fulfilment"""))
def lag(ops):
    """Change against the previous observed month."""
    monthly = ops["order_headers"].groupBy(month_key("order_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return monthly.select("month", (F.col("n") - F.lag("n").over(Window.orderBy("month"))).alias("change"))


@query("g02_g03_ranks", with_ctes("""
SELECT warehouse_id, orders, RANK() OVER (ORDER BY orders % 7 DESC) AS rank_desc,
       DENSE_RANK() OVER (ORDER BY orders % 7 DESC) AS dense_rank_desc
FROM (SELECT warehouse_id, COUNT(*) AS orders FROM ops_orders GROUP BY 1) AS w"""))
def ranks(ops):
    """Ranks with ties over aggregated rows."""
    per = ops["orders"].groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("orders"))
    order = Window.orderBy(F.desc(F.col("orders") % 7))
    return per.withColumn("rank_desc", F.rank().over(order)).withColumn("dense_rank_desc", F.dense_rank().over(order))


@query("g04_mean_over_all", with_ctes(rounded("""
SELECT supplier_id, n, AVG(n) OVER () AS mean FROM (
    SELECT supplier_id, COUNT(*) AS n FROM ops_deliveries GROUP BY 1) AS s""", ("mean",))))
def mean_over_all(ops):
    """Group value beside the mean of all groups."""
    per = ops["supplier_marks"].groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("mean", per.agg(F.avg("n")).scalar())


@query("g05_ntile", with_ctes("""
SELECT o_orderkey, NTILE(7) OVER (ORDER BY o_totalprice, o_orderkey) AS price_tile,
       NTILE(7) OVER (ORDER BY -CAST(strftime(o_orderdate, '%Y%m') AS INT), o_orderkey) AS month_tile FROM orders"""))
def ntile(ops):
    """Global tiles of all orders by two orders at once."""
    rows = ops.source("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tiled = ordering.ntile_scaled(rows, "o_orderkey", 7, {
        "price_tile": F.col("o_totalprice"),
        "month_tile": -F.date_format("o_orderdate", "yyyyMM").cast("int"),
    })
    return tiled.select("o_orderkey", "price_tile", "month_tile")


@query("g06_latest_per_group", with_ctes("""
SELECT product_id, warehouse_id, snapshot_id FROM kpi_inventory_status"""))
def latest_per_group(ops):
    """Latest snapshot per product and warehouse."""
    return kpi.latest_snapshots(ops).select("product_id", "warehouse_id", "snapshot_id")


@query("g07_percentile_rank", rounded("""
SELECT o_orderkey, (RANK() OVER (ORDER BY o_totalprice) + (COUNT(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0::DOUBLE)
    / COUNT(*) OVER () AS percentile FROM orders""", ("percentile",)))
def percentile_rank(ops):
    """Average-tie percentile of a continuous value, from range-partitioned ranks."""
    orders = ops.source("orders").select("o_orderkey", "o_totalprice")
    total = orders.agg(F.count("o_totalprice")).scalar()
    ranks = ordering.hist_rank(orders, "o_totalprice", {})
    return orders.join(ranks, "o_totalprice").select("o_orderkey", (F.col("avg_rank") / total).alias("percentile"))


@query("g08_duplicate_flags", with_ctes("""
SELECT source_row, COUNT(*) OVER (PARTITION BY order_id) > 1 AS repeated,
       ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY source_row) > 1 AS after_first FROM raw_orders"""))
def duplicate_flags(ops):
    """Rows that share a key, and those after the first."""
    rows = RawTables(ops)["orders"].select("source_row", "order_id")
    firsts = rows.groupBy("order_id").agg(
        F.min("source_row").alias("first_row"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(firsts, "order_id", "left").select(
        "source_row", F.col("n").isNotNull().alias("repeated"),
        F.coalesce(F.col("source_row") > F.col("first_row"), F.lit(False)).alias("after_first"))


@query("g09_factor_ranks", with_ctes("SELECT dimension, segment, dimension_rank, overall_rank FROM factors"))
def factor_ranks(ops):
    """Rank inside the dimension and over all factors."""
    return decomposition.factors(ops).select("dimension", "segment", "dimension_rank", "overall_rank")


# Sorting and set operations


@query("h01_sort_with_nulls", with_ctes("""
SELECT delivery_id, delivered_date, ROW_NUMBER() OVER (ORDER BY delivered_date DESC NULLS LAST, delivery_id) AS place
FROM ops_deliveries"""))
def sort_with_nulls(ops):
    """Global position in an order that puts nulls last."""
    placed = ordering.dense_index(
        staged(ops["deliveries"].select("delivery_id", "delivered_date"), "unsorted"),
        [F.col("delivered_date").desc_nulls_last(), F.col("delivery_id").asc()], "at")
    return placed.select("delivery_id", "delivered_date", (F.col("at") + 1).alias("place"))


@query("h02_sorted_first", with_ctes("""
SELECT customer_id, order_id FROM (
    SELECT customer_id, order_id, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id) AS rn
    FROM ops_orders) AS o WHERE rn = 1"""))
def sorted_first(ops):
    """Latest order of each customer."""
    return joins.first_per_key(
        ops["order_headers"], ["customer_id"], [-F.unix_date("order_date"), F.col("order_id")], ["order_id"])


@query("h03_top_per_dimension", with_ctes("SELECT dimension, segment, dimension_rank FROM factors WHERE dimension_rank <= 3"))
def top_per_dimension(ops):
    """Three factors per dimension."""
    return decompose.top_factors(decomposition.factors(ops)).select("dimension", "segment", "dimension_rank")


@query("h04_arg_max", with_ctes("""
SELECT month, sku_group FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY stockout_rate DESC, sku_group) AS rn
    FROM kpi_stockout) AS s WHERE rn = 1"""))
def arg_max(ops):
    """Group with the highest rate of each month."""
    return kpi.stockout_by_sku_group(ops).groupBy("month").agg(
        F.min_by("sku_group", F.struct(-F.col("stockout_rate"), F.col("sku_group"))).alias("sku_group"))


@query("h05_latest_months", with_ctes(
    "SELECT DISTINCT strftime(order_date, '%Y-%m') AS month FROM ops_orders ORDER BY 1 DESC LIMIT 2"))
def latest_months(ops):
    """The two latest months."""
    return ops["order_headers"].select(month_key("order_date").alias("month")).distinct().orderBy(F.desc("month")).limit(2)


@query("h06_best_segment", with_ctes("""
SELECT customer_segment FROM ops_orders AS o JOIN ops_customers AS c ON c.customer_id = o.customer_id
GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1"""))
def best_segment(ops):
    """Label with the highest score, first on ties."""
    return ops["order_headers"].join(ops["customers"].select("customer_id", "customer_segment"), "customer_id").groupBy(
        "customer_segment").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "customer_segment").limit(1).select("customer_segment")


@query("i01_union_by_name", with_ctes("""
SELECT 'order' AS kind, order_id AS id, order_date AS day, CAST(NULL AS VARCHAR) AS priority FROM ops_orders
UNION ALL SELECT 'ticket', ticket_id, ticket_date, priority FROM ops_support_tickets"""))
def union_by_name(ops):
    """Union of two relations aligned by name, missing columns null."""
    orders = ops["order_headers"].select(
        F.lit("order").alias("kind"), F.col("order_id").alias("id"), F.col("order_date").alias("day"))
    tickets = ops["support_tickets"].select(
        "priority", F.col("ticket_date").alias("day"), F.col("ticket_id").alias("id"), F.lit("ticket").alias("kind"))
    return orders.unionByName(tickets, allowMissingColumns=True)


@query("i02_set_difference", with_ctes("""
SELECT order_id FROM ops_orders EXCEPT SELECT order_id FROM ops_order_items"""))
def set_difference(ops):
    """Orders without items."""
    return ops["order_headers"].select("order_id").join(ops["order_lines"], "order_id", "left_anti").distinct()


@query("i03_token_difference", """
SELECT event_id, array_to_string(list_sort(list_filter(list_distinct(list_transform(
    regexp_extract_all(props, '[0-9]+'), lambda t: t)), lambda t: t <> CAST(user_id AS VARCHAR))), ' ') AS extra FROM events""")
def token_difference(ops):
    """Numbers of a text that another text lacks."""
    extra = F.array_except(number_tokens("props"), number_tokens(F.col("user_id").cast("string")))
    return ops.source("events").select("event_id", F.array_join(F.array_sort(extra), " ").alias("extra"))


@query("i04_union_distinct", with_ctes("""
SELECT customer_id FROM ops_orders UNION SELECT customer_id FROM ops_support_tickets"""))
def union_distinct(ops):
    """Customers seen in either table."""
    return ops["order_headers"].select("customer_id").union(ops["support_tickets"].select("customer_id")).distinct()


@query("a17_calendar", with_ctes("""
SELECT CAST(d AS DATE) AS "date", year(d) AS year, month(d) AS month, week(d) AS week, isodow(d) AS weekday,
       isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS d FROM ops_orders) AS s"""))
def calendar_table(ops):
    """Calendar that covers all order dates."""
    return calendar_of(ops["order_headers"], "order_date")


@query("a16_result_sample", with_ctes(rounded("""
SELECT customer_id, monetary FROM rfm_base ORDER BY monetary DESC, customer_id LIMIT 5""", ("monetary",))))
def result_sample(ops):
    """The first rows of a sorted result."""
    return sinks.result_sample(segments.customer_rfm(ops).select("customer_id", "monetary").orderBy(
        F.desc("monetary"), "customer_id"), 5)
