"""Scalar functions and predicates, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline import functions as fn
from harborline.catalog.analytics import erfc_sql
from harborline.catalog.ctes import with_ctes
from harborline.catalog.evidence import percent_sql, signed_sql, tokens_sql
from harborline.catalog.registry import query, rounded
from harborline.functions.dates import in_month
from harborline.plans import kpi


@query("d01_month_key", with_ctes("SELECT order_id, strftime(order_date, '%Y-%m') AS month FROM ops_orders"))
def month_key(ops):
    """Month of every order."""
    return ops["order_headers"].select("order_id", fn.month_key("order_date").alias("month"))


@query("d02_days_between", with_ctes(rounded("""
SELECT delivery_id, CAST(delivered_date - promised_delivery_date AS DOUBLE) AS days_late FROM ops_deliveries""",
    ("days_late",))))
def days_between(ops):
    """Days from promise to delivery, null while open."""
    return ops["deliveries"].select(
        "delivery_id", fn.days_between("delivered_date", "promised_delivery_date").alias("days_late"))


@query("d03_conditional_flag", with_ctes("""
SELECT supplier_id, COUNT(*) AS deliveries, CAST(SUM(CASE WHEN delivered_date IS NULL
    OR delivered_date > promised_delivery_date THEN 1 ELSE 0 END) AS BIGINT) AS breached FROM ops_deliveries GROUP BY 1"""))
def conditional_flag(ops):
    """Breaches as a 0/1 sum."""
    return ops["deliveries"].groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum(F.when(kpi.breached(), 1).otherwise(0)).alias("breached"))


@query("d04_status_label", with_ctes("""
SELECT warehouse_id, CASE WHEN stockout_flag OR quantity_on_hand = 0 THEN 'stockout'
    WHEN quantity_on_hand <= reorder_point THEN 'reorder' ELSE 'healthy' END AS status, COUNT(*) AS snapshots
FROM ops_inventory_snapshots GROUP BY 1, 2"""))
def status_label(ops):
    """Snapshots per warehouse and stock status."""
    return ops["inventory_snapshots"].groupBy("warehouse_id", kpi.stock_status().alias("status")).agg(
        F.count(F.lit(1)).alias("snapshots"))


@query("d05_safe_ratio", rounded("""
SELECT l_linenumber, COUNT(*) AS lines, COUNT(l_tax / NULLIF(l_discount, 0)) AS defined,
       AVG(l_tax / NULLIF(l_discount, 0)) AS mean_ratio FROM lineitem GROUP BY 1""", ("mean_ratio",)))
def safe_ratio(ops):
    """A ratio that is null for a zero denominator."""
    ratio = fn.safe_ratio("l_tax", "l_discount")
    return ops.source("lineitem").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("lines"), F.count(ratio).alias("defined"), F.avg(ratio).alias("mean_ratio"))


@query("d06_coalesce_default", with_ctes("""
SELECT customer_id, COALESCE(CAST(signup_date AS VARCHAR), 'never') AS signup FROM ops_customers"""))
def coalesce_default(ops):
    """Default for customers that never ordered."""
    return ops["customers"].select(
        "customer_id", F.coalesce(F.col("signup_date").cast("string"), F.lit("never")).alias("signup"))


@query("d07_three_valued_predicate", with_ctes("""
SELECT delivery_status, COUNT(*) FILTER (WHERE delivered_date > promised_delivery_date) AS late,
       COUNT(*) FILTER (WHERE NOT (delivered_date > promised_delivery_date)) AS punctual,
       COUNT(*) FILTER (WHERE (delivered_date > promised_delivery_date) IS NULL) AS unknown,
       COUNT(*) FILTER (WHERE delivered_date IS NULL OR delivered_date > promised_delivery_date) AS breached
FROM ops_deliveries GROUP BY 1"""))
def three_valued_predicate(ops):
    """A comparison with a nullable date is true, false or unknown."""
    late = F.col("delivered_date") > F.col("promised_delivery_date")
    return ops["deliveries"].groupBy("delivery_status").agg(
        F.count_if(late).alias("late"), F.count_if(~late).alias("punctual"),
        F.count_if(late.isNull()).alias("unknown"), F.count_if(kpi.breached()).alias("breached"))


@query("d08_boolean_predicate", with_ctes(
    "SELECT warehouse_id, COUNT(*) AS late FROM ops_deliveries WHERE supplier_late GROUP BY 1"))
def boolean_predicate(ops):
    """A boolean column as the condition."""
    return ops["deliveries"].filter("supplier_late").groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("late"))


@query("d09_set_filters", with_ctes("""
SELECT issue_type, priority, COUNT(*) AS tickets FROM ops_support_tickets
WHERE priority IN ('high', 'medium') AND resolution_status <> 'open' GROUP BY 1, 2"""))
def set_filters(ops):
    """Equality, set and inequality filters."""
    return ops["support_tickets"].filter(
        F.col("priority").isin("high", "medium") & (F.col("resolution_status") != "open")
    ).groupBy("issue_type", "priority").agg(F.count(F.lit(1)).alias("tickets"))


@query("d10_date_ranges", with_ctes("""
SELECT COUNT(*) FILTER (WHERE order_date >= DATE '2000-02-01' AND order_date < DATE '2000-03-01') AS half_open,
       COUNT(*) FILTER (WHERE order_date BETWEEN DATE '2000-02-01' AND DATE '2000-03-01') AS closed FROM ops_orders
WHERE order_date BETWEEN DATE '2000-02-01' AND DATE '2000-03-01'"""))
def date_ranges(ops):
    """Half-open and closed date ranges; the outer one is pushed to the scan."""
    return ops["order_headers"].filter("order_date BETWEEN DATE'2000-02-01' AND DATE'2000-03-01'").agg(
        F.count_if(in_month("order_date", "2000-02")).alias("half_open"), F.count(F.lit(1)).alias("closed"))


@query("d11_months_apart", with_ctes("""
SELECT o.order_id, (year(o.order_date) - year(c.signup_date)) * 12 + month(o.order_date) - month(c.signup_date)
    AS months_since_signup FROM ops_orders AS o JOIN ops_customers AS c ON c.customer_id = o.customer_id"""))
def months_apart(ops):
    """Months from signup to order, from month keys."""
    signup = ops["customers"].select("customer_id", fn.month_key("signup_date").alias("signup"))
    return ops["order_headers"].join(signup, "customer_id").select(
        "order_id", fn.months_apart(fn.month_key("order_date"), F.col("signup")).alias("months_since_signup"))


@query("d12_typed_null", with_ctes("SELECT ticket_id, CAST(NULL AS DOUBLE) AS resolution_days FROM ops_support_tickets"))
def typed_null(ops):
    """A column that is always null but has a type."""
    return ops["support_tickets"].select("ticket_id", F.lit(None).cast("double").alias("resolution_days"))


@query("d13_decimal_product", with_ctes(rounded(
    "SELECT product_id, SUM(quantity * unit_price) AS value FROM ops_order_items GROUP BY 1", ("value",))))
def decimal_product(ops):
    """Exact product of quantity and price."""
    return ops["order_items"].groupBy("product_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("value"))


TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({0}), '\\p{{L}}+|[^\\p{{L}}]+'), "
         "lambda w: upper(w[1:1]) || w[2:]), '')")


@query("d14_title_case", f"""
SELECT p_partkey, {TITLE.format("p_name || '-' || p_type || ' ' || p_brand")} AS titled FROM part""")
def title_case(ops):
    """Every run of letters starts upper case."""
    text = F.concat("p_name", F.lit("-"), "p_type", F.lit(" "), "p_brand")
    return ops.source("part").select("p_partkey", fn.title_case(text).alias("titled"))


@query("d14_title_case_documents", f"""
SELECT doc_id, md5(replace({TITLE.format('text')}, 'ẞ', 'Ss')) AS titled FROM documents""")
def title_case_documents(ops):
    """Title case of whole documents, compared by digest."""
    return ops.source("documents").select("doc_id", F.md5(fn.title_case("text")).alias("titled"))


@query("d15_weekday_month", with_ctes("""
SELECT isodow(order_date) AS weekday, month(order_date) AS month, COUNT(*) AS orders FROM ops_orders GROUP BY 1, 2"""))
def weekday_month(ops):
    """Orders per weekday (Monday 1) and month number."""
    return ops["order_headers"].groupBy(
        (F.weekday("order_date") + 1).alias("weekday"), F.month("order_date").alias("month")
    ).agg(F.count(F.lit(1)).alias("orders"))


@query("d16_clip", with_ctes(rounded("""
SELECT delivery_id, CASE WHEN delivered_date IS NOT NULL THEN
    LEAST(GREATEST(CAST(delivered_date - promised_delivery_date AS DOUBLE), -2), 3) END AS clipped FROM ops_deliveries""",
    ("clipped",))))
def clip(ops):
    """Days late limited to a range; unknown stays unknown."""
    late = fn.days_between("delivered_date", "promised_delivery_date")
    return ops["deliveries"].select("delivery_id", fn.clip(late, -2.0, 3.0).alias("clipped"))


@query("d17_abs_sqrt", rounded(
    "SELECT c_custkey, sqrt(abs(c_acctbal)) AS root FROM customer", ("root",)))
def abs_sqrt(ops):
    """Root of an absolute value."""
    return ops.source("customer").select("c_custkey", F.sqrt(F.abs("c_acctbal")).alias("root"))


@query("d18_normal_tail", rounded(f"""
SELECT l_quantity, COUNT(*) AS lines, {erfc_sql("abs((l_quantity - 25) / 12.0::DOUBLE) / sqrt(2.0::DOUBLE)")} AS p
FROM lineitem GROUP BY 1""", ("l_quantity", "p")))
def normal_tail(ops):
    """Two-sided normal probability of a standardised quantity."""
    z = (F.col("l_quantity") - 25) / F.lit(12.0)
    return ops.source("lineitem").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("lines")).withColumn(
        "p", fn.two_sided_normal_p(z))


@query("d19_number_text", f"""
SELECT l_discount, l_tax, {percent_sql("l_discount", 1)} AS share, {signed_sql("l_tax - l_discount", 2)} AS gap,
       COUNT(*) AS lines FROM lineitem GROUP BY 1, 2""")
def number_text(ops):
    """Percentages and signed numbers as text."""
    return ops.source("lineitem").groupBy("l_discount", "l_tax").agg(F.count(F.lit(1)).alias("lines")).select(
        "l_discount", "l_tax", fn.percent_text("l_discount", 1).alias("share"),
        fn.signed_text(F.col("l_tax") - F.col("l_discount"), 2).alias("gap"), "lines")


@query("d20_number_tokens", f"""
SELECT event_id, array_to_string(list_sort({tokens_sql("props || ' v' || CAST(user_id AS VARCHAR) || ' +1,250.50'")}), ' ')
    AS tokens FROM events""")
def number_tokens(ops):
    """Numbers in a text, without those glued to a letter."""
    text = F.concat("props", F.lit(" v"), F.col("user_id").cast("string"), F.lit(" +1,250.50"))
    return ops.source("events").select(
        "event_id", F.array_join(F.array_sort(fn.number_tokens(text)), " ").alias("tokens"))


@query("d21_text_lines", with_ctes("""
SELECT order_id, concat_ws(chr(10), 'Order ' || CAST(order_id AS VARCHAR), order_status, employee_id) AS lines
FROM ops_orders"""))
def text_lines(ops):
    """Lines joined into one text."""
    return ops["order_headers"].select("order_id", F.concat_ws(
        "\n", F.concat(F.lit("Order "), F.col("order_id").cast("string")), "order_status", "employee_id").alias("lines"))


@query("d23_reindexed_columns", with_ctes("""
SELECT 0 AS position, ticket_id AS id, issue_type AS kind, CAST(NULL AS VARCHAR) AS owner FROM ops_support_tickets"""))
def reindexed_columns(ops):
    """Columns picked, renamed, put in front, and added as null where missing."""
    picked = ops["support_tickets"].select(
        F.lit(0).alias("position"), F.col("ticket_id").alias("id"), F.col("issue_type").alias("kind"))
    wanted = ops.spark.createDataFrame([], "position int, id bigint, kind string, owner string")
    return wanted.unionByName(picked, allowMissingColumns=True)


@query("d24_finite_values", rounded("""
SELECT l_linenumber, COUNT(*) AS lines, COUNT(CASE WHEN l_discount <> 0 THEN l_tax / l_discount END) AS finite_values,
       MAX(CASE WHEN l_discount <> 0 THEN l_tax / l_discount END) AS largest FROM lineitem GROUP BY 1""", ("largest",)))
def finite_values(ops):
    """Infinite ratios become null."""
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.col("l_tax") / F.nullif("l_discount", F.lit(0.0)))
    value = fn.finite(ratio)
    return ops.source("lineitem").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("lines"), F.count(value).alias("finite_values"), F.max(value).alias("largest"))
