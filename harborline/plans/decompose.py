"""Decomposition of a rate change into segment contributions.

A segment contributes its share of all orders times its rate, in the later period
minus in the earlier one; within one dimension the contributions add up to the
change. All dimensions are counted in one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import month_key, safe_ratio, two_proportion_p
from harborline.functions.dates import in_month, month_bounds
from harborline.operators.joins import fact_join, mode_per_key, repeated_keys, with_scalar
from harborline.operators.ordering import dense_index
from harborline.operators.storage import staged
from harborline.plans.kpi import is_fulfilled, order_lines, supplier_marks

Tables = Mapping[str, DataFrame]

DIMENSIONS = ("warehouse", "supplier", "sku_group", "region")
TOP_PER_DIMENSION = 3
# Names of the published factor columns.
FACTOR_COLUMNS = (
    "dimension", "segment", "rate_a", "rate_b", "orders_a", "orders_b", "contribution",
    "contribution_pp", "share_of_drop", "rate_vs_overall", "share_of_unfulfilled",
    "share_of_delayed", "p_value", "dimension_rank", "overall_rank",
)


def order_facts(ops: Tables, when: Column | None = None) -> DataFrame:
    """One row per order with exclusive warehouse, supplier, SKU group and region.

    The supplier is the least one among the deliveries; the SKU group the most
    frequent one among the lines, ties to the least. ``when`` limits the orders before
    anything is joined.
    """
    orders, deliveries = ops["orders"], supplier_marks(ops).select("order_id", "supplier_id")
    lines = order_lines(ops).select("order_id", "product_id")
    if when is not None:
        orders = orders.filter(when)
        chosen = ops["order_headers"].filter(when).select("order_id")
        deliveries = deliveries.join(chosen, "order_id", "left_semi")
        lines = lines.join(chosen, "order_id", "left_semi")
    supplier = deliveries.groupBy("order_id").agg(F.min("supplier_id").alias("supplier_id"))
    lines = lines.join(ops["products"].select("product_id", "sku_group"), "product_id", "left")
    group = mode_per_key(lines, ["order_id"], "sku_group")
    regions = ops["warehouses"].groupBy("warehouse_id").agg(F.min("region").alias("region"))
    return (
        fact_join(fact_join(orders, supplier, "order_id", "left"), group, "order_id", "left")
        .join(regions, "warehouse_id", "left")
        .select(
            "order_id", "order_date", is_fulfilled().alias("fulfilled"), "warehouse_id",
            F.col("warehouse_id").cast("string").alias("warehouse"),
            F.coalesce(F.col("supplier_id").cast("string"), F.lit("Unknown supplier")).alias("supplier"),
            F.coalesce("sku_group", F.lit("Unknown")).alias("sku_group"),
            F.coalesce("region", F.lit("Unknown")).alias("region"),
        )
    )


def latest_two_months(orders: DataFrame) -> DataFrame:
    """The two latest observed months, as one row ``period_a``, ``period_b``."""
    # One row per observed month is left before the sort.
    months = orders.select(month_key("order_date").alias("m")).distinct().orderBy(F.desc("m")).limit(2)
    return months.agg(F.min("m").alias("period_a"), F.max("m").alias("period_b"), F.count("m").alias("n")).filter(
        "n = 2"
    ).drop("n")


def check_periods(period_a: str, period_b: str) -> None:
    month_bounds(period_a), month_bounds(period_b)
    if period_a == period_b:
        raise ValueError("the two periods must be different months")


def overall_rates(facts: DataFrame, a: Column, b: Column, flag: str = "fulfilled") -> DataFrame:
    """Totals, rates and change of both periods as one row."""
    hit = F.col(flag)
    row = facts.agg(
        F.count_if(a).alias("total_a"), F.count_if(b).alias("total_b"),
        F.count_if(a & hit).alias("hits_a"), F.count_if(b & hit).alias("hits_b"),
    )
    return row.withColumn("value_a", safe_ratio("hits_a", "total_a")).withColumn(
        "value_b", safe_ratio("hits_b", "total_b")
    ).withColumn("change", F.col("value_b") - F.col("value_a"))


def region_is_warehouse(facts: DataFrame) -> DataFrame:
    """One row telling whether region merely renames warehouse."""
    pairs = facts.select("warehouse_id", "region").distinct()
    n = F.count(F.lit(1))
    return pairs.agg(
        ((n > 0) & (F.count_distinct("warehouse_id") == n) & (F.count_distinct("region") == n))
        .alias("one_to_one")
    )


def decompose(facts: DataFrame, period_a: Column, period_b: Column, dimensions: Sequence[str] = DIMENSIONS,
              flag: str = "fulfilled", drop_region: DataFrame | None = None) -> DataFrame:
    """All factors of the change of a boolean rate between two sets of rows.

    ``facts`` is read twice and should be stored. Result has one row per dimension and
    segment seen in either period. ``drop_region`` is a one-row frame with a
    ``one_to_one`` mark that removes the region dimension.
    """
    hit = F.col(flag)
    within = facts.filter(period_a | period_b).withColumn("_a", period_a).withColumn("_b", period_b)
    entries = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment")) for d in dimensions
    ])
    counts = within.select("_a", "_b", hit.alias("_hit"), F.inline(entries)).groupBy("dimension", "segment").agg(
        F.count_if("_a").alias("orders_a"), F.count_if("_b").alias("orders_b"),
        F.count_if(F.col("_a") & F.col("_hit")).alias("hits_a"),
        F.count_if(F.col("_b") & F.col("_hit")).alias("hits_b"),
    )
    rows = with_scalar(counts, overall_rates(facts.filter(period_a | period_b), period_a, period_b, flag), "o")
    if drop_region is not None:
        rows = with_scalar(rows, drop_region, "r").filter("NOT (dimension = 'region' AND r.one_to_one)").drop("r")
    rate_a = F.coalesce(safe_ratio("hits_a", "orders_a"), F.lit(0.0))
    rate_b = F.coalesce(safe_ratio("hits_b", "orders_b"), F.lit(0.0))
    contribution = (
        F.col("orders_b") / F.col("o.total_b") * F.col("rate_b")
        - F.col("orders_a") / F.col("o.total_a") * F.col("rate_a")
    )
    change = F.col("o.change")
    missed = F.col("o.total_b") - F.col("o.hits_b")
    share = F.coalesce(safe_ratio(F.col("orders_b") - F.col("hits_b"), missed), F.lit(0.0))
    rows = (
        rows.withColumn("rate_a", rate_a).withColumn("rate_b", rate_b)
        .withColumn("contribution", contribution)
        .withColumn("contribution_pp", F.col("contribution") * 100)
        .withColumn("share_of_drop", F.when(change != 0, F.col("contribution") / change * 100).otherwise(0.0))
        .withColumn("rate_vs_overall", F.col("rate_b") - F.col("o.value_b"))
        .withColumn("share_of_unfulfilled", share)
        .withColumn("share_of_delayed", share)
        .withColumn("p_value", two_proportion_p("hits_a", "orders_a", "hits_b", "orders_b"))
    )
    return ranked(rows).select(*FACTOR_COLUMNS)


def ranked(rows: DataFrame) -> DataFrame:
    """Rank inside the dimension and over all factors, most adverse first.

    Contributions are compared after rounding to twelve decimals, so that equal ones
    tie in spite of floating-point noise. Overall, factors of different dimensions
    compete although their contributions must not be added. Both ranks are positions in
    a range-partitioned order, for any number of factors.
    """
    rows = staged(rows.withColumn("_worst", F.round("contribution", 12)), "factors")
    placed = dense_index(rows, ["dimension", "_worst", "segment"], "_at")
    # One row per dimension.
    starts = placed.groupBy("dimension").agg(F.min("_at").alias("_start"))
    inside = placed.join(F.broadcast(starts), "dimension").withColumn(
        "dimension_rank", F.col("_at") - F.col("_start") + 1
    ).drop("_at", "_start")
    return dense_index(staged(inside, "ranked"), ["_worst", "dimension", "segment"], "_at").withColumn(
        "overall_rank", F.col("_at") + 1
    )


def decompose_months(ops: Tables, period_a: str, period_b: str) -> DataFrame:
    """Factors of the fulfilment change between two months."""
    check_periods(period_a, period_b)
    a, b = in_month("order_date", period_a), in_month("order_date", period_b)
    facts = staged(order_facts(ops, a | b), "facts")
    for month, rows in zip((period_a, period_b), facts.agg(F.count_if(a), F.count_if(b)).first()):
        if not rows:
            raise ValueError(f"no orders in {month}")
    if not repeated_keys(facts, ["order_id"]).isEmpty():
        raise ValueError("orders repeat an order_id")
    # Whether region renames warehouse is a property of all orders.
    places = ops["orders"].select("warehouse_id").distinct().join(
        ops["warehouses"].select("warehouse_id", F.coalesce("region", F.lit("Unknown")).alias("region")),
        "warehouse_id", "left",
    )
    return decompose(facts, a, b, drop_region=region_is_warehouse(places))


def top_factors(factors: DataFrame, top: int = TOP_PER_DIMENSION) -> DataFrame:
    """The most adverse factors of each dimension."""
    return factors.filter(F.col("dimension_rank") <= top).orderBy("overall_rank")


def additivity(factors: DataFrame) -> DataFrame:
    """Sum of contributions and shares per dimension."""
    return factors.groupBy("dimension").agg(
        F.sum("contribution").alias("contribution"), F.sum("share_of_drop").alias("share_of_drop")
    )


def report(factors: DataFrame, overall: DataFrame, period_a: str, period_b: str) -> DataFrame:
    """Nested report: one row with the header and the array of top factors."""
    picked = top_factors(factors).agg(
        F.sort_array(F.collect_list(F.struct("overall_rank", *[c for c in FACTOR_COLUMNS if c != "overall_rank"])))
        .alias("top_factors")
    )
    return overall.select(
        F.lit("fulfilment").alias("kpi"), F.lit(period_a).alias("period_a"), F.lit(period_b).alias("period_b"),
        "value_a", "value_b", "change", picked.scalar().alias("top_factors"),
    )


def flat_report(top: DataFrame, overall: DataFrame, period_a: str, period_b: str) -> DataFrame:
    """One row per top factor with the header of the report repeated."""
    header = overall.select("value_a", "value_b", "change")
    factor = [c for c in FACTOR_COLUMNS if c not in ("contribution", "share_of_delayed")]
    return with_scalar(top, header, "h").select(
        F.lit("fulfilment").alias("kpi"), F.lit(period_a).alias("period_a"), F.lit(period_b).alias("period_b"),
        "h.value_a", "h.value_b", "h.change", *factor,
    )
