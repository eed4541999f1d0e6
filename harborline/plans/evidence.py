"""Evidence, alerts, narratives and audits of written answers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions import month_key, number_tokens, percent_text, safe_ratio, signed_text, strip
from harborline.functions.dates import in_month, month_bounds
from harborline.operators.joins import with_scalar
from harborline.operators.storage import staged
from harborline.plans.kpi import is_fulfilled, stockout_by_sku_group, supplier_performance

Tables = Mapping[str, DataFrame]

# Alert limits, all strict.
LOW_FULFILMENT = 0.90
SUPPLIER_GAP = 0.10
HIGH_STOCKOUT = 0.20

# Headings a written answer must have.
HEADINGS = ("Finding:", "Evidence:", "Recommendation:")


def most_adverse(factors: DataFrame) -> DataFrame:
    """The factor with the least contribution of each dimension."""
    kept = [c for c in factors.columns if c != "dimension"]
    pick = F.min_by(F.struct(*kept), F.struct("contribution_pp", "overall_rank")).alias("f")
    return factors.groupBy("dimension").agg(pick).select("dimension", "f.*")


def supplier_evidence(ops: Tables) -> DataFrame:
    """The supplier furthest above the mean late rate, or no row."""
    gap = F.round("difference_from_average", 12)
    return supplier_performance(ops).filter(gap > 0).orderBy(gap.desc(), "supplier_id").limit(1)


def stockouts_in(ops: Tables, period: str) -> DataFrame:
    """Stock-out counts per SKU group in one month; the month is a pushed date range."""
    inside = {**{k: ops[k] for k in ("products",)},
              "inventory_snapshots": ops["inventory_snapshots"].filter(in_month("snapshot_date", period))}
    return stockout_by_sku_group(inside)


def with_share(counts: DataFrame) -> DataFrame:
    """Share of each group in all stock-outs of its month; one row per month and group."""
    total = F.sum("stockout_snapshots").over(Window.partitionBy("month"))
    return counts.withColumn("all_stockout_snapshots", total).withColumn(
        "share_of_stockouts",
        F.coalesce(safe_ratio("stockout_snapshots", "all_stockout_snapshots"), F.lit(0.0)),
    )


def worst_groups(counts: DataFrame) -> DataFrame:
    """Per month the SKU group with the highest stock-out rate, ties by name."""
    shares = with_share(counts)
    kept = [c for c in shares.columns if c != "month"]
    pick = F.min_by(F.struct(*kept), F.struct(-F.col("stockout_rate"), F.col("sku_group"))).alias("g")
    return shares.groupBy("month").agg(pick).select("month", "g.*")


def stockout_evidence(ops: Tables, period: str) -> DataFrame:
    """The worst SKU group of one month with its share of all stock-outs; a month without snapshots is refused."""
    if ops["inventory_snapshots"].filter(in_month("snapshot_date", period)).isEmpty():
        raise ValueError(f"no snapshots in {period}")
    return worst_groups(stockouts_in(ops, period))


def fulfilment_alert(ops: Tables, period: str, limit: float = LOW_FULFILMENT) -> DataFrame:
    """One row if the month's fulfilment rate is below the limit."""
    rate = ops["order_headers"].filter(in_month("order_date", period)).agg(
        safe_ratio(F.count_if(is_fulfilled()), F.count(F.lit(1))).alias("value")
    )
    return rate.filter(F.col("value") < limit).select(
        F.lit("low_fulfilment").alias("alert_type"),
        F.lit(period).alias("period"),
        F.lit("all").alias("key"),
        "value",
        F.lit(limit).alias("threshold"),
        F.concat(F.lit(f"Fulfilment of {period} was "), percent_text("value", 1),
                 F.lit(f", under the limit of {limit:.0%}.")).alias("message"),
    )


def supplier_alerts(ops: Tables, limit: float = SUPPLIER_GAP) -> DataFrame:
    """Suppliers whose late rate exceeds the mean by more than the limit."""
    gap = F.col("difference_from_average")
    return supplier_performance(ops).filter(gap > limit).select(
        F.lit("supplier_late_rate").alias("alert_type"),
        F.lit(None).cast("string").alias("period"),
        F.col("supplier_id").cast("string").alias("key"),
        F.col("supplier_late_rate").alias("value"),
        F.lit(limit).alias("threshold"),
        "supplier_name",
        F.col("average_supplier_late_rate").alias("average"),
        gap.alias("gap"),
        F.concat(F.col("supplier_name"), F.lit(" delivered late in "), percent_text("supplier_late_rate", 1),
                 F.lit(" of cases, "), percent_text(gap, 1), F.lit(" over the mean of all suppliers."))
        .alias("message"),
    )


def stockout_alerts(ops: Tables, period: str, limit: float = HIGH_STOCKOUT) -> DataFrame:
    """SKU groups whose stock-out rate in the month exceeds the limit."""
    return stockouts_in(ops, period).filter(F.col("stockout_rate") > limit).select(
        F.lit("high_stockout_rate").alias("alert_type"),
        F.lit(period).alias("period"),
        F.col("sku_group").alias("key"),
        F.col("stockout_rate").alias("value"),
        F.lit(limit).alias("threshold"),
        "stockout_snapshots", "snapshot_count",
        F.concat(F.lit("SKU group "), F.col("sku_group"), F.lit(" was out of stock in "),
                 percent_text("stockout_rate", 1), F.lit(f" of snapshots of {period}, over {limit:.0%}."))
        .alias("message"),
    )


def alerts(ops: Tables, period: str, low: float = LOW_FULFILMENT, gap: float = SUPPLIER_GAP,
           stockout: float = HIGH_STOCKOUT) -> DataFrame:
    """All alerts of one month; columns that only one kind has are null for the others.

    A month without orders or without snapshots is refused.
    """
    month_bounds(period)
    for table, day, what in (("order_headers", "order_date", "orders"),
                             ("inventory_snapshots", "snapshot_date", "snapshots")):
        if ops[table].filter(in_month(day, period)).isEmpty():
            raise ValueError(f"no {what} in {period}")
    return fulfilment_alert(ops, period, low).unionByName(
        supplier_alerts(ops, gap), allowMissingColumns=True
    ).unionByName(stockout_alerts(ops, period, stockout), allowMissingColumns=True)


def period_pairs(ops: Tables) -> DataFrame:
    """Every pair of consecutive observed months with totals of both; one row per month."""
    monthly = ops["order_headers"].groupBy(month_key("order_date").alias("period_b")).agg(
        F.count(F.lit(1)).alias("total_b"), F.count_if(is_fulfilled()).alias("hits_b")
    )
    step = Window.orderBy("period_b")
    return monthly.select(
        F.lag("period_b").over(step).alias("period_a"), "period_b",
        F.lag("total_b").over(step).alias("total_a"), "total_b",
        F.lag("hits_b").over(step).alias("hits_a"), "hits_b",
    ).filter("period_a IS NOT NULL")


def worst_warehouses(ops: Tables, pairs: DataFrame) -> DataFrame:
    """Per month pair the warehouse with the most adverse contribution.

    Each warehouse-month takes part twice, as the later month of one pair and as the
    earlier month of the next.
    """
    cells = staged(ops["orders"].groupBy(month_key("order_date").alias("month"), "warehouse_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_fulfilled()).alias("hits")
    ), "cells")
    zero = F.lit(0).cast("bigint")
    later = cells.join(pairs, F.col("month") == F.col("period_b")).select(
        "period_a", "period_b", "warehouse_id", zero.alias("n_a"), zero.alias("h_a"),
        F.col("n").alias("n_b"), F.col("hits").alias("h_b"),
    )
    earlier = cells.join(pairs, F.col("month") == F.col("period_a")).select(
        "period_a", "period_b", "warehouse_id", F.col("n").alias("n_a"), F.col("hits").alias("h_a"),
        zero.alias("n_b"), zero.alias("h_b"),
    )
    both = later.union(earlier).groupBy("period_a", "period_b", "warehouse_id").agg(
        *[F.sum(c).alias(c) for c in ("n_a", "h_a", "n_b", "h_b")]
    ).join(pairs, ["period_a", "period_b"])
    contribution = F.col("h_b") / F.col("total_b") - F.col("h_a") / F.col("total_a")
    missed = safe_ratio(F.col("n_b") - F.col("h_b"), F.col("total_b") - F.col("hits_b"))
    rows = both.select(
        "period_a", "period_b",
        F.struct(
            F.col("warehouse_id").cast("string").alias("segment"),
            F.coalesce(safe_ratio("h_a", "n_a"), F.lit(0.0)).alias("rate_a"),
            F.coalesce(safe_ratio("h_b", "n_b"), F.lit(0.0)).alias("rate_b"),
            (contribution * 100).alias("contribution_pp"),
            F.coalesce(missed, F.lit(0.0)).alias("share_of_unfulfilled"),
        ).alias("w"),
    )
    order = F.struct(F.round("w.contribution_pp", 10), F.col("w.segment"))
    return rows.groupBy("period_a", "period_b").agg(F.min_by("w", order).alias("warehouse"))


def evidence_facts(ops: Tables) -> DataFrame:
    """Facts behind the narrative of every consecutive month pair that has snapshots.

    All numbers are already formatted, because answers are checked against this text.
    """
    pairs = staged(period_pairs(ops), "pairs")
    groups = worst_groups(stockout_by_sku_group(ops)).withColumnRenamed("month", "period_b")
    supplier = supplier_evidence(ops).select(
        F.col("supplier_id").cast("string").alias("segment"), "supplier_late_rate",
        "average_supplier_late_rate", "difference_from_average",
    )
    value_a, value_b = safe_ratio("hits_a", "total_a"), safe_ratio("hits_b", "total_b")
    joined = with_scalar(
        pairs.join(worst_warehouses(ops, pairs), ["period_a", "period_b"]).join(groups, "period_b"),
        supplier, "s",
    )
    return joined.select(
        F.lit("fulfilment").alias("kpi"),
        "period_a",
        "period_b",
        percent_text(value_a, 2).alias("value_a"),
        percent_text(value_b, 2).alias("value_b"),
        signed_text((value_b - value_a) * 100, 2).alias("change_pp"),
        F.signum(F.round(value_b - value_a, 12)).cast("int").alias("direction"),
        F.col("warehouse.segment").alias("warehouse"),
        percent_text("warehouse.rate_a", 2).alias("warehouse_rate_a"),
        percent_text("warehouse.rate_b", 2).alias("warehouse_rate_b"),
        signed_text("warehouse.contribution_pp", 2).alias("warehouse_contribution_pp"),
        percent_text("warehouse.share_of_unfulfilled", 1).alias("warehouse_share_of_unfulfilled"),
        F.col("s.segment").alias("supplier"),
        F.when(F.col("s").isNotNull(), percent_text("s.supplier_late_rate", 1)).alias("supplier_late_rate"),
        F.when(F.col("s").isNotNull(), percent_text("s.average_supplier_late_rate", 1))
        .alias("supplier_average"),
        F.when(F.col("s").isNotNull(), signed_text(F.col("s.difference_from_average") * 100, 2))
        .alias("supplier_gap_pp"),
        "sku_group",
        percent_text("stockout_rate", 1).alias("stockout_rate"),
        F.col("stockout_snapshots").cast("string").alias("stockout_snapshots"),
        F.col("snapshot_count").cast("string").alias("snapshot_count"),
        F.col("all_stockout_snapshots").cast("string").alias("all_stockout_snapshots"),
        percent_text("share_of_stockouts", 1).alias("share_of_stockouts"),
    )


def facts_text(facts: DataFrame) -> Column:
    """All facts of a row as one text."""
    return F.concat_ws(" ", *[F.col(c) for c in facts.columns if c != "direction"])


def narratives(facts: DataFrame) -> DataFrame:
    """Finding, evidence and recommendation written from the facts only."""
    moved = F.when(F.col("direction") < 0, "fell").when(F.col("direction") > 0, "rose").otherwise("stayed")
    known = F.col("supplier").isNotNull()
    return facts.withColumn("answer", F.concat_ws(
        "\n",
        F.format_string(
            "Finding: Fulfilment %s from %s in %s to %s in %s, a change of %s percentage points.",
            moved, "value_a", "period_a", "value_b", "period_b", "change_pp"),
        F.lit("Evidence:"),
        F.format_string(
            "- Warehouse %s went from %s to %s and contributed %s pp; it holds %s of unfulfilled orders.",
            "warehouse", "warehouse_rate_a", "warehouse_rate_b", "warehouse_contribution_pp",
            "warehouse_share_of_unfulfilled"),
        F.when(known, F.format_string(
            "- Supplier %s was late in %s of deliveries against a mean of %s over suppliers, a gap of %s "
            "percentage points.", "supplier", "supplier_late_rate", "supplier_average", "supplier_gap_pp"))
        .otherwise("- No supplier was late more often, none is above the all-supplier average."),
        F.format_string(
            "- SKU group %s was out of stock in %s of its snapshots (%s of %s), which is %s of all %s "
            "stock-out snapshots.", "sku_group", "stockout_rate", "stockout_snapshots", "snapshot_count",
            "share_of_stockouts", "all_stockout_snapshots"),
        F.lit("Recommendation:"),
        F.when(known, F.format_string(
            "- Inspect the process of warehouse %s and the late deliveries of supplier %s.",
            "warehouse", "supplier"))
        .otherwise(F.format_string(
            "- Inspect the process of warehouse %s and keep watching the suppliers.", "warehouse")),
        F.format_string("- Check replenishment of SKU group %s.", "sku_group"),
    ))


def unsupported_numbers(answer, facts) -> Column:
    """Numbers written in an answer that its facts do not contain."""
    return F.array_sort(F.array_except(number_tokens(answer), number_tokens(facts)))


def _any_start(line: Column, heads) -> Column:
    found = F.lit(False)
    for head in heads:
        found = found | line.startswith(head)
    return found


def with_structure(answers: DataFrame, text: str = "answer") -> DataFrame:
    """Add the sections of each answer: headings, evidence and recommendation bullets."""
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
    lines = F.filter(F.transform(F.split(F.col(text), breaks), strip), lambda x: x != "")
    split = answers.withColumn("_lines", lines)
    heads = F.filter(
        F.transform("_lines", lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
        lambda h: _any_start(h["line"], HEADINGS),
    )
    split = split.withColumn("_heads", heads)

    def bullets(start: Column, length: Column) -> Column:
        part = F.slice("_lines", start, F.greatest(length, F.lit(0)))
        found = F.filter(part, lambda x: x.startswith("- "))
        return F.when(F.size("_heads") == 3, found).otherwise(F.array().cast("array<string>"))

    second = F.try_element_at("_heads", F.lit(2))["at"]
    third = F.try_element_at("_heads", F.lit(3))["at"]
    labels = F.transform("_heads", lambda h: F.concat(F.substring_index(h["line"], ":", 1), F.lit(":")))
    return (
        split
        .withColumn("headings_in_order", labels == F.array(*[F.lit(h) for h in HEADINGS]))
        .withColumn("finding_has_text", F.coalesce(
            strip(F.substr(F.try_element_at("_heads", F.lit(1))["line"], F.lit(len(HEADINGS[0]) + 1))) != "",
            F.lit(False)))
        .withColumn("evidence", bullets(second + 2, third - second - 1))
        .withColumn("recommendations", bullets(third + 2, F.size("_lines") - third - 1))
        .drop("_lines", "_heads")
    )


def structure_errors() -> Column:
    """Names of the structural rules an answer breaks; needs ``with_structure``."""
    bullets = F.size("evidence")
    three = F.size("recommendations")
    first, last = F.try_element_at("evidence", F.lit(1)), F.try_element_at("evidence", F.lit(3))
    ordered = F.coalesce(first.startswith("- Warehouse ") & last.startswith("- SKU group "), F.lit(False))
    return F.array_compact(F.array(
        F.when(~F.col("headings_in_order"), "headings"),
        F.when(F.col("headings_in_order") & ~F.col("finding_has_text"), "empty_finding"),
        F.when(bullets != 3, "evidence_count"),
        F.when((bullets == 3) & ~ordered, "evidence_order"),
        F.when(~three.between(1, 2), "recommendation_count"),
    ))


def audit_answers(answers: DataFrame) -> DataFrame:
    """Rules broken by answers that come with their evidence facts.

    ``answers`` has the fact columns of ``evidence_facts`` and an ``answer``.
    """
    checked = with_structure(answers.withColumn("_facts", facts_text(answers.drop("answer"))))
    supplier = F.coalesce(F.try_element_at("evidence", F.lit(2)), F.lit(""))
    group = F.coalesce(F.try_element_at("evidence", F.lit(3)), F.lit(""))

    def holds(line: Column, *names: str) -> Column:
        found = F.lit(True)
        for name in names:
            found = found & F.contains(line, F.col(name))
        return F.coalesce(found, F.lit(False))

    supplier_ok = F.when(
        F.col("supplier").isNotNull(),
        supplier.startswith("- Supplier ") & F.contains(supplier, F.lit("percentage points"))
        & holds(supplier, "supplier", "supplier_late_rate", "supplier_average", "supplier_gap_pp"),
    ).otherwise(
        supplier.startswith("- No supplier ") & F.contains(supplier, F.lit("above the all-supplier average"))
    )
    group_ok = group.startswith("- SKU group ") & F.contains(group, F.lit("stock-out snapshots")) & F.contains(
        group, F.lit("all")
    ) & holds(group, "sku_group", "stockout_rate", "stockout_snapshots", "snapshot_count",
              "share_of_stockouts", "all_stockout_snapshots")
    named = F.exists("recommendations", lambda x: F.contains(x, F.concat(F.lit("SKU group "), F.col("sku_group"))))
    facts_errors = F.array_compact(F.array(
        F.when(~supplier_ok, "supplier_evidence"),
        F.when(~group_ok, "sku_group_evidence"),
        F.when(~named, "recommendation_group"),
        F.when(F.size(unsupported_numbers("answer", "_facts")) > 0, "unsupported_numbers"),
    ))
    return checked.withColumn("errors", F.concat(structure_errors(), facts_errors)).drop("_facts")
