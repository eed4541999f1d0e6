"""Customer value, churn risk and segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions import clip, safe_ratio
from harborline.operators.clustering import rfm_segments
from harborline.operators.joins import with_scalar
from harborline.operators.ordering import hist_rank
from harborline.operators.storage import staged
from harborline.plans.kpi import customer_rfm_base

Tables = Mapping[str, DataFrame]


def customer_rfm(ops: Tables) -> DataFrame:
    """Recency, frequency and monetary value without scores."""
    return customer_rfm_base(ops).drop("customer_segment")


def frequency_decline(ops: Tables, treat_missing_as_zero: bool = False) -> DataFrame:
    """Drop of the mean monthly order count from the early to the recent half of the months.

    A customer without orders in either half scores 0, also one that simply stopped
    ordering; ``treat_missing_as_zero`` counts the empty half as zero orders instead.
    """
    orders = ops["order_headers"].filter(F.col("order_date").isNotNull())
    month = F.trunc("order_date", "month")
    # One row per month of the calendar, ordered in an array.
    months = orders.select(month.alias("m")).distinct().agg(F.sort_array(F.collect_list("m")).alias("months"))
    n = F.size("months")
    split = F.greatest(F.lit(1), F.floor(n / 2)).cast("int")
    halves = months.select(
        split.alias("n_early"),
        F.when(n > split, n - split).otherwise(split).alias("n_recent"),
        F.try_element_at("months", split).alias("last_early"),
        (n > split).alias("has_recent"),
    )
    placed = with_scalar(orders.select("customer_id", month.alias("m")), halves, "h")
    early = F.col("m") <= F.col("h.last_early")
    recent = (F.col("m") > F.col("h.last_early")) | ~F.col("h.has_recent")
    counts = placed.groupBy("customer_id").agg(
        F.count_if(early).alias("early"), F.count_if(recent).alias("recent"),
        F.any_value("h.n_early").alias("n_early"), F.any_value("h.n_recent").alias("n_recent"),
    )
    mean_early = safe_ratio("early", "n_early")
    mean_recent = safe_ratio("recent", "n_recent")
    decline = F.greatest(mean_early - mean_recent, F.lit(0.0)) / F.greatest(mean_early, F.lit(1.0))
    if not treat_missing_as_zero:
        decline = F.when((F.col("early") > 0) & (F.col("recent") > 0), decline)
    scored = counts.select("customer_id", decline.alias("decline"))
    return ops["customers"].select("customer_id").join(scored, "customer_id", "left").select(
        "customer_id", clip(F.coalesce("decline", F.lit(0.0)), 0.0, 1.0).alias("frequency_decline_score")
    )


def ticket_counts(ops: Tables) -> DataFrame:
    """Tickets per customer, 0 for those without."""
    counts = ops["support_tickets"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("ticket_count"))
    return ops["customers"].select("customer_id").join(counts, "customer_id", "left").select(
        "customer_id", F.coalesce("ticket_count", F.lit(0)).alias("ticket_count")
    )


def ticket_percentile(counts: DataFrame) -> DataFrame:
    """Average-tie percentile rank of the ticket count."""
    ranks = staged(hist_rank(counts, "ticket_count", {}), "ranks")
    total = counts.agg(F.count("ticket_count")).scalar()
    return counts.join(ranks, "ticket_count", "left").select(
        "customer_id", "ticket_count", (F.col("avg_rank") / total).alias("ticket_percentile")
    )


def churn_risk(ops: Tables, treat_missing_as_zero: bool = False) -> DataFrame:
    """60 % frequency decline and 40 % ticket percentile."""
    decline = frequency_decline(ops, treat_missing_as_zero)
    tickets = ticket_percentile(ticket_counts(ops))
    risk = 0.6 * F.col("frequency_decline_score") + 0.4 * F.col("ticket_percentile")
    return decline.join(tickets, "customer_id").select(
        "customer_id", "frequency_decline_score", "ticket_count", "ticket_percentile",
        clip(risk, 0.0, 1.0).alias("churn_risk_score"),
    )


def customer_segments(ops: Tables, k: int = 4, seed: int = 42, restarts: int = 10) -> DataFrame:
    """RFM, cluster, label and churn risk per customer."""
    rfm = staged(customer_rfm(ops), "rfm")
    risk = churn_risk(ops).drop("ticket_percentile")
    return rfm_segments(rfm, k, seed, restarts).join(risk, "customer_id")
