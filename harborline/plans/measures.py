"""Measures of the reporting model: aggregates under a filter context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.storage import staged


def measure(df: DataFrame, aggs: Mapping[str, Column], by: Sequence[str] = (),
            where: Column | None = None, within: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Aggregate a relation by some columns under filters.

    ``within`` is a frame and a column name: only rows whose value of that column occurs
    in the frame are aggregated, the way a calendar selection reaches monthly rows.
    """
    if where is not None:
        df = df.filter(where)
    if within is not None:
        chosen, key = within
        df = df.join(chosen.select(key).distinct(), key, "left_semi")
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in aggs.items()])


def share_of(df: DataFrame, value: str, over: Sequence[str], out: str) -> DataFrame:
    """Share of a summed value after removing every filter but ``over``."""
    df = staged(df, "shares")  # read twice
    totals = df.groupBy(*over).agg(F.sum(value).alias("_total"))
    if over:
        joined = df.join(totals, list(over))
    else:
        joined = df.withColumn("_total", totals.scalar())
    return joined.withColumn(out, F.col(value) / F.nullif(F.col("_total"), F.lit(0))).drop("_total")


def histogram(df: DataFrame, value: str, low: float, high: float, buckets: int) -> DataFrame:
    """Rows per equal-width bucket; 0 and buckets + 1 hold what lies outside."""
    bucket = F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(buckets))
    return df.filter(F.col(value).isNotNull()).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows")
    )
