"""Joins with an asserted cardinality and single-row-per-key reductions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two sides that both grow with the facts.

    The merge hint rules out a broadcast, which a low size estimate of an aggregated
    side could otherwise bring about. A merge join spills, and adaptive execution splits
    its skewed partitions.
    """
    return left.join(right.hint("merge"), on, how)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                 unique: str = "right") -> DataFrame:
    """Equi-join that raises when a side declared unique repeats a key.

    ``unique`` is ``right``, ``left`` or ``both``.
    """
    on = [on] if isinstance(on, str) else list(on)
    for name, side in (("left", left), ("right", right)):
        if unique in (name, "both") and not repeated_keys(side, on).isEmpty():
            raise ValueError(f"{name} side repeats the join key {on}")
    return left.join(right, on, how)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  columns: Sequence[str]) -> DataFrame:
    """One row per key: the least by ``order``.

    A partial ``min_by`` reduces every input partition before the shuffle, so a key
    that holds a large share of the rows sends one row per partition.
    """
    picked = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in columns]
    )


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-null value per key; equal counts resolve to the least value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value)
    )


def nulls_last(column) -> tuple[Column, Column]:
    """Two ascending keys that order nulls after all values inside a struct."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull(), column


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Attach a one-row aggregate to every row as a struct column.

    It becomes a scalar subquery, which Spark runs once and which fails if the
    aggregate ever has more than one row.
    """
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns)).scalar())
