"""Operators over one global order, without a single-partition sort.

All of them range-partition on the order, sort inside partitions, and add the sizes
of the preceding partitions. Range bounds are sampled, so the partitioned frame is
written to the shared folder before anything is derived from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.storage import staged

WINDOW_ROWS = 100_000  # a histogram of at most this size is ordered in one window
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _with_offsets(df: DataFrame, part: str, weight: Column) -> DataFrame:
    """Add ``_before``: total weight of all partitions that precede ``part``.

    The side that is broadcast has one row per partition.
    """
    sizes = df.groupBy(part).agg(F.sum(weight).alias("_size"))
    running = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_before"))
    return df.join(F.broadcast(offsets), part)


def dense_index(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """Zero-based position of every row in the given order.

    Rows that are equal in all order keys get neighbouring positions; end the order in a
    unique key, or such rows share a partition. The input is read twice, once to sample
    the range bounds, so pass a stored frame.
    """
    placed = staged(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS)),
        "ordered",
    )
    position = F.col("_before") + F.col("_id") % F.lit(1 << _ROW_BITS)
    return _with_offsets(placed, "_part", F.lit(1)).select(*df.columns, position.alias(out))


def ntile_scaled(df: DataFrame, key: str, n: int, measures: Mapping[str, Column]) -> DataFrame:
    """``NTILE(n)`` for several orders at once; ``key`` must be unique.

    ``measures`` maps an output name to a column sorted ascending, ties by ``key``; values
    are compared in their own type. All orders share one range shuffle of narrow rows (the
    order, one value column per order of which only its own is filled, the key); the
    only thing taken from it are the ``n - 1`` rows that open a new tile in each order.
    Every row then finds its tile by comparing itself with those rows.
    """
    names = list(measures)
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return df.withColumns({name: F.lit(1) for name in names})
    types = dict(df.select(*[measures[name].alias(name) for name in names]).dtypes)
    slots = [f"_value{i}" for i in range(len(names))]
    entries = F.array(*[
        F.struct(F.lit(i).alias("_order"), *[
            (measures[own] if own == name else F.lit(None).cast(types[own])).alias(slot)
            for own, slot in zip(names, slots)
        ])
        for i, name in enumerate(names)
    ])
    order = ["_order", *slots, "_key"]
    narrow = staged(df.select(F.col(key).alias("_key"), F.inline(entries)), "tiles")
    placed = staged(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS)),
        "ordered",
    )
    total = placed.agg((F.count(F.lit(1)) / len(names)).cast("long").alias("t")).scalar()
    position = F.col("_before") + F.col("_id") % F.lit(1 << _ROW_BITS)
    spread = _with_offsets(placed, "_part", F.lit(1)).select(
        *order, (position - F.col("_order") * total).alias("_at"), total.alias("_n")
    )
    # Tiles are as equal as possible and the larger ones come first.
    base, extra = F.floor(F.col("_n") / n), F.col("_n") % n
    cuts = [base * t + F.least(extra, F.lit(t)) for t in range(1, n)]
    bounds = spread.agg(*[
        F.max(F.when((F.col("_order") == i) & (F.col("_at") == cut), F.struct(F.col(slots[i]).alias("_value"), "_key")))
        .alias(f"{name}_{t}")
        for i, name in enumerate(names)
        for t, cut in enumerate(cuts, start=1)
    ])
    out = df.withColumn("_bounds", bounds.select(F.struct(*bounds.columns)).scalar())
    for name in names:
        own = F.struct(measures[name].alias("_value"), F.col(key).alias("_key"))
        passed = [
            F.when(own >= F.col(f"_bounds.{name}_{t}"), 1).otherwise(0) for t in range(1, n)
        ]
        out = out.withColumn(name, sum(passed, F.lit(1)))
    return out.drop("_bounds")


def hist_rank(df: DataFrame, value: str, weights: Mapping[str, Column]) -> DataFrame:
    """Average-tie ranks through a histogram: one row per distinct value.

    Result: ``value``, the summed ``weights``, ``rows`` and ``avg_rank`` (1-based).
    The histogram is written first. One of at most ``WINDOW_ROWS`` values, such as days of a calendar, is
    ordered in one window; a larger one is range-partitioned.
    """
    histogram = df.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(w).alias(name) for name, w in weights.items()]
    )
    stored = staged(histogram, "histogram")
    if stored.count() <= WINDOW_ROWS:
        ranked = stored.withColumn("_upto", F.sum("rows").over(Window.orderBy(value)))
    else:
        placed = staged(stored.repartitionByRange(value).withColumn("_part", F.spark_partition_id()), "ordered")
        inside = F.sum("rows").over(Window.partitionBy("_part").orderBy(value))
        ranked = _with_offsets(placed, "_part", F.col("rows")).withColumn(
            "_upto", F.col("_before") + inside
        )
    return ranked.select(
        *histogram.columns,
        (F.col("_upto") - (F.col("rows") - 1) / F.lit(2.0)).alias("avg_rank"),
    )


def exact_quantile(df: DataFrame, value: str, share: float) -> DataFrame:
    """The quantile with linear interpolation between neighbours, as one row ``quantile``; null without values.

    Read off the range-partitioned histogram, so neither the number of rows nor that of
    distinct values meets in one task.
    """
    ranks = staged(hist_rank(df.select(value), value, {}).select(
        value, (F.col("avg_rank") + (F.col("rows") - 1) / 2).alias("_upto")), "ranks")
    at = ranks.agg((share * (F.max("_upto") - 1)).alias("p")).scalar()
    low = ranks.filter(F.col("_upto") >= F.floor(at) + 1).agg(F.min(value)).scalar()
    high = ranks.filter(F.col("_upto") >= F.ceil(at) + 1).agg(F.min(value)).scalar()
    return ranks.limit(1).agg(F.count(F.lit(1)).alias("n")).select(
        (low + (high - low) * (at - F.floor(at))).alias("quantile"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Quantiles with linear interpolation per group: ``keys`` and a column for each of ``shares``; null without values.

    All quantiles of all groups are read off one histogram that is range-partitioned by group and value, so
    neither the rows nor the distinct values of a group meet in one task.
    """
    def same(renamed: Sequence[str]) -> Column:
        return reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)])

    def at(share: float) -> Column:
        return F.lit(float(share)) * (F.col("_n") - 1)

    names = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    known = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rows"))
    stored = staged(known, "histogram")  # its range bounds are sampled, which reads it twice
    placed = staged(stored.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "ordered")
    own = Window.partitionBy(*keys).orderBy("_part")
    sizes = placed.groupBy(*keys, "_part").agg(F.sum("_rows").alias("_own"))
    sizes = sizes.select(*renamed, F.col("_part").alias("_p"), (F.sum("_own").over(own) - F.col("_own")).alias("_before"),
                         F.sum("_own").over(Window.partitionBy(*keys)).alias("_n"))
    inside = F.sum("_rows").over(Window.partitionBy(*keys, "_part").orderBy(value))
    upto = placed.withColumn("_inside", inside).join(sizes, same(names) & (F.col("_part") == F.col("_p"))).select(
        *keys, value, "_n", (F.col("_before") + F.col("_inside")).alias("_upto"))
    found = upto.groupBy(*keys, "_n").agg(*[
        F.min(F.when(F.col("_upto") >= edge(at(share)) + 1, F.col(value))).alias(f"_{end}{i}")
        for i, share in enumerate(shares.values()) for end, edge in (("low", F.floor), ("high", F.ceil))])
    quantiles = [
        (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (at(share) - F.floor(at(share)))).alias(name)
        for i, (name, share) in enumerate(shares.items())]
    return df.select(*keys).distinct().join(found.select(*renamed, *quantiles), same(names), "left").select(*keys, *shares)
