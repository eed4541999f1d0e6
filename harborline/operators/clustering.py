"""k-means with restarts and readable cluster labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.joins import repeated_keys, with_scalar
from harborline.operators.storage import staged

GRID = 1 << 16  # points of the grid that clustering works on, per unit


def standardise(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add zero-mean, unit-variance columns (population deviation; a constant gives 0)."""
    moments = df.agg(
        *[F.avg(c).alias(f"m_{n}") for n, c in columns.items()],
        *[F.stddev_pop(c).alias(f"s_{n}") for n, c in columns.items()],
    )
    out = with_scalar(df, moments, "_moments")
    for name, column in columns.items():
        sd = F.col(f"_moments.s_{name}")
        scaled = (column - F.col(f"_moments.m_{name}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out = out.withColumn(name, scaled)
    return out.drop("_moments")


def distinct_points(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """At most ``k`` of the distinct points, rounded to twelve decimals."""
    return df.select(*[(F.round(c, 12) + F.lit(0.0)).alias(c) for c in columns]).distinct().limit(k)


def effective_k(df: DataFrame, columns: Sequence[str], k: int) -> int:
    """At most k, the number of rows, and the number of distinct rounded points."""
    return distinct_points(df, columns, k).count()


def _uniform(*parts) -> Column:
    """A number strictly between 0 and 1 that belongs to the parts."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _runs(centers: Mapping[int, Sequence[Sequence[int]]]) -> Column:
    """The runs and their centres as an array of structs, one row per run when it is inlined."""
    return F.array(*[
        F.struct(F.lit(r).alias("run"), F.array(*[F.array(*[F.lit(x).cast("bigint") for x in c]) for c in own]).alias("centers"))
        for r, own in centers.items()
    ])


def _distances(centers: Column, names: Sequence[str]) -> Column:
    """Squared distances from the grid point in the columns ``names`` to every centre."""
    def distance(center: Column) -> Column:
        gaps = [(F.col(n) - F.get(center, F.lit(i))).cast("double") for i, n in enumerate(names)]
        return reduce(add, [g * g for g in gaps])

    return F.transform(centers, distance)


def _seeds(points: DataFrame, names: Sequence[str], k: int, seed: int, restarts: int) -> dict[int, list[tuple]]:
    """First centres of every run: points drawn with a chance that grows with weight and squared distance.

    Every point races with an exponential time of that rate, whose uniform number belongs to (seed, run, place, point); the
    first one becomes the next centre.
    """
    chosen: dict[int, list[tuple]] = {r: [] for r in range(restarts)}
    for place in range(k):
        if place:
            rows = points.select("*", F.inline(_runs(chosen)))
            rows = rows.withColumn("far", F.array_min(_distances(F.col("centers"), names))).filter("far > 0")
        else:
            rows = points.select("*", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("run"), F.lit(1.0).alias("far"))
        u = _uniform(F.lit(seed), F.col("run"), F.lit(place), *[F.col(n) for n in names])
        time = -F.log(u) / (F.col("weight").cast("double") * F.col("far"))
        first = rows.groupBy("run").agg(F.min(F.struct(time.alias("time"), *names)).alias("first"))
        for row in first.collect():  # one row per run
            chosen[row["run"]].append(tuple(row["first"][n] for n in names))
    return chosen


def _moved(points: DataFrame, names: Sequence[str], centers: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    """The centres after one step: means of their points, rounded to the grid; a centre without points stays."""
    ds = _distances(F.col("centers"), names)
    near = points.select("*", F.inline(_runs(centers))).withColumn("_d", ds)
    near = near.withColumn("place", F.array_position("_d", F.array_min("_d")))
    weight = F.col("weight").cast("decimal(38,0)")
    sums = near.groupBy("run", "place").agg(
        F.sum("weight").alias("n"), *[F.sum(weight * F.col(n)).cast("decimal(38,0)").alias(n) for n in names])
    moved = {r: list(own) for r, own in centers.items()}
    for row in sums.collect():  # one row per run and centre
        n = int(row["n"])
        moved[row["run"]][row["place"] - 1] = tuple((2 * int(row[c]) + n) // (2 * n) for c in names)
    return moved


def kmeans_clusters(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42, restarts: int = 10,
                    iterations: int = 300) -> DataFrame:
    """Add ``cluster_id`` of the best of ``restarts`` k-means runs of at most ``iterations`` steps each.

    Points are whole multiples of 1 / ``GRID``, equal ones are one weighted point, and all sums are of whole numbers,
    so neither partitioning nor the order of rows changes the result. Seeds are drawn by hashes. All runs
    take each step together, in one aggregate that sends a row per run, centre and task. ``df`` should be
    stored. An empty frame gets a null cluster.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    used = effective_k(df, columns, k)
    if used == 0:
        return df.withColumn("cluster_id", F.lit(None).cast("int"))
    names = [f"_q{i}" for i in range(len(columns))]
    grid = {n: F.round(F.col(c) * GRID).cast("bigint") for n, c in zip(names, columns)}
    points = df.select(*[c.alias(n) for n, c in grid.items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("weight"))
    points = staged(points, "grid")
    centers = _seeds(points, names, min(used, points.limit(used).count()), seed, restarts)
    moving = dict(centers)
    for _ in range(iterations):
        after = _moved(points, names, moving)
        centers.update(after)
        moving = {r: own for r, own in after.items() if own != moving[r]}
        if not moving:
            break
    ds = F.array_min(_distances(F.col("centers"), names)).cast("decimal(38,0)")
    costs = points.select("*", F.inline(_runs(centers))).groupBy("run").agg(F.sum(F.col("weight") * ds).alias("cost"))
    best = min(costs.collect(), key=lambda r: (r["cost"], r["run"]))["run"]  # one row per run
    found = df.withColumns(grid).withColumn("_d", _distances(F.element_at(_runs({0: centers[best]}), 1)["centers"], names))
    return found.withColumn("cluster_id", (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d", *names)


def label_clusters(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Name each cluster by its standardised mean recency, frequency and monetary value.

    The strongest cluster is ``Champions``, then the weakest of the others is ``Lost``,
    then the most frequent and recent is ``Loyal``; the rest is ``At Risk``. Everything
    after the first aggregation has one row per cluster.
    """
    measures = ("recency_days", "frequency", "monetary")
    means = df.groupBy(cluster).agg(*[F.avg(m).alias(m) for m in measures])
    profile = standardise(means, {f"z_{m}": F.col(m) for m in measures})
    r, f, m = (F.col(f"z_{x}") for x in measures)
    best = F.row_number().over(Window.orderBy(F.desc("_strength"), cluster))
    worst = F.row_number().over(Window.orderBy("_champion", F.asc("_strength"), cluster))
    loyal = F.row_number().over(Window.orderBy("_champion", "_lost", F.desc("_loyalty"), cluster))
    labels = (
        profile.withColumn("_strength", f + m - r).withColumn("_loyalty", f - r)
        .withColumn("_champion", best == 1)
        .withColumn("_lost", (worst == 1) & ~F.col("_champion"))
        .withColumn("_loyal", (loyal == 1) & ~F.col("_champion") & ~F.col("_lost"))
        .select(
            cluster,
            F.when(F.col("_champion"), "Champions").when(F.col("_lost"), "Lost")
            .when(F.col("_loyal"), "Loyal").otherwise("At Risk").alias("segment_label"),
        )
    )
    return df.join(labels, cluster, "left").select(*df.columns, "segment_label")


def rfm_segments(rfm: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10) -> DataFrame:
    """Cluster customers by standardised RFM (recency negated) and label the clusters.

    Customers that repeat, and missing values, are refused.
    """
    needed = ["customer_id", "recency_days", "frequency", "monetary"]
    if not repeated_keys(rfm, ["customer_id"]).isEmpty():
        raise ValueError("customers repeat a customer_id")
    if not rfm.filter(reduce(or_, [F.col(c).isNull() for c in needed])).isEmpty():
        raise ValueError("customers have missing values")
    scaled = standardise(rfm, {
        "scaled_recency": -F.col("recency_days"),
        "scaled_frequency": F.col("frequency").cast("double"),
        "scaled_monetary": F.col("monetary"),
    })
    columns = ["scaled_recency", "scaled_frequency", "scaled_monetary"]
    clustered = kmeans_clusters(staged(scaled, "scaled"), columns, k, seed, restarts)
    return label_clusters(clustered.drop(*columns))
