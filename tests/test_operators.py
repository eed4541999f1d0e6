import math
import random
from unittest import mock

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from harborline.operators import joins, ordering
from harborline.operators.clustering import kmeans_clusters, label_clusters, rfm_segments
from harborline.operators.forest import average_path, isolation_forest
from harborline.operators.hypothesis import chi_square, exact_u_p, mann_whitney
from harborline.operators.ordering import exact_quantile, ntile_scaled

QUICK = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@QUICK
@given(st.lists(st.integers(0, 6), min_size=0, max_size=60), st.integers(1, 9), st.sampled_from([1, 3, 17]))
def test_ntile_matches_window(spark, values, n, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").repartition(parts)
    got = ordering.ntile_scaled(df, "id", n, {"up": F.col("v"), "down": -F.col("v")})
    expected = df.select(
        "id", "v", F.ntile(n).over(Window.orderBy("v", "id")).alias("up"),
        F.ntile(n).over(Window.orderBy(F.desc("v"), "id")).alias("down"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@QUICK
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.booleans())
def test_hist_rank_matches_pandas(spark, values, small):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    with mock.patch.object(ordering, "WINDOW_ROWS", ordering.WINDOW_ROWS if small else 0):
        got = {r["v"]: r["avg_rank"] for r in ordering.hist_rank(df, "v", {}).collect()}
    ranks = pd.Series(values).rank()
    assert all(got[v] == r for v, r in zip(values, ranks))


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_dense_index(spark, parts):
    values = random.Random(1).sample(range(1000), 300)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(parts)
    rows = ordering.dense_index(df, ["v"], "at").collect()
    assert sorted((r["at"], r["v"]) for r in rows) == list(enumerate(sorted(values)))


def test_checked_join(frame):
    left = frame("k int, a int", [(1, 1), (1, 2), (2, 3)])
    right = frame("k int, b int", [(1, 10), (1, 11)])
    with pytest.raises(ValueError, match="right side"):
        joins.join_checked(left, right, "k")
    with pytest.raises(ValueError, match="left side"):
        joins.join_checked(left, right.limit(1), "k", unique="both")
    assert joins.join_checked(left, right.filter("b = 10"), ["k"]).count() == 3


def test_mode_and_first(frame):
    df = frame("k int, v string, d int", [(1, "b", 2), (1, "a", 1), (2, "x", 5), (2, "x", 4), (2, "a", 1), (3, None, 1)])
    assert dict(map(tuple, joins.mode_per_key(df, ["k"], "v").collect())) == {1: "a", 2: "x"}
    first = joins.first_per_key(df, ["k"], [F.col("d")], ["v", "d"])
    assert sorted(map(tuple, first.collect()), key=str) == [(1, "a", 1), (2, "a", 1), (3, None, 1)]


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def test_mann_whitney_exact(frame):
    a, b = [10, 11, 12, 13], [1, 2, 3, 4]
    df = frame("v double, a boolean", [(float(x), True) for x in a] + [(float(x), False) for x in b])
    row = mann_whitney(df, "v", F.col("a"), method="exact").first()
    assert row["u"] == 16 and row["cliffs_delta"] == 1.0
    assert row["p_value"] == pytest.approx(2 / math.comb(8, 4))


@QUICK
@given(st.lists(st.integers(0, 4), min_size=2, max_size=20), st.lists(st.integers(0, 4), min_size=2, max_size=20))
def test_mann_whitney_ties(spark, a, b):
    df = spark.createDataFrame([(float(x), True) for x in a] + [(float(x), False) for x in b], "v double, a boolean")
    row = mann_whitney(df, "v", F.col("a")).first()
    assert row["u"] == brute_u(a, b)
    assert 0 <= row["p_value"] <= 1


def test_exact_distribution():
    from itertools import combinations

    for n_a, n_b in ((1, 1), (2, 5), (4, 3), (8, 2)):
        all_u = []
        for chosen in combinations(range(n_a + n_b), n_a):
            rest = [i for i in range(n_a + n_b) if i not in chosen]
            all_u.append(brute_u(chosen, rest))
        for u in set(all_u):
            extreme = max(u, n_a * n_b - u)
            p = min(1.0, 2 * sum(x >= extreme for x in all_u) / len(all_u))
            assert exact_u_p(u, n_a, n_b) == pytest.approx(p)


def test_exact_distribution_of_few_against_many():
    """The closed form equals the recurrence, and its cost does not depend on the larger side."""
    from harborline.operators.hypothesis import few_u_p

    for few, many in ((1, 9), (2, 30), (5, 11), (8, 8), (8, 25)):
        counts = {0: 1}  # arrangements by U, from those with a value less on one side
        table = [[{} for _ in range(many + 1)] for _ in range(few + 1)]
        for a in range(few + 1):
            for b in range(many + 1):
                if not a or not b:
                    table[a][b] = counts
                    continue
                cell = dict(table[a][b - 1])
                for k, n in table[a - 1][b].items():
                    cell[k + b] = cell.get(k + b, 0) + n
                table[a][b] = cell
        total = math.comb(few + many, few)
        for u in range(few * many + 1):
            tail = sum(n for k, n in table[few][many].items() if k >= max(u, few * many - u))
            assert few_u_p(u, few, many) == pytest.approx(min(1.0, 2 * tail / total), abs=1e-12)
    assert few_u_p(0, 2, 10 ** 9) == pytest.approx(2 / math.comb(10 ** 9 + 2, 2))
    assert few_u_p(4 * 10 ** 9, 8, 10 ** 9) == pytest.approx(1.0, abs=1e-6)


def test_mann_whitney_chooses_the_method(frame):
    """Exact for a small side without ties; approximate with ties or two large sides."""
    small = frame("a boolean, v double", [(i < 3, float(i * 7 % 31)) for i in range(31)])
    row, exact, rough = (mann_whitney(small, "v", F.col("a"), method=m).first() for m in ("auto", "exact", "asymptotic"))
    assert row["p_value"] == exact["p_value"] == pytest.approx(exact_u_p(row["u"], 3, 28), abs=1e-10)
    assert row["p_value"] != rough["p_value"]
    tied = small.union(frame("a boolean, v double", [(False, 7.0)]))
    large = frame("a boolean, v double", [(i < 9, float(i * 7 % 31)) for i in range(31)])
    for df in (tied, large):
        assert mann_whitney(df, "v", F.col("a")).first() == mann_whitney(df, "v", F.col("a"), method="asymptotic").first()


def test_chi_square_against_brute_force(frame):
    rng = random.Random(3)
    rows = [(rng.choice("abcd"), rng.random() < 0.3) for _ in range(200)] + [("e", True)] * 7
    counts = pd.crosstab(pd.Series([r[0] for r in rows]), pd.Series([r[1] for r in rows]))
    expected = counts.sum(axis=1).to_numpy()[:, None] * counts.sum().to_numpy()[None, :] / len(rows)
    chi2 = ((counts.to_numpy() - expected) ** 2 / expected).sum()
    row = chi_square(frame("a string, b boolean", rows), "a", "b").first()
    assert row["chi2"] == pytest.approx(chi2)
    assert (row["n"], row["n_rows"], row["n_columns"]) == (207, 5, 2)
    assert row["cramers_v"] == pytest.approx(math.sqrt(chi2 / 207))
    assert chi_square(frame("a string, b boolean", [("x", True)]), "a", "b").count() == 0


def test_forest_is_deterministic_and_finds_the_extreme(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(10, 1), rng.gauss(5, 1)) for i in range(400)] + [(400, 60.0, -40.0), (401, None, 1.0)]
    results = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "id int, a double, b double").repartition(parts)
        found = isolation_forest(df, ["id"], ["a", "b"], trees=25).orderBy("id").collect()
        results.append([(r["id"], r["isolation_forest_flag"], r["anomaly_score"]) for r in found])
    assert results[0] == results[1]
    flags = {i for i, flag, _ in results[0] if flag}
    scores = {i: s for i, _, s in results[0]}
    assert 400 in flags and scores[400] == min(s for s in scores.values() if s is not None)
    assert scores[401] is None and 401 not in flags
    assert abs(len(flags) / 401 - 0.05) < 0.01
    assert average_path(2) == 1.0


def test_forest_samples_large_inputs(spark):
    df = spark.range(3000).selectExpr("id", "CAST(id % 97 AS DOUBLE) AS a", "CAST(id % 89 AS DOUBLE) AS b")
    found = isolation_forest(df, ["id"], ["a", "b"], trees=2)
    assert found.filter("anomaly_score IS NULL").count() == 0
    assert 0 < found.filter("isolation_forest_flag").count() <= 160


def test_forest_needs_five_rows(frame):
    df = frame("id int, a double", [(i, float(i)) for i in range(4)])
    assert isolation_forest(df, ["id"], ["a"]).filter("isolation_forest_flag").count() == 0


def test_segments(spark):
    groups = {"hi": (1.0, 30, 900.0), "mid": (20.0, 12, 300.0), "old": (300.0, 6, 100.0), "gone": (700.0, 1, 10.0)}
    rows = [(f"{g}{i}", r + i, f, m + i) for g, (r, f, m) in groups.items() for i in range(5)]
    df = spark.createDataFrame(rows, "customer_id string, recency_days double, frequency int, monetary double")
    labels = {}
    for r in rfm_segments(df, restarts=4).collect():
        labels.setdefault(r["customer_id"].rstrip("01234"), set()).add(r["segment_label"])
    assert labels == {"hi": {"Champions"}, "mid": {"Loyal"}, "old": {"At Risk"}, "gone": {"Lost"}}


def test_labels_with_few_clusters(frame):
    schema = "customer_id int, recency_days double, frequency int, monetary double, cluster_id int"
    one = label_clusters(frame(schema, [(1, 5.0, 2, 10.0, 0), (2, 5.0, 2, 10.0, 0)]))
    assert {r["segment_label"] for r in one.collect()} == {"Champions"}
    two = label_clusters(frame(schema, [(1, 1.0, 9, 90.0, 0), (2, 90.0, 1, 1.0, 1)]))
    assert {r["customer_id"]: r["segment_label"] for r in two.collect()} == {1: "Champions", 2: "Lost"}


def test_kmeans_limits_clusters(frame):
    df = frame("id int, x double", [(1, 1.0), (2, 1.0), (3, 4.0)])
    assert kmeans_clusters(df, ["x"], 4, restarts=2).select("cluster_id").distinct().count() == 2
    assert kmeans_clusters(df.limit(0), ["x"], 4).count() == 0
    with pytest.raises(ValueError):
        kmeans_clusters(df, ["x"], 0)


def test_kmeans_does_not_depend_on_partitions(spark):
    """Same clusters for any partitioning and order of rows, and the best of all restarts."""
    rng = random.Random(9)
    rows = [(i, rng.gauss(i % 4 * 3.0, 0.7), rng.gauss(i % 3 * 2.0, 0.7)) for i in range(300)] + [(300, 1.0, 1.0)] * 5
    results = []
    for parts in (1, 9):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "id int, x double, y double").repartition(parts)
        results.append(sorted(tuple(r) for r in kmeans_clusters(df, ["x", "y"], 4).select("id", "cluster_id").collect()))
    assert results[0] == results[1] and {c for _, c in results[0]} == {0, 1, 2, 3}
    place = {i: (x, y) for i, x, y in rows}

    def cost(found):
        total = 0.0
        for c in range(4):
            own = np.array([place[i] for i, k in found if k == c])
            total += ((own - own.mean(axis=0)) ** 2).sum()
        return total

    one = kmeans_clusters(spark.createDataFrame(rows, "id int, x double, y double"), ["x", "y"], 4, restarts=1)
    assert cost(results[0]) <= cost([tuple(r) for r in one.select("id", "cluster_id").collect()]) + 1e-6
    # No point is nearer to the mean of another cluster, but for the rounding to the grid.
    means = {c: np.mean([place[i] for i, k in results[0] if k == c], axis=0) for c in range(4)}
    for i, c in results[0]:
        far = {k: ((np.array(place[i]) - m) ** 2).sum() for k, m in means.items()}
        assert far[c] <= min(far.values()) + 1e-3


def test_kmeans_separates_far_groups(frame):
    df = frame("id int, x double", [(i, 100.0 * (i % 3) + i / 100) for i in range(30)])
    found = kmeans_clusters(df, ["x"], 3, restarts=5).collect()
    assert len({(r["id"] % 3, r["cluster_id"]) for r in found}) == 3


def test_ntile_compares_values_in_their_own_type(spark):
    """Steps of 1e-8 and values beyond a decimal's range, against the window function."""
    rows = [(i, 1.0 + (i * 7 % 10) * 1e-8, None if i == 3 else i * 7 % 5, 1e35 * (i % 4)) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, fine double, small int, huge double")
    got = ntile_scaled(df, "id", 4, {"a": F.col("fine"), "c": F.col("huge")})
    for value, tile in (("fine", "a"), ("huge", "c")):
        expected = df.withColumn("t", F.ntile(4).over(Window.orderBy(value, "id"))).select("id", "t").collect()
        assert {r["id"]: r[tile] for r in got.collect()} == {r["id"]: r["t"] for r in expected}


@pytest.mark.parametrize("n", [1, 2, 5, 10, 20, 40, 100, 200])
@pytest.mark.parametrize("share", [0.05, 0.5])
def test_exact_quantile(spark, n, share):
    values = [round(random.Random(n).gauss(0, 1), 2) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert exact_quantile(df, "v", share).first()[0] == pytest.approx(np.quantile(values, share), abs=1e-12)
    assert exact_quantile(df.limit(0), "v", share).first()[0] is None


@pytest.mark.parametrize("n", [5, 10, 20, 40, 100])
def test_forest_flags_below_the_interpolated_quantile(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(n)], "id int, a double, b double")
    rows = isolation_forest(df, ["id"], ["a", "b"], trees=10).collect()
    scores = [r["anomaly_score"] for r in rows]
    expected = sum(s < np.quantile(scores, 0.05) for s in scores)
    assert sum(r["isolation_forest_flag"] for r in rows) == expected > 0


def test_forest_has_one_sampling_scheme(spark):
    """A row's score depends on rows and parameters alone, also across the size of the samples."""
    df = spark.range(700).selectExpr("id", "CAST(id * id % 97 AS DOUBLE) AS a", "CAST(id % 89 AS DOUBLE) AS b")
    one, two = ({r["id"]: r["anomaly_score"] for r in isolation_forest(
        df.repartition(p), ["id"], ["a", "b"], trees=5, sample=32).collect()} for p in (1, 5))
    assert one == two


def test_mann_whitney_method(frame):
    df = frame("a boolean, v double", [(True, 1.0), (True, 4.0), (False, 2.0), (False, 3.0), (False, 9.0)])
    exact = mann_whitney(df, "v", F.col("a"), method="exact").first()["p_value"]
    assert exact == pytest.approx(exact_u_p(2.0, 2, 3))
    assert exact != mann_whitney(df, "v", F.col("a"), method="asymptotic").first()["p_value"]
    with pytest.raises(ValueError, match="method"):
        mann_whitney(df, "v", F.col("a"), method="guess")
    with pytest.raises(Exception, match="without ties"):
        mann_whitney(df.union(df), "v", F.col("a"), method="exact").collect()
