"""Features, anomalies, segmentation and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog.ctes import define, with_ctes
from harborline.catalog.registry import query, rounded
from harborline.operators import clustering, hypothesis
from harborline.operators.storage import staged
from harborline.plans import features, segments

WAREHOUSE = 3  # compared with all others


def erfc_sql(z: str) -> str:
    """The complementary error function as an integral, by Simpson's rule over ten units."""
    panels, step = 2000, 0.005
    weight = f"CASE WHEN i = 0 OR i = {panels} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    point = f"(({z}) + i * {step}::DOUBLE)"
    return (f"(list_sum(list_transform(range({panels + 1}), lambda i: {weight} * exp(-{point} * {point})))"
            f" * {step}::DOUBLE / 3 * 2 / sqrt(pi()))")


define("features", """
SELECT o.*, d.supplier_id, d.shipped_date, d.delivered_date, d.promised_delivery_date, d.supplier_late,
       r.supplier_late_rate, CAST(d.shipped_date - o.order_date AS DOUBLE) AS processing_days,
       d.delivered_date IS NULL OR d.delivered_date > d.promised_delivery_date AS is_late,
       CAST(d.delivered_date - d.promised_delivery_date AS DOUBLE) AS lead_time_gap,
       isodow(o.order_date) AS weekday, month(o.order_date) AS month,
       COUNT(*) OVER (PARTITION BY o.warehouse_id, o.order_date) AS warehouse_load
FROM ops_orders AS o
LEFT JOIN (
    SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY shipped_date NULLS LAST, delivery_id) AS rn
        FROM ops_deliveries
    ) AS n WHERE rn = 1
) AS d ON d.order_id = o.order_id
LEFT JOIN (
    SELECT supplier_id, AVG(CAST(supplier_late AS INT)) AS supplier_late_rate FROM ops_deliveries GROUP BY 1
) AS r ON r.supplier_id = d.supplier_id""")
define("outliers", """
SELECT f.*, COALESCE(processing_days < q1 - 1.5 * (q3 - q1) OR processing_days > q3 + 1.5 * (q3 - q1), FALSE)
           AS iqr_flag,
       CASE WHEN sd = 0 THEN 0 ELSE (processing_days - mean) / sd END AS z_score,
       COALESCE(abs(CASE WHEN sd = 0 THEN 0 ELSE (processing_days - mean) / sd END) > 3, FALSE) AS z_score_flag
FROM features AS f, (SELECT quantile_cont(processing_days, 0.25) AS q1, quantile_cont(processing_days, 0.75) AS q3,
                            AVG(processing_days) AS mean, stddev_pop(processing_days) AS sd FROM features) AS p""")
define("days", """
SELECT warehouse_id, order_date AS "date", COUNT(order_id) AS warehouse_load,
       AVG(processing_days) AS processing_days, AVG(CAST(is_late AS INT)) AS late_rate
FROM features GROUP BY 1, 2""")


@query("k01_order_features", with_ctes(rounded(
    "SELECT * FROM features", ("supplier_late_rate", "processing_days", "lead_time_gap"))))
def order_features(ops):
    """One feature row per order."""
    return features.order_features(ops)


def stored_features(ops):
    return staged(features.order_features(ops), "features")


@query("k02_iqr_outliers", with_ctes("SELECT order_id, iqr_flag FROM outliers"))
def iqr_outliers(ops):
    """Orders outside the interquartile fences."""
    return features.processing_outliers(stored_features(ops)).select("order_id", "iqr_flag")


@query("k03_z_scores", with_ctes(rounded("SELECT order_id, z_score, z_score_flag FROM outliers", ("z_score",))))
def z_scores(ops):
    """Standard score of the processing days of every order."""
    return features.processing_outliers(stored_features(ops)).select("order_id", "z_score", "z_score_flag")


ORDER_ANOMALIES = """
SELECT 'order_processing_time' AS anomaly_type, order_id, warehouse_id, order_date AS "date", processing_days,
       warehouse_load, CAST(is_late AS DOUBLE) AS late_rate, iqr_flag, z_score_flag,
       FALSE AS isolation_forest_flag, z_score AS anomaly_score
FROM outliers WHERE iqr_flag OR z_score_flag"""


@query("k04_order_anomalies", with_ctes(rounded(ORDER_ANOMALIES, ("processing_days", "late_rate", "anomaly_score"))))
def order_anomalies(ops):
    """Orders with an unusual processing time; a tight limit lets some through."""
    return features.order_anomalies(stored_features(ops))


@query("k04_order_anomalies_tight", with_ctes(rounded("""
SELECT order_id, processing_days, z_score AS anomaly_score
FROM (SELECT f.*, (processing_days - mean) / sd AS z_score,
             processing_days < q1 - 0.5 * (q3 - q1) OR processing_days > q3 + 0.5 * (q3 - q1) AS fenced
      FROM features AS f, (SELECT quantile_cont(processing_days, 0.25) AS q1, quantile_cont(processing_days, 0.75) AS q3,
                           AVG(processing_days) AS mean, stddev_pop(processing_days) AS sd FROM features) AS p) AS s
WHERE fenced OR abs(z_score) > 1.5""", ("processing_days", "anomaly_score"))))
def order_anomalies_tight(ops):
    """The same with half-width fences and a z limit of 1.5."""
    found = features.order_anomalies(stored_features(ops), fence=0.5, z_limit=1.5)
    return found.select("order_id", "processing_days", "anomaly_score")


@query("k05_warehouse_days", with_ctes(rounded("SELECT * FROM days", ("processing_days", "late_rate"))))
def warehouse_days(ops):
    """Load, mean processing days and late share per warehouse and day."""
    return features.warehouse_days(features.order_features(ops))


define("forest_rows", """
SELECT row_number() OVER () AS rid, warehouse_id, "date", warehouse_load, processing_days, late_rate,
       CAST(warehouse_id AS VARCHAR) || '|' || CAST("date" AS VARCHAR) AS row_key,
       CAST(warehouse_load AS DOUBLE) AS x1, CAST(processing_days AS DOUBLE) AS x2, CAST(late_rate AS DOUBLE) AS x3
FROM days WHERE processing_days IS NOT NULL""", stored=True)
define("forest_size", """
SELECT LEAST(256, COUNT(*)) AS sample, CAST(GREATEST(1, ceil(log2(LEAST(256, COUNT(*))))) AS INT) AS deep
FROM forest_rows""", stored=True)
define("forest_members", """
SELECT tree, rid, row_number() OVER (PARTITION BY tree ORDER BY h, row_key) <= (SELECT sample FROM forest_size) AS sampled
FROM (SELECT tree, rid, row_key, CAST('0x' || md5('42:' || tree || ':row:' || row_key)[1:13] AS BIGINT) AS h
      FROM forest_rows, range(100) AS t(tree)) AS drawn""", stored=True)


def path_sql(n: str) -> str:
    """Mean depth of an unsuccessful search among n keys."""
    return (f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE ELSE 2::DOUBLE * (ln({n} - 1) "
            f"+ 0.5772156649015329::DOUBLE) - 2::DOUBLE * ({n} - 1) / {n} END")


def node_draw_sql(what: str) -> str:
    return f"CAST('0x' || md5('42:' || tree || ':' || node || ':{what}')[1:13] AS BIGINT)::DOUBLE / 4503599627370496::DOUBLE"


# All rows walk down all trees together; the sampled ones among those at a node decide its split.
define("forest_walk", f"""
SELECT tree, rid, sampled, 0::BIGINT AS node, 0 AS depth, NULL::BIGINT AS path FROM forest_members
UNION ALL
SELECT w.tree, w.rid, w.sampled,
       CASE WHEN feature IS NULL THEN w.node WHEN (CASE feature WHEN 1 THEN x1 WHEN 2 THEN x2 ELSE x3 END) <= cut
            THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END,
       w.depth + 1, CASE WHEN feature IS NULL THEN CAST(round((w.depth + ({path_sql("n")})) * 4294967296::DOUBLE) AS BIGINT) END
FROM forest_walk AS w JOIN forest_rows AS r ON r.rid = w.rid JOIN (
    SELECT tree, node, n, feature, CASE WHEN lows[feature] + u * (highs[feature] - lows[feature]) >= highs[feature]
                                        THEN lows[feature] ELSE lows[feature] + u * (highs[feature] - lows[feature]) END AS cut
    FROM (SELECT tree, node, n, lows, highs, {node_draw_sql("cut")} AS u,
                 CASE WHEN depth < (SELECT deep FROM forest_size) AND n > 1 THEN usable[CAST(floor({node_draw_sql("feature")}
                      * len(usable)) AS INT) + 1] END AS feature
          FROM (SELECT *, list_filter([1, 2, 3], lambda i: highs[i] > lows[i]) AS usable
                FROM (SELECT tree, node, MAX(depth) AS depth, COUNT(*) AS n, [MIN(x1), MIN(x2), MIN(x3)] AS lows,
                             [MAX(x1), MAX(x2), MAX(x3)] AS highs
                      FROM forest_walk JOIN forest_rows ON forest_rows.rid = forest_walk.rid
                      WHERE sampled AND path IS NULL GROUP BY tree, node) AS seen) AS able) AS split
) AS s ON s.tree = w.tree AND s.node = w.node
WHERE w.path IS NULL""")
define("forest_scores", f"""
SELECT rid, -pow(2::DOUBLE, -SUM(path)::DOUBLE / 4294967296::DOUBLE / 100 / (SELECT {path_sql("sample")} FROM forest_size))
       AS anomaly_score FROM forest_walk WHERE path IS NOT NULL GROUP BY rid""", stored=True)
define("day_anomalies", """
SELECT 'warehouse_day' AS anomaly_type, warehouse_id, "date", processing_days, warehouse_load, late_rate,
       FALSE AS iqr_flag, FALSE AS z_score_flag, TRUE AS isolation_forest_flag, anomaly_score
FROM forest_rows JOIN forest_scores ON forest_scores.rid = forest_rows.rid
WHERE anomaly_score < (SELECT quantile_cont(anomaly_score, 0.05) FROM forest_scores)
  AND (SELECT COUNT(*) FROM forest_rows) >= 5""", stored=True)
define("all_anomalies", f"""
{ORDER_ANOMALIES}
UNION ALL BY NAME
SELECT *, NULL::BIGINT AS order_id FROM day_anomalies""")


@query("k06_isolation_forest", with_ctes(rounded("SELECT * FROM day_anomalies", ("processing_days", "late_rate", "anomaly_score"))))
def isolation_forest(ops):
    """Unusual warehouse-days."""
    return features.warehouse_day_anomalies(stored_features(ops))


@query("k07_anomalies", with_ctes(rounded("SELECT * FROM all_anomalies", ("processing_days", "late_rate", "anomaly_score"))))
def anomalies(ops):
    """Order and warehouse-day anomalies in one relation."""
    return features.anomalies(stored_features(ops))


define("rfm_base", """
SELECT c.customer_id, c.customer_name,
       COALESCE(CAST((SELECT MAX(order_date) FROM ops_orders WHERE order_status = 'fulfilled') - v.last_order AS DOUBLE),
                99999) AS recency_days,
       COALESCE(v.frequency, 0) AS frequency, COALESCE(CAST(v.monetary AS DOUBLE), 0) AS monetary
FROM ops_customers AS c
LEFT JOIN (
    SELECT o.customer_id, MAX(o.order_date) AS last_order, COUNT(DISTINCT o.order_id) AS frequency,
           SUM(i.value) AS monetary
    FROM ops_orders AS o
    LEFT JOIN (SELECT order_id, SUM(quantity * unit_price) AS value FROM ops_order_items GROUP BY 1) AS i
        ON i.order_id = o.order_id
    WHERE o.order_status = 'fulfilled' GROUP BY 1
) AS v ON v.customer_id = c.customer_id""")
define("months", """
SELECT m, ROW_NUMBER() OVER (ORDER BY m) AS pos, COUNT(*) OVER () AS n,
       GREATEST(1, COUNT(*) OVER () // 2) AS split
FROM (SELECT DISTINCT date_trunc('month', order_date) AS m FROM ops_orders) AS d""")


def decline_sql(missing: str) -> str:
    return f"""
SELECT c.customer_id, LEAST(1, GREATEST(0, COALESCE({missing}, 0))) AS frequency_decline_score
FROM ops_customers AS c
LEFT JOIN (
    SELECT o.customer_id, COUNT(*) FILTER (WHERE pos <= split) AS early, COUNT(*) FILTER (WHERE pos > split) AS recent,
           CAST(COUNT(*) FILTER (WHERE pos <= split) AS DOUBLE) / MAX(split) AS early_avg,
           CAST(COUNT(*) FILTER (WHERE pos > split) AS DOUBLE) / MAX(n - split) AS recent_avg
    FROM ops_orders AS o JOIN months ON m = date_trunc('month', o.order_date) GROUP BY 1
) AS h ON h.customer_id = c.customer_id"""


DECLINE = "GREATEST(early_avg - recent_avg, 0) / GREATEST(early_avg, 1)"
define("decline", decline_sql(f"CASE WHEN early > 0 AND recent > 0 THEN {DECLINE} END"))
define("tickets", """
SELECT c.customer_id, COUNT(t.ticket_id) AS ticket_count
FROM ops_customers AS c LEFT JOIN ops_support_tickets AS t ON t.customer_id = c.customer_id GROUP BY 1""")
define("ticket_ranks", """
SELECT customer_id, ticket_count,
       (RANK() OVER (ORDER BY ticket_count) + (COUNT(*) OVER (PARTITION BY ticket_count) - 1) / 2.0::DOUBLE)
           / COUNT(*) OVER () AS ticket_percentile
FROM tickets""")
define("churn", """
SELECT d.customer_id, frequency_decline_score, ticket_count, ticket_percentile,
       LEAST(1, GREATEST(0, 0.6::DOUBLE * frequency_decline_score + 0.4::DOUBLE * ticket_percentile)) AS churn_risk_score
FROM decline AS d JOIN ticket_ranks AS t ON t.customer_id = d.customer_id""")

query("k09_customer_rfm", with_ctes(rounded("SELECT * FROM rfm_base", ("recency_days", "monetary"))))(
    segments.customer_rfm)
query("k10_frequency_decline", with_ctes(rounded("SELECT * FROM decline", ("frequency_decline_score",))))(
    segments.frequency_decline)
query("k10_frequency_decline_missing_as_zero", with_ctes(rounded(decline_sql(DECLINE), ("frequency_decline_score",))))(
    lambda ops: segments.frequency_decline(ops, treat_missing_as_zero=True))
query("k11_ticket_counts", with_ctes("SELECT * FROM tickets"))(segments.ticket_counts)
query("k12_ticket_percentile", with_ctes(rounded("SELECT * FROM ticket_ranks", ("ticket_percentile",))))(
    lambda ops: segments.ticket_percentile(segments.ticket_counts(ops)))
query("k13_churn_risk", with_ctes(rounded(
    "SELECT * FROM churn", ("frequency_decline_score", "ticket_percentile", "churn_risk_score"))))(
    segments.churn_risk)

SCALED = ("scaled_recency", "scaled_frequency", "scaled_monetary")
define("scaled_rfm", """
SELECT customer_id, (-recency_days - AVG(-recency_days) OVER ()) / NULLIF(stddev_pop(recency_days) OVER (), 0) AS scaled_recency,
       (frequency - AVG(frequency) OVER ()) / NULLIF(stddev_pop(frequency) OVER (), 0) AS scaled_frequency,
       (monetary - AVG(monetary) OVER ()) / NULLIF(stddev_pop(monetary) OVER (), 0) AS scaled_monetary
FROM rfm_base""")


def scaled(ops):
    rfm = staged(segments.customer_rfm(ops), "rfm")
    return clustering.standardise(rfm, {
        "scaled_recency": -F.col("recency_days"), "scaled_frequency": F.col("frequency").cast("double"),
        "scaled_monetary": F.col("monetary"),
    })


@query("k14_standardised_rfm", with_ctes(rounded("SELECT * FROM scaled_rfm", SCALED)))
def standardised_rfm(ops):
    """RFM with zero mean and unit variance, recency negated."""
    return scaled(ops).select("customer_id", *SCALED)


@query("k15_effective_k", with_ctes("""
SELECT LEAST(4, (SELECT COUNT(*) FROM (SELECT DISTINCT ROUND(scaled_recency, 12), ROUND(scaled_frequency, 12),
                                       ROUND(scaled_monetary, 12) FROM scaled_rfm) AS d)) AS effective_k"""))
def effective_k(ops):
    """Number of clusters the data allows, at most four."""
    return clustering.distinct_points(scaled(ops), SCALED, 4).agg(F.count(F.lit(1)).alias("effective_k"))


define("grid", """
SELECT CAST(round(scaled_recency * 65536) AS BIGINT) AS q1, CAST(round(scaled_frequency * 65536) AS BIGINT) AS q2,
       CAST(round(scaled_monetary * 65536) AS BIGINT) AS q3, COUNT(*) AS weight
FROM scaled_rfm GROUP BY 1, 2, 3""", stored=True)


def distances_sql(centers: str) -> str:
    """Squared distances of a grid point to a list of centres."""
    gap = lambda i: f"CAST(q{i} - c[{i}] AS DOUBLE) * CAST(q{i} - c[{i}] AS DOUBLE)"
    return f"list_transform({centers}, lambda c: {gap(1)} + {gap(2)} + {gap(3)})"


def race_sql(place: str, far: str) -> str:
    """Time at which a point wins a place among the first centres."""
    key = f"'42:' || run || ':' || {place} || ':' || q1 || ':' || q2 || ':' || q3"
    return f"(-ln((CAST('0x' || md5({key})[1:13] AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / (weight::DOUBLE * {far}))"


def mean_sql(place: int) -> str:
    """Centre number ``place`` after a step: means rounded to whole numbers, by a division of positive ones."""
    shift = 1 << 40
    own = f"FILTER (WHERE a = {place})"
    mean = lambda i: (f"CAST((2 * SUM(weight::HUGEINT * q{i}) {own} + SUM(weight) {own} + 2 * SUM(weight)::HUGEINT {own} * {shift})"  # noqa: E731
                      f" // (2 * SUM(weight)::HUGEINT {own}) - {shift} AS BIGINT)").replace("::HUGEINT FILTER", " FILTER")
    return f"CASE WHEN COUNT(*) {own} > 0 THEN [{mean(1)}, {mean(2)}, {mean(3)}] ELSE any_value(centers)[{place}] END"


define("first_centers", f"""
SELECT run, 1 AS places, [arg_min([q1, q2, q3], ({race_sql("0", "1::DOUBLE")}, q1, q2, q3))] AS centers
FROM grid, range(10) AS t(run) GROUP BY run
UNION ALL
SELECT run, places + 1, list_append(any_value(centers), arg_min([q1, q2, q3], ({race_sql("places", "far")}, q1, q2, q3)))
FROM (SELECT run, places, centers, q1, q2, q3, weight, list_min({distances_sql("centers")}) AS far
      FROM first_centers, grid WHERE places < 4) AS d
WHERE far > 0 GROUP BY run, places""")
define("steps", f"""
SELECT run, 0 AS step, arg_max(centers, places) AS centers, FALSE AS still FROM first_centers GROUP BY run
UNION ALL
SELECT run, step + 1, moved, moved = centers
FROM (SELECT run, step, any_value(centers) AS centers, [{", ".join(map(mean_sql, range(1, 5)))}][1:len(any_value(centers))] AS moved
      FROM (SELECT *, list_position(ds, list_min(ds)) AS a
            FROM (SELECT run, step, centers, q1, q2, q3, weight, {distances_sql("centers")} AS ds
                  FROM steps, grid WHERE NOT still AND step < 300) AS d) AS near
      GROUP BY run, step) AS m""")
define("best_centers", f"""
SELECT arg_min(centers, (cost, run)) AS centers FROM (
    SELECT run, any_value(centers) AS centers, SUM(weight * CAST(list_min({distances_sql("centers")}) AS HUGEINT)) AS cost
    FROM (SELECT run, arg_max(centers, step) AS centers FROM steps GROUP BY run) AS last, grid GROUP BY run) AS c""", stored=True)
define("clusters", f"""
SELECT r.*, list_position(ds, list_min(ds)) - 1 AS cluster_id
FROM rfm_base AS r JOIN (
    SELECT customer_id, {distances_sql("centers")} AS ds
    FROM (SELECT customer_id, CAST(round(scaled_recency * 65536) AS BIGINT) AS q1,
                 CAST(round(scaled_frequency * 65536) AS BIGINT) AS q2,
                 CAST(round(scaled_monetary * 65536) AS BIGINT) AS q3 FROM scaled_rfm) AS p, best_centers
) AS d ON d.customer_id = r.customer_id""", stored=True)


def labels_sql(clustered: str) -> str:
    """Label of every cluster of a table with RFM columns and ``cluster_id``."""
    return f"""
    SELECT cluster_id, CASE WHEN cluster_id = champion THEN 'Champions' WHEN cluster_id = lost THEN 'Lost'
                            WHEN ROW_NUMBER() OVER (ORDER BY cluster_id IN (champion, lost), f - r DESC, cluster_id) = 1
                            THEN 'Loyal' ELSE 'At Risk' END AS label
    FROM (
        SELECT *, FIRST_VALUE(cluster_id) OVER (ORDER BY cluster_id = champion, f + m - r, cluster_id) AS lost
        FROM (SELECT *, FIRST_VALUE(cluster_id) OVER (ORDER BY f + m - r DESC, cluster_id) AS champion
              FROM (SELECT cluster_id,
                           (r - AVG(r) OVER ()) / COALESCE(NULLIF(stddev_pop(r) OVER (), 0), 1) AS r,
                           (f - AVG(f) OVER ()) / COALESCE(NULLIF(stddev_pop(f) OVER (), 0), 1) AS f,
                           (m - AVG(m) OVER ()) / COALESCE(NULLIF(stddev_pop(m) OVER (), 0), 1) AS m
                    FROM (SELECT cluster_id, AVG(recency_days) AS r, AVG(frequency) AS f,
                                 AVG(monetary) AS m FROM {clustered} GROUP BY 1) AS means) AS profile) AS c) AS l"""


define("segments", f"""
SELECT c.*, label AS segment_label, frequency_decline_score, ticket_count, churn_risk_score
FROM clusters AS c JOIN ({labels_sql("clusters")}) AS labels ON labels.cluster_id = c.cluster_id
JOIN churn ON churn.customer_id = c.customer_id""")


@query("k16_customer_segments", with_ctes(rounded("SELECT * FROM segments", (
    "recency_days", "monetary", "frequency_decline_score", "churn_risk_score"))))
def customer_segments(ops):
    """k-means segments with churn risk."""
    return segments.customer_segments(ops)


@query("k17_cluster_labels", with_ctes(f"""
SELECT r.customer_id, r.customer_id % 5 AS cluster_id, label AS segment_label
FROM rfm_base AS r JOIN ({labels_sql("(SELECT *, customer_id % 5 AS cluster_id FROM rfm_base) AS given")}) AS labels
ON labels.cluster_id = r.customer_id % 5"""))
def cluster_labels(ops):
    """Labels of given clusters; here five classes of customer numbers."""
    rfm = segments.customer_rfm(ops).withColumn("cluster_id", F.col("customer_id") % 5)
    return clustering.label_clusters(rfm).select("customer_id", "cluster_id", "segment_label")


define("mann_whitney", f"""
SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, u, 2 * u / (n_a * n_b) - 1 AS cliffs_delta,
       LEAST(1, {erfc_sql("abs((GREATEST(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5::DOUBLE) / s) / sqrt(2.0::DOUBLE)")}) AS p_value
FROM (
    SELECT n_a, n_b, rank_sum - n_a * (n_a + 1) / 2 AS u,
           sqrt(n_a * n_b / 12 * (n_a + n_b + 1 - ties / ((n_a + n_b) * (n_a + n_b - 1)))) AS s
    FROM (SELECT CAST(COUNT(*) FILTER (WHERE a) AS DOUBLE) AS n_a, CAST(COUNT(*) FILTER (WHERE NOT a) AS DOUBLE) AS n_b,
                 SUM(CASE WHEN a THEN r ELSE 0 END) AS rank_sum, SUM(CAST(t AS DOUBLE) * t - 1) AS ties
          FROM (SELECT warehouse_id = {WAREHOUSE} AS a,
                       RANK() OVER (ORDER BY processing_days)
                           + (COUNT(*) OVER (PARTITION BY processing_days) - 1) / 2.0::DOUBLE AS r,
                       COUNT(*) OVER (PARTITION BY processing_days) AS t
                FROM features WHERE processing_days IS NOT NULL) AS ranked) AS sums) AS stats""")
define("chi_cells", "SELECT supplier_id, supplier_late, COUNT(*) AS observed FROM ops_deliveries GROUP BY 1, 2")
define("chi_square", """
SELECT SUM((COALESCE(o.observed, 0) - r.t * c.t / n) * (COALESCE(o.observed, 0) - r.t * c.t / n) / (r.t * c.t / n)) AS chi2,
       MAX(n) AS n, COUNT(DISTINCT r.supplier_id) AS n_rows, COUNT(DISTINCT c.supplier_late) AS n_columns
FROM (SELECT supplier_id, CAST(SUM(observed) AS DOUBLE) AS t FROM chi_cells GROUP BY 1) AS r
CROSS JOIN (SELECT supplier_late, CAST(SUM(observed) AS DOUBLE) AS t FROM chi_cells GROUP BY 1) AS c
CROSS JOIN (SELECT CAST(SUM(observed) AS DOUBLE) AS n FROM chi_cells) AS s
LEFT JOIN chi_cells AS o ON o.supplier_id = r.supplier_id AND o.supplier_late = c.supplier_late""")
TAIL = f"""CASE WHEN k % 2 = 1
    THEN {erfc_sql("sqrt(chi2 / 2)")} + COALESCE(list_sum(list_transform(range((k - 1) // 2),
         lambda j: exp(-chi2 / 2 + (j + 0.5) * ln(chi2 / 2) - lgamma(j + 1.5)))), 0)
    ELSE list_sum(list_transform(range(k // 2), lambda i: exp(-chi2 / 2 + i * ln(chi2 / 2) - lgamma(i + 1)))) END"""
define("chi_result", f"""
SELECT chi2, CAST(n AS BIGINT) AS n, n_rows, n_columns, {TAIL} AS p_value,
       sqrt(chi2 / (n * LEAST(n_rows - 1, n_columns - 1))) AS cramers_v
FROM (SELECT *, (n_rows - 1) * (n_columns - 1) AS k FROM chi_square) AS c""")


@query("k18_mann_whitney", with_ctes(rounded("SELECT n_a, n_b, u, p_value FROM mann_whitney", ("u", "p_value"))))
def mann_whitney(ops):
    """Processing days of one warehouse against the others."""
    rows = features.order_features(ops).filter(F.col("warehouse_id").isNotNull())
    return hypothesis.mann_whitney(rows, "processing_days", F.col("warehouse_id") == WAREHOUSE).select(
        "n_a", "n_b", "u", "p_value")


@query("k19_cliffs_delta", with_ctes(rounded("SELECT cliffs_delta FROM mann_whitney", ("cliffs_delta",))))
def cliffs_delta(ops):
    """Effect size of the comparison."""
    rows = features.order_features(ops).filter(F.col("warehouse_id").isNotNull())
    return hypothesis.mann_whitney(rows, "processing_days", F.col("warehouse_id") == WAREHOUSE).select("cliffs_delta")


@query("k20_chi_square", with_ctes(rounded(
    "SELECT chi2, n, n_rows, n_columns, p_value FROM chi_result", ("chi2", "p_value"))))
def chi_square(ops):
    """Independence of supplier and late delivery."""
    return hypothesis.chi_square(ops["supplier_marks"], "supplier_id", "supplier_late").drop("cramers_v")


@query("k21_cramers_v", with_ctes(rounded("SELECT cramers_v FROM chi_result", ("cramers_v",))))
def cramers_v(ops):
    """Strength of the association."""
    return hypothesis.chi_square(ops["supplier_marks"], "supplier_id", "supplier_late").select("cramers_v")


@query("k22_statistical_tests", with_ctes(rounded(f"""
SELECT 'warehouse_vs_other_processing_days' AS test_name, u AS statistic, p_value, cliffs_delta AS effect_size,
       'cliffs_delta' AS effect_measure, n_a + n_b AS sample_size, '{WAREHOUSE}' AS group_a, n_a AS group_a_n,
       'other_warehouses' AS group_b, n_b AS group_b_n FROM mann_whitney
UNION ALL
SELECT 'supplier_vs_late_delivery', chi2, p_value, cramers_v, 'cramers_v', n, 'all_suppliers', n_rows,
       'late_status', n_columns FROM chi_result""", ("statistic", "p_value", "effect_size"))))
def statistical_tests(ops):
    """Both tests in one relation."""
    return features.statistical_tests(features.order_features(ops), ops["supplier_marks"], WAREHOUSE)
