"""Evidence, alerts, narratives and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import decomposition, kpis  # noqa: F401  (define the SQL tables)
from harborline.catalog.ctes import define, with_ctes
from harborline.catalog.registry import query, rounded
from harborline.operators.storage import staged
from harborline.plans import evidence

PERIOD = decomposition.SQL_B  # alerts look at the latest month


def latest(ops) -> str:
    return decomposition.periods(ops)[1]


def percent_sql(value: str, digits: int) -> str:
    return f"printf('%.{digits}f%%', round_even(({value}) * 100, {digits}))"


def signed_sql(value: str, digits: int) -> str:
    return f"printf('%+.{digits}f', round_even({value}, {digits}))"


@query("m01_most_adverse_factor", with_ctes(rounded(
    "SELECT * FROM factors WHERE dimension_rank = 1", decomposition.NUMBERS)))
def most_adverse_factor(ops):
    """The most adverse factor of each dimension."""
    return evidence.most_adverse(decomposition.factors(ops))


SUPPLIER_NUMBERS = ("supplier_late_rate", "average_supplier_late_rate", "difference_from_average")
define("supplier_pick", """
SELECT * FROM kpi_supplier WHERE ROUND(difference_from_average, 12) > 0
ORDER BY ROUND(difference_from_average, 12) DESC, supplier_id LIMIT 1""")


@query("m02_supplier_evidence", with_ctes(rounded("SELECT * FROM supplier_pick", SUPPLIER_NUMBERS)))
def supplier_evidence(ops):
    """The supplier furthest above the mean late rate."""
    return evidence.supplier_evidence(ops)


define("group_shares", """
SELECT s.*, CAST(SUM(stockout_snapshots) OVER (PARTITION BY month) AS BIGINT) AS all_stockout_snapshots,
       COALESCE(CAST(stockout_snapshots AS DOUBLE) / NULLIF(SUM(stockout_snapshots) OVER (PARTITION BY month), 0), 0)
           AS share_of_stockouts,
       ROW_NUMBER() OVER (PARTITION BY month ORDER BY stockout_rate DESC, sku_group) AS place
FROM kpi_stockout AS s""")


@query("m03_stockout_evidence", with_ctes(rounded(
    f"SELECT * EXCLUDE (place) FROM group_shares WHERE place = 1 AND month = {PERIOD}",
    ("stockout_rate", "share_of_stockouts"))))
def stockout_evidence(ops):
    """The SKU group with the highest stock-out rate of the month."""
    return evidence.stockout_evidence(ops, latest(ops))


def fulfilment_alert_sql(limit: float) -> str:
    return f"""
SELECT 'low_fulfilment' AS alert_type, {PERIOD} AS period, 'all' AS key, value, {limit}::DOUBLE AS threshold,
       'Fulfilment of ' || {PERIOD} || ' was ' || {percent_sql("value", 1)} || ', under the limit of {limit:.0%}.' AS message
FROM (SELECT CAST(COUNT(*) FILTER (WHERE order_status = 'fulfilled') AS DOUBLE) / COUNT(*) AS value
      FROM ops_orders WHERE strftime(order_date, '%Y-%m') = {PERIOD}) AS r WHERE value < {limit}"""


def supplier_alert_sql(limit: float) -> str:
    return f"""
SELECT 'supplier_late_rate' AS alert_type, CAST(NULL AS VARCHAR) AS period, CAST(supplier_id AS VARCHAR) AS key,
       supplier_late_rate AS value, {limit}::DOUBLE AS threshold, supplier_name,
       average_supplier_late_rate AS average, difference_from_average AS gap,
       supplier_name || ' delivered late in ' || {percent_sql("supplier_late_rate", 1)} || ' of cases, '
           || {percent_sql("difference_from_average", 1)} || ' over the mean of all suppliers.' AS message
FROM kpi_supplier WHERE difference_from_average > {limit}"""


def stockout_alert_sql(limit: float) -> str:
    return f"""
SELECT 'high_stockout_rate' AS alert_type, {PERIOD} AS period, sku_group AS key, stockout_rate AS value,
       {limit}::DOUBLE AS threshold, stockout_snapshots, snapshot_count, 'SKU group ' || sku_group || ' was out of stock in '
           || {percent_sql("stockout_rate", 1)} || ' of snapshots of ' || {PERIOD} || ', over {limit:.0%}.' AS message
FROM kpi_stockout WHERE month = {PERIOD} AND stockout_rate > {limit}"""


# The test data is even, so the supplier and stock-out limits are lowered to get alerts.
LIMITS = {"low": 0.90, "gap": 0.01, "stockout": 0.05}
VALUES = ("value", "threshold")
WIDE = (*VALUES, "average", "gap")

query("m04_fulfilment_alert", with_ctes(rounded(fulfilment_alert_sql(LIMITS["low"]), VALUES)))(
    lambda ops: evidence.fulfilment_alert(ops, latest(ops), LIMITS["low"]))
query("m05_supplier_alerts", with_ctes(rounded(supplier_alert_sql(LIMITS["gap"]), WIDE)))(
    lambda ops: evidence.supplier_alerts(ops, LIMITS["gap"]))
query("m06_stockout_alerts", with_ctes(rounded(stockout_alert_sql(LIMITS["stockout"]), VALUES)))(
    lambda ops: evidence.stockout_alerts(ops, latest(ops), LIMITS["stockout"]))
query("m07_alerts", with_ctes(rounded(" UNION ALL BY NAME ".join((
    fulfilment_alert_sql(evidence.LOW_FULFILMENT), supplier_alert_sql(evidence.SUPPLIER_GAP),
    stockout_alert_sql(evidence.HIGH_STOCKOUT))), WIDE)))(
    lambda ops: evidence.alerts(ops, latest(ops)))

define("period_pairs", """
SELECT * FROM (
    SELECT LAG(month) OVER (ORDER BY month) AS period_a, month AS period_b,
           CAST(LAG(total_orders) OVER (ORDER BY month) AS DOUBLE) AS total_a, CAST(total_orders AS DOUBLE) AS total_b,
           CAST(LAG(fulfilled_orders) OVER (ORDER BY month) AS DOUBLE) AS hits_a,
           CAST(fulfilled_orders AS DOUBLE) AS hits_b
    FROM kpi_monthly_fulfilment
) AS p WHERE period_a IS NOT NULL""")
define("warehouse_months", """
SELECT strftime(order_date, '%Y-%m') AS month, warehouse_id, CAST(COUNT(*) AS DOUBLE) AS n,
       CAST(COUNT(*) FILTER (WHERE order_status = 'fulfilled') AS DOUBLE) AS hits FROM ops_orders GROUP BY 1, 2""")
define("warehouse_picks", """
SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY period_a, period_b ORDER BY ROUND(contribution_pp, 10), warehouse) AS place
    FROM (
        SELECT p.period_a, p.period_b, CAST(w.warehouse_id AS VARCHAR) AS warehouse,
               COALESCE(a.hits / a.n, 0) AS rate_a, COALESCE(b.hits / b.n, 0) AS rate_b,
               (COALESCE(b.hits, 0) / p.total_b - COALESCE(a.hits, 0) / p.total_a) * 100 AS contribution_pp,
               COALESCE((COALESCE(b.n, 0) - COALESCE(b.hits, 0)) / NULLIF(p.total_b - p.hits_b, 0), 0) AS share
        FROM period_pairs AS p CROSS JOIN ops_warehouses AS w
        LEFT JOIN warehouse_months AS a ON a.month = p.period_a AND a.warehouse_id = w.warehouse_id
        LEFT JOIN warehouse_months AS b ON b.month = p.period_b AND b.warehouse_id = w.warehouse_id
        WHERE a.n IS NOT NULL OR b.n IS NOT NULL
    ) AS c
) AS r WHERE place = 1""")
define("evidence_facts", f"""
SELECT 'fulfilment' AS kpi, p.period_a, p.period_b, {percent_sql("p.hits_a / p.total_a", 2)} AS value_a,
       {percent_sql("p.hits_b / p.total_b", 2)} AS value_b,
       {signed_sql("(p.hits_b / p.total_b - p.hits_a / p.total_a) * 100", 2)} AS change_pp,
       CAST(sign(ROUND(p.hits_b / p.total_b - p.hits_a / p.total_a, 12)) AS BIGINT) AS direction,
       w.warehouse, {percent_sql("w.rate_a", 2)} AS warehouse_rate_a, {percent_sql("w.rate_b", 2)} AS warehouse_rate_b,
       {signed_sql("w.contribution_pp", 2)} AS warehouse_contribution_pp,
       {percent_sql("w.share", 1)} AS warehouse_share_of_unfulfilled,
       CAST(s.supplier_id AS VARCHAR) AS supplier, {percent_sql("s.supplier_late_rate", 1)} AS supplier_late_rate,
       {percent_sql("s.average_supplier_late_rate", 1)} AS supplier_average,
       {signed_sql("s.difference_from_average * 100", 2)} AS supplier_gap_pp,
       g.sku_group, {percent_sql("g.stockout_rate", 1)} AS stockout_rate,
       CAST(g.stockout_snapshots AS VARCHAR) AS stockout_snapshots, CAST(g.snapshot_count AS VARCHAR) AS snapshot_count,
       CAST(g.all_stockout_snapshots AS VARCHAR) AS all_stockout_snapshots,
       {percent_sql("g.share_of_stockouts", 1)} AS share_of_stockouts
FROM period_pairs AS p
JOIN warehouse_picks AS w ON w.period_a = p.period_a AND w.period_b = p.period_b
JOIN group_shares AS g ON g.month = p.period_b AND g.place = 1
LEFT JOIN supplier_pick AS s ON TRUE""")
define("narratives", """
SELECT *, concat_ws(chr(10),
    'Finding: Fulfilment ' || CASE WHEN direction < 0 THEN 'fell' WHEN direction > 0 THEN 'rose' ELSE 'stayed' END
        || ' from ' || value_a || ' in ' || period_a || ' to ' || value_b || ' in ' || period_b || ', a change of '
        || change_pp || ' percentage points.',
    'Evidence:',
    '- Warehouse ' || warehouse || ' went from ' || warehouse_rate_a || ' to ' || warehouse_rate_b
        || ' and contributed ' || warehouse_contribution_pp || ' pp; it holds ' || warehouse_share_of_unfulfilled
        || ' of unfulfilled orders.',
    COALESCE('- Supplier ' || supplier || ' was late in ' || supplier_late_rate || ' of deliveries against a mean of '
        || supplier_average || ' over suppliers, a gap of ' || supplier_gap_pp || ' percentage points.',
        '- No supplier was late more often, none is above the all-supplier average.'),
    '- SKU group ' || sku_group || ' was out of stock in ' || stockout_rate || ' of its snapshots ('
        || stockout_snapshots || ' of ' || snapshot_count || '), which is ' || share_of_stockouts || ' of all '
        || all_stockout_snapshots || ' stock-out snapshots.',
    'Recommendation:',
    COALESCE('- Inspect the process of warehouse ' || warehouse || ' and the late deliveries of supplier ' || supplier || '.',
        '- Inspect the process of warehouse ' || warehouse || ' and keep watching the suppliers.'),
    '- Check replenishment of SKU group ' || sku_group || '.') AS answer
FROM evidence_facts""")


@query("m08_narratives", with_ctes("SELECT * FROM narratives"))
def narratives(ops):
    """Facts and narrative of every consecutive month pair."""
    return evidence.narratives(evidence.evidence_facts(ops))


def tokens_sql(text: str) -> str:
    """Distinct numbers of a text; the letter before a number is cut off first."""
    cut = f"regexp_replace({text}, '([A-Za-z])[-+\\p{{Nd}}]', '\\1 ', 'g')"
    return (f"list_distinct(list_transform(regexp_extract_all({cut}, "
            f"'[-+]?(?:\\p{{Nd}}{{1,3}}(?:,\\p{{Nd}}{{3}})+|\\p{{Nd}}+)(?:\\.\\p{{Nd}}+)?'), "
            f"lambda t: ltrim(replace(t, ',', ''), '+')))")


@query("m09_grounding_audit", with_ctes(f"""
SELECT a.conv_id, a.turn, len({tokens_sql("a.text")}) AS numbers,
       array_to_string(list_sort(list_filter({tokens_sql("a.text")},
           lambda t: NOT list_contains({tokens_sql("COALESCE(f.text, '')")}, t))), ' ') AS unsupported
FROM conversations AS a LEFT JOIN conversations AS f ON f.conv_id = a.conv_id AND f.turn = a.turn - 1
WHERE a.role = 'assistant'"""))
def grounding_audit(ops):
    """Numbers in an assistant turn that the turn before it does not contain."""
    turns = ops.source("conversations")
    facts = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("facts"))
    answers = turns.filter(F.col("role") == "assistant").join(facts, ["conv_id", "turn"], "left")
    known = F.coalesce("facts", F.lit(""))
    return answers.select(
        "conv_id", "turn", F.size(evidence.number_tokens("text")).alias("numbers"),
        F.array_join(evidence.unsupported_numbers("text", known), " ").alias("unsupported"),
    )


@query("m09_document_numbers", with_ctes(f"""
SELECT doc_id, len({tokens_sql("text")}) AS numbers, array_to_string(list_sort({tokens_sql("text")}), ' ') AS tokens
FROM documents"""))
def document_numbers(ops):
    """Distinct numbers written in each document."""
    found = F.array_sort(evidence.number_tokens("text"))
    return ops.source("documents").select(
        "doc_id", F.size(found).alias("numbers"), F.array_join(found, " ").alias("tokens"))


HEAD = "starts_with(x, 'Finding:') OR starts_with(x, 'Evidence:') OR starts_with(x, 'Recommendation:')"


@query("m10_structure_audit", with_ctes(f"""
SELECT doc_id, concat_ws(' ', CASE WHEN NOT in_order THEN 'headings' END,
       CASE WHEN in_order AND NOT said THEN 'empty_finding' END,
       CASE WHEN bullets <> 3 THEN 'evidence_count' END,
       CASE WHEN advice NOT BETWEEN 1 AND 2 THEN 'recommendation_count' END) AS errors
FROM (
    SELECT doc_id, list_transform(heads, lambda x: split_part(x, ':', 1)) = ['Finding', 'Evidence', 'Recommendation'] AS in_order,
           COALESCE(length(trim(substr(heads[1], 9))) > 0, FALSE) AS said,
           CASE WHEN len(heads) = 3 THEN len(list_filter(lines[pos[2] + 1:pos[3] - 1], lambda x: starts_with(x, '- '))) ELSE 0 END AS bullets,
           CASE WHEN len(heads) = 3 THEN len(list_filter(lines[pos[3] + 1:], lambda x: starts_with(x, '- '))) ELSE 0 END AS advice
    FROM (
        SELECT doc_id, lines, list_filter(lines, lambda x: {HEAD}) AS heads,
               list_filter(range(1, len(lines) + 1), lambda i: list_contains(list_filter(lines, lambda x: {HEAD}), lines[i])) AS pos
        FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[\\n\\r]+'), lambda x: trim(x)),
                                         lambda x: x <> '') AS lines FROM documents) AS l
    ) AS h
) AS s"""))
def structure_audit(ops):
    """Structural rules of an answer that each document breaks."""
    checked = evidence.with_structure(ops.source("documents"), "text")
    return checked.select("doc_id", F.array_join(evidence.structure_errors(), " ").alias("errors"))


def _has(line: str, *names: str) -> str:
    return " AND ".join(f"contains({line}, {name})" for name in names)


FACTS_TEXT = """concat_ws(' ', kpi, period_a, period_b, value_a, value_b, change_pp, warehouse, warehouse_rate_a, warehouse_rate_b,
    warehouse_contribution_pp, warehouse_share_of_unfulfilled, supplier, supplier_late_rate, supplier_average, supplier_gap_pp,
    sku_group, stockout_rate, stockout_snapshots, snapshot_count, all_stockout_snapshots, share_of_stockouts)"""


def audit_sql(answered: str) -> str:
    """Rules that the answers of ``answered`` break against the facts of the same row, and numbers without a fact."""
    supplier = _has("l[4]", "'percentage points'", "supplier", "supplier_late_rate", "supplier_average", "supplier_gap_pp")
    group = _has("l[5]", "'stock-out snapshots'", "'all'", "sku_group", "stockout_rate", "stockout_snapshots",
                 "snapshot_count", "share_of_stockouts", "all_stockout_snapshots")
    return f"""
SELECT period_a, period_b, unsupported, concat_ws(' ',
       CASE WHEN NOT (starts_with(l[1], 'Finding:') AND l[2] = 'Evidence:' AND l[6] = 'Recommendation:') THEN 'headings' END,
       CASE WHEN NOT (starts_with(l[3], '- Warehouse ') AND starts_with(l[5], '- SKU group ')) THEN 'evidence_order' END,
       CASE WHEN len(l) NOT BETWEEN 7 AND 8 THEN 'recommendation_count' END,
       CASE WHEN supplier IS NOT NULL AND NOT (starts_with(l[4], '- Supplier ') AND {supplier})
              OR supplier IS NULL AND NOT (starts_with(l[4], '- No supplier ')
                                           AND contains(l[4], 'above the all-supplier average')) THEN 'supplier_evidence' END,
       CASE WHEN NOT (starts_with(l[5], '- SKU group ') AND {group}) THEN 'sku_group_evidence' END,
       CASE WHEN len(list_filter(l[7:], lambda x: contains(x, 'SKU group ' || sku_group))) = 0 THEN 'recommendation_group' END,
       CASE WHEN unsupported <> '' THEN 'unsupported_numbers' END) AS errors
FROM (
    SELECT *, string_split(answer, chr(10)) AS l,
           array_to_string(list_sort(list_filter({tokens_sql("answer")},
               lambda t: NOT list_contains({tokens_sql(FACTS_TEXT)}, t))), ' ') AS unsupported
    FROM ({answered}) AS a
) AS t"""


def _audited(facts, answered):
    """The audit of ``answered``, whose fact columns are those of ``facts``."""
    unsupported = evidence.unsupported_numbers("answer", evidence.facts_text(facts))
    return evidence.audit_answers(answered).select(
        "period_a", "period_b", F.array_join(unsupported, " ").alias("unsupported"),
        F.array_join("errors", " ").alias("errors"))


@query("m10_narrative_audit", with_ctes(audit_sql("SELECT * FROM narratives")))
def narrative_audit(ops):
    """The audit of every narrative against its own facts."""
    facts = evidence.evidence_facts(ops)
    return _audited(facts, evidence.narratives(facts))


@query("m10_outdated_narratives", with_ctes(audit_sql(
    "SELECT f.*, n.answer FROM evidence_facts AS f JOIN narratives AS n ON n.period_b = f.period_a")))
def outdated_narratives(ops):
    """What the audit finds when the narrative of one month pair is handed in for the next pair."""
    facts = staged(evidence.evidence_facts(ops), "facts")
    earlier = evidence.narratives(facts).select(F.col("period_b").alias("_until"), "answer")
    return _audited(facts, facts.join(earlier, facts["period_a"] == F.col("_until")).drop("_until"))
