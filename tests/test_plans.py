"""KPIs, features, decomposition, evidence and measures on hand-made tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from harborline.plans import decompose, evidence, features, kpi, segments
from harborline.plans.measures import histogram, measure, share_of
from harborline.sources.calendar import calendar

ORDERS = "order_id string, customer_id string, warehouse_id string, employee_id string, order_date date, order_status string"
DELIVERIES = ("delivery_id string, order_id string, supplier_id string, warehouse_id string, shipped_date date, "
              "delivered_date date, promised_delivery_date date, supplier_late boolean, delivery_status string")
ITEMS = "order_id string, product_id string, quantity bigint, unit_price decimal(12,2)"
PRODUCTS = "product_id string, product_name string, sku_group string, category string, unit_price decimal(12,2)"
SNAPSHOTS = ("snapshot_id string, snapshot_date date, product_id string, warehouse_id string, supplier_id string, "
             "quantity_on_hand bigint, reorder_point bigint, stockout_flag boolean")


@pytest.fixture()
def tables(frame):
    """Operational tables out of rows; orders serve as headers as well."""
    def build(orders=(), deliveries=(), items=(), products=(), snapshots=(), customers=(), suppliers=(),
              warehouses=(), tickets=()):
        from decimal import Decimal

        made = {
            "orders": frame(ORDERS, [tuple(r) for r in orders]),
            "deliveries": frame(DELIVERIES, [tuple(r) for r in deliveries]),
            "order_items": frame(ITEMS, [(o, p, q, Decimal(u)) for o, p, q, u in items]),
            "products": frame(PRODUCTS, [(p, p, g, "c", Decimal("10")) for p, g in products]),
            "inventory_snapshots": frame(SNAPSHOTS, [tuple(r) for r in snapshots]),
            "customers": frame("customer_id string, customer_name string, customer_segment string, signup_date date",
                               [(c, c, "s", d) for c, d in customers]),
            "suppliers": frame("supplier_id string, supplier_name string", [(s, f"{s} Ltd") for s in suppliers]),
            "warehouses": frame("warehouse_id string, warehouse_name string, region string",
                                [(w, w, r) for w, r in warehouses]),
            "support_tickets": frame("ticket_id string, customer_id string", [tuple(r) for r in tickets]),
        }
        made["order_headers"] = made["orders"]
        return made

    return build


def order(key, day, status="fulfilled", customer="C1", warehouse="W1"):
    return (key, customer, warehouse, "E1", day, status)


def delivery(key, order_id, shipped, delivered=None, promised=None, supplier="S1", warehouse="W1", late=False):
    return (key, order_id, supplier, warehouse, shipped, delivered, promised or shipped + timedelta(days=5), late, "x")


D = date(2025, 1, 10)


def test_rfm_of_one_customer(tables):
    ops = tables(
        orders=[order("O1", date(2025, 1, 1)), order("O2", date(2025, 1, 9)), order("O3", date(2025, 2, 1), "unfulfilled")],
        items=[("O1", "P1", 1, "10"), ("O2", "P1", 2, "10"), ("O3", "P1", 9, "10")],
        customers=[("C1", D), ("C2", D)], products=[("P1", "g")],
        snapshots=[("N1", D, "P1", "W1", "S1", 4, 1, False)],
    )
    rows = {r["customer_id"]: r for r in kpi.customer_rfm(ops).collect()}
    assert (rows["C1"]["recency_days"], rows["C1"]["frequency"], rows["C1"]["monetary"]) == (0, 2, 30)
    assert (rows["C2"]["recency_days"], rows["C2"]["frequency"], rows["C2"]["monetary"]) == (99999, 0, 0)
    assert rows["C1"]["monetary_score"] == 1 and rows["C2"]["monetary_score"] == 2
    best = {r["customer_id"]: r["monetary_score"] for r in kpi.customer_rfm(ops, score_high_is_best=True).collect()}
    assert best == {"C1": 5, "C2": 4}
    sold = kpi.inventory_turnover(ops).first()
    assert (sold["units_sold"], sold["sales_value"], sold["inventory_turnover"]) == (3, 30, 0.75)


def test_idle_members_and_fan_out(tables):
    ops = tables(
        orders=[order("O1", D), order("O2", D, "unfulfilled")],
        deliveries=[delivery("D1", "O1", D + timedelta(days=1), D + timedelta(days=3)),
                    delivery("D2", "O1", D + timedelta(days=3), D + timedelta(days=30), late=True)],
        suppliers=["S1", "S2"], warehouses=[("W1", "R"), ("W9", "R")],
    )
    rows = {r["warehouse_id"]: r for r in kpi.warehouse_performance(ops).collect()}
    busy, idle = rows["W1"], rows["W9"]
    assert (busy["order_count"], busy["avg_processing_days"], busy["sla_breach_count"], busy["sla_breach_rate"]) == (3, 2.0, 2, 1.0)
    assert (idle["month"], idle["order_count"], idle["sla_breach_count"], idle["sla_breach_rate"]) == (None, 0, 1, None)
    ranking = kpi.warehouse_ranking(ops).first()
    assert (ranking["order_count"], ranking["avg_processing_days"], ranking["delay_rate"]) == (2, 2.0, 0.5)
    suppliers = {r["supplier_id"]: r for r in kpi.supplier_performance(ops).collect()}
    assert suppliers["S1"]["supplier_late_rate"] == 0.5 and suppliers["S2"]["supplier_late_rate"] == 0
    assert suppliers["S2"]["average_supplier_late_rate"] == 0.25


def test_lag_uses_the_previous_observed_month(tables):
    ops = tables(orders=[order("O1", date(2025, 1, 1)), order("O2", date(2025, 4, 1)),
                         order("O3", date(2025, 4, 2), "unfulfilled")])
    assert [(r["month"], r["mom_change"]) for r in kpi.fulfilment_rate(ops).collect()] == [
        ("2025-01", None), ("2025-04", -0.5)]


def test_shipped_month_without_orders_is_dropped(tables):
    ops = tables(orders=[order("O1", date(2025, 1, 31))], deliveries=[delivery("D1", "O1", date(2025, 2, 2))])
    row = kpi.monthly_kpis(ops).collect()
    assert [(r["month"], r["delivery_count"], r["on_time_rate"]) for r in row] == [("2025-01", 0, None)]


def test_order_features(tables):
    day = date(2025, 1, 1)
    ops = tables(
        orders=[order("O1", day), order("O2", day, warehouse="W2"), order("O3", day)],
        deliveries=[
            delivery("D2", "O1", day + timedelta(days=12), day + timedelta(days=16), day + timedelta(days=15), late=True),
            delivery("D1", "O1", day + timedelta(days=14), day + timedelta(days=15), supplier="S2"),
            delivery("D3", "O2", day + timedelta(days=2), supplier="S1"),
        ],
    )
    rows = {r["order_id"]: r for r in features.order_features(ops, check=True).collect()}
    one = rows["O1"]
    assert (one["processing_days"], one["lead_time_gap"], one["weekday"], one["month"], one["warehouse_load"],
            one["is_late"], one["supplier_late_rate"]) == (12, 1, 3, 1, 2, True, 0.5)
    assert rows["O2"]["is_late"] and rows["O3"]["is_late"] and rows["O3"]["processing_days"] is None
    ops["orders"] = ops["orders"].union(ops["orders"])
    with pytest.raises(ValueError):
        features.order_features(ops, check=True)


FEATURES = ("order_id int, warehouse_id string, order_date date, processing_days double, is_late boolean, "
            "warehouse_load bigint")


def test_outliers(frame):
    same = frame(FEATURES, [(i, "W1", D, 5.0, False, 1) for i in range(6)])
    assert features.processing_outliers(same).filter("iqr_flag OR z_score_flag OR z_score <> 0").count() == 0
    empty = frame(FEATURES, [(1, "W1", D, None, False, 1)])
    row = features.processing_outliers(empty).first()
    assert row["z_score"] is None and not row["iqr_flag"] and not row["z_score_flag"]
    rows = [(i, "W1", D, 5.0 + i % 3, False, 1) for i in range(30)] + [(99, "W1", D, 60.0, True, 1)]
    found = features.order_anomalies(frame(FEATURES, rows)).collect()
    assert [(r["order_id"], r["iqr_flag"], r["z_score_flag"]) for r in found] == [(99, True, True)]
    with pytest.raises(ValueError):
        features.processing_outliers(same, z_limit=0)
    with pytest.raises(ValueError):
        features.warehouse_day_anomalies(same, contamination=0.9)


def test_anomalies_have_both_kinds(frame):
    rows = [(i, f"W{i % 4}", D + timedelta(days=i % 30), 5.0 + i % 2, False, 1) for i in range(240)]
    rows += [(900 + i, "W0", D + timedelta(days=90), 80.0, True, 40) for i in range(3)]
    found = features.anomalies(frame(FEATURES, rows))
    assert found.columns == list(features.ANOMALY_COLUMNS)
    kinds = {r["anomaly_type"] for r in found.select("anomaly_type").distinct().collect()}
    assert kinds == {"order_processing_time", "warehouse_day"}


def test_statistics(frame):
    rows = [(i, "WH-A", D, 10.0 + i, False, 1) for i in range(4)] + [(9 + i, "WH-B", D, 1.0 + i, False, 1) for i in range(4)]
    row = features.warehouse_test(frame(FEATURES, rows), "WH-A").first()
    assert row["effect_size"] == 1.0 and row["p_value"] < 0.1 and row["sample_size"] == 8


def test_frequency_decline(tables):
    days = [date(2025, m, 1) for m in (1, 2, 3, 4)]
    orders = [order(f"A{i}", days[0], customer="A") for i in range(4)] + [order("A9", days[2], customer="A")]
    orders += [order("B1", days[0], customer="B"), order("B2", days[1], customer="B"), order("C1", days[3], customer="C")]
    ops = tables(orders=orders, customers=[(c, D) for c in "ABCD"], tickets=[("T1", "A"), ("T2", "A"), ("T3", "B")])
    score = {r[0]: r[1] for r in segments.frequency_decline(ops).collect()}
    assert score == {"A": 0.75, "B": 0.0, "C": 0.0, "D": 0.0}
    strict = {r[0]: r[1] for r in segments.frequency_decline(ops, treat_missing_as_zero=True).collect()}
    assert strict["B"] == 1.0
    risk = {r["customer_id"]: r for r in segments.churn_risk(ops).collect()}
    assert risk["A"]["churn_risk_score"] == pytest.approx(0.6 * 0.75 + 0.4)
    assert risk["C"]["ticket_percentile"] == pytest.approx(1.5 / 4)
    empty = tables(customers=[("A", D)])
    assert segments.frequency_decline(empty).first()["frequency_decline_score"] == 0


def two_month_tables(tables, spec, regions):
    """Orders from (warehouse, month number, fulfilled, unfulfilled)."""
    orders, n = [], 0
    for warehouse, month, good, bad in spec:
        for status, count in (("fulfilled", good), ("unfulfilled", bad)):
            for _ in range(count):
                n += 1
                orders.append(order(f"O{n:04d}", date(2025, month, 1 + n % 27), status, warehouse=warehouse))
    return tables(orders=orders, warehouses=regions)


def test_decomposition_adds_up(tables):
    ops = two_month_tables(tables, [("A", 1, 5, 0), ("B", 1, 4, 1), ("A", 2, 1, 4), ("B", 2, 4, 1)],
                           [("A", "North"), ("B", "South")])
    factors = decompose.decompose_months(ops, "2025-01", "2025-02")
    rows = factors.collect()
    assert {r["dimension"] for r in rows} == {"warehouse", "supplier", "sku_group"}  # region renames warehouse
    worst = next(r for r in rows if r["dimension"] == "warehouse" and r["dimension_rank"] == 1)
    assert (worst["segment"], worst["contribution_pp"]) == ("A", pytest.approx(-40))
    assert worst["share_of_unfulfilled"] == pytest.approx(0.8)
    for r in decompose.additivity(factors).collect():
        assert r["contribution"] == pytest.approx(-0.4) and r["share_of_drop"] == pytest.approx(100)


def test_mix_effect_and_absent_segment(tables):
    ops = two_month_tables(
        tables, [("X", 1, 80, 0), ("Y", 1, 14, 6), ("X", 2, 20, 0), ("Y", 2, 48, 27), ("Z", 2, 0, 5)],
        [("X", "R"), ("Y", "R"), ("Z", "R")])
    rows = {(r["dimension"], r["segment"]): r for r in decompose.decompose_months(ops, "2025-01", "2025-02").collect()}
    assert ("region", "R") in rows
    x, z = rows[("warehouse", "X")], rows[("warehouse", "Z")]
    assert x["dimension_rank"] == 1 and x["rate_a"] == x["rate_b"] == 1.0
    assert x["rate_vs_overall"] == pytest.approx(0.32)
    assert (z["orders_a"], z["rate_a"], z["p_value"]) == (0, 0.0, 1.0)


def test_ranks_of_any_number_of_factors(tables, spark):
    """The same positions as row numbers, and one schema for few and many factors."""
    ops = two_month_tables(tables, [("A", 1, 5, 1), ("B", 1, 4, 1), ("A", 2, 1, 4), ("B", 2, 4, 1), ("C", 2, 1, 1)],
                           [("A", "N"), ("B", "N"), ("C", "S")])
    small = decompose.decompose_months(ops, "2025-01", "2025-02")
    assert [t for c, t in small.dtypes if c.endswith("_rank")] == ["bigint", "bigint"]
    many = spark.range(3000).selectExpr(
        "concat('d', id % 3) AS dimension", "concat('s', id) AS segment", "CAST(id * 7919 % 101 AS DOUBLE) AS contribution")
    got = decompose.ranked(many)
    assert [t for c, t in got.dtypes if c.endswith("_rank")] == ["bigint", "bigint"]
    rows = [(r["dimension"], r["segment"], r["contribution"], r["dimension_rank"], r["overall_rank"]) for r in got.collect()]
    overall = sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    assert [r[4] for r in overall] == list(range(1, 3001))
    for d in ("d0", "d1", "d2"):
        inside = sorted((r for r in rows if r[0] == d), key=lambda r: (r[2], r[1]))
        assert [r[3] for r in inside] == list(range(1, 1001))


def test_decomposition_refuses_bad_periods(tables):
    ops = tables(orders=[order("O1", date(2025, 1, 1))], warehouses=[("W1", "R")])
    for a, b in (("2025-01", "2025-01"), ("2025-1", "2025-02"), ("2025-01", "2025-02")):
        with pytest.raises(ValueError):
            decompose.decompose_months(ops, a, b)


def snapshots(spec):
    """Snapshots from (product, out of stock, in stock)."""
    rows = []
    for product, out, full in spec:
        for i in range(out + full):
            rows.append((f"{product}{i}", D + timedelta(days=i), product, "W1", "S1", 0 if i < out else 5, 1, i < out))
    return rows


def test_alerts(tables):
    ops = tables(
        orders=[order("O1", D)] + [order(f"U{i}", D, "unfulfilled") for i in range(3)] + [order("P1", date(2024, 12, 1))],
        deliveries=[delivery("D1", "O1", D, supplier="SUP-A", late=True), delivery("D2", "O1", D, supplier="SUP-A", late=True),
                    delivery("D3", "O1", D, supplier="SUP-B"), delivery("D4", "O1", D, supplier="SUP-B")],
        suppliers=["SUP-A", "SUP-B"], products=[("X", "X"), ("Y", "Y")],
        snapshots=snapshots([("X", 0, 2), ("Y", 2, 1)]),
    )
    rows = {r["alert_type"]: r for r in evidence.alerts(ops, "2025-01").collect()}
    assert rows["low_fulfilment"]["value"] == 0.25
    assert rows["supplier_late_rate"]["key"] == "SUP-A"
    assert (rows["high_stockout_rate"]["key"], rows["high_stockout_rate"]["value"]) == ("Y", pytest.approx(2 / 3))
    with pytest.raises(ValueError):
        evidence.alerts(ops, "2025-13")


def narrative_tables(tables, late):
    return tables(
        orders=[order("O1", date(2024, 12, 5)), order("O2", D), order("O3", D, "unfulfilled", warehouse="W2")],
        deliveries=[delivery(f"D{i}", "O1", D, supplier=s, late=flag) for i, (s, flag) in enumerate(late)],
        suppliers=sorted({s for s, _ in late}), products=[("Y", "Y"), ("Z", "Z")],
        snapshots=snapshots([("Y", 2, 2), ("Z", 3, 1)]), warehouses=[("W1", "R"), ("W2", "R")],
    )


def test_evidence_and_audit(tables):
    late = [("SUP-Z", True)] * 2 + [("SUP-Y", True), ("SUP-Y", False), ("SUP-Y", True)] + [("SUP-X", False)] * 2
    ops = narrative_tables(tables, late)
    facts = evidence.evidence_facts(ops)
    row = facts.first()
    assert (row["supplier"], row["supplier_late_rate"], row["supplier_average"], row["supplier_gap_pp"]) == (
        "SUP-Z", "100.0%", "55.6%", "+44.44")
    assert (row["sku_group"], row["stockout_rate"], row["stockout_snapshots"], row["snapshot_count"],
            row["share_of_stockouts"], row["all_stockout_snapshots"]) == ("Z", "75.0%", "3", "4", "60.0%", "5")
    assert (row["value_a"], row["value_b"], row["change_pp"]) == ("100.00%", "50.00%", "-50.00")
    written = evidence.narratives(facts)
    assert evidence.audit_answers(written).first()["errors"] == []
    answer = written.first()["answer"]
    cases = {
        answer + " About 12345 more.": {"unsupported_numbers"},
        answer.replace("Evidence:", "Proof:"): {"headings"},
        answer.replace("- Warehouse", "- Place"): {"evidence_order"},
        answer.replace("60.0%", "sixty"): {"sku_group_evidence"},
        answer.replace("+44.44", "much"): {"supplier_evidence"},
        answer.split("Recommendation:")[0] + "Recommendation:": {"recommendation_count", "recommendation_group"},
        answer.replace(answer.split("\n")[2] + "\n", ""): {"evidence_count"},
    }
    for text, expected in cases.items():
        errors = set(evidence.audit_answers(written.withColumn("answer", F.lit(text))).first()["errors"])
        assert expected <= errors, text


def test_no_supplier_above_average(tables):
    ops = narrative_tables(tables, [("SUP-A", True), ("SUP-B", True)])
    written = evidence.narratives(evidence.evidence_facts(ops))
    row = evidence.audit_answers(written).first()
    assert row["supplier"] is None and "No supplier" in row["answer"] and row["errors"] == []


def test_measures(frame):
    df = frame("g string, m string, v int", [("a", "1", 1), ("a", "2", 3), ("b", "1", 4)])
    picked = frame("m string", [("1",), ("1",)])
    rows = measure(df, {"t": F.sum("v")}, by=["g"], where=F.col("v") > 0, within=(picked, "m")).collect()
    assert sorted(map(tuple, rows)) == [("a", 1), ("b", 4)]
    assert sorted(r["s"] for r in share_of(df, "v", [], "s").collect()) == [0.125, 0.375, 0.5]
    assert {tuple(r) for r in histogram(df, "v", 0.0, 4.0, 2).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_calendar(spark):
    rows = calendar(spark, "2025-01-01", "2025-06-30").collect()
    assert len(rows) == 181 and rows[0]["weekday"] == 3 and not rows[0]["is_weekend"]
    one = calendar(spark, "2024-12-30", "2024-12-30").first()
    assert (one["week"], one["year"], one["weekday"]) == (1, 2024, 1)
