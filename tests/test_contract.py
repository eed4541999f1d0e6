"""Validation, cleaning and the bundle reader on hand-made tables."""

import os

import pytest
from pyspark.sql import functions as F

from harborline.contract import CONTRACT
from harborline.operators import clean, date_formats, validate
from harborline.sources import bundle, sinks

SUPPLIERS = [("S1", "One", "a@b", "DE", "gold"), ("S2", "Two", None, "DE", "gold")]


def raw(spark, name, rows, position=None):
    """A raw table; ``position`` names the row number column to add."""
    table = CONTRACT[name]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"at int, {', '.join(f'{c} string' for c in table.columns)}")
    if position == "data_row":
        return df.withColumn("data_row", (F.col("at") + 1).cast("bigint")).drop("at")
    return df.withColumn("source_row", (F.col("at") + 2).cast("bigint")).drop("at")


def found(tables):
    return {(r["table"], r["code"], r["column"]): (r["severity"], r["count"], r["sample_rows"])
            for r in validate.findings(tables).collect()}


def test_every_product_rule(spark):
    products = [
        ("P1", "n", "s", "g", "home goods", "S1", "-1", None),
        ("P1", "n", "s", "g", "Home Goods", "S9", "abc", "d"),
        ("P3", None, "s", "g", "Home Goods", "S1", "2.50", "d"),
    ]
    tables = {"products": raw(spark, "products", products, "data_row"),
              "suppliers": raw(spark, "suppliers", SUPPLIERS, "data_row")}
    assert found(tables) == {
        ("suppliers", "null_optional", "contact_email"): ("warn", 1, [2]),
        ("products", "null_required", "product_name"): ("reject", 1, [3]),
        ("products", "null_optional", "description"): ("warn", 1, [1]),
        ("products", "invalid_type", "unit_price"): ("reject", 1, [2]),
        ("products", "negative_value", "unit_price"): ("fix", 1, [1]),
        ("products", "inconsistent_category_casing", "category"): ("fix", 1, [1]),
        ("products", "duplicate_primary_key", "product_id"): ("reject", 2, [1, 2]),
        ("products", "foreign_key_not_found", "supplier_id"): ("reject", 1, [2]),
    }
    totals = {r["table"]: (r["reject"], r["fix"], r["warn"]) for r in
              validate.summarise(validate.findings(tables)).collect()}
    assert totals == {"suppliers": (0, 0, 1), "products": (5, 2, 1), None: (5, 2, 2)}


def test_missing_columns_and_unknown_tables(spark):
    only = spark.createDataFrame([("P1", 1)], "product_id string, data_row bigint")
    rows = validate.findings({"products": only}).filter("code = 'missing_column'").collect()
    assert [(r["table"], r["count"]) for r in rows] == [("products", 7)]
    assert [tuple(r) for r in validate.lacking_rows({"products": only}).collect()] == [("products", 1)]
    with pytest.raises(ValueError):
        validate.findings({"nonsense": only})
    with pytest.raises(ValueError, match="missing required columns"):
        clean.normalise(CONTRACT["products"], only)


def test_sample_rows_are_the_first_ten(spark):
    rows = [(f"S{i}", None, "a", "b", "c") for i in range(5000)]
    table = raw(spark, "suppliers", rows, "data_row").repartition(9)
    assert found({"suppliers": table})[("suppliers", "null_required", "supplier_name")] == (
        "reject", 5000, list(range(1, 11)))


def test_parent_that_is_not_supplied_is_not_checked(spark):
    table = raw(spark, "support_tickets", [("T1", "C1", "2025-01-01", "a", "b", "c", None)], "data_row")
    assert ("support_tickets", "foreign_key_not_found", "customer_id") not in found({"support_tickets": table})


def bundle_tables(spark):
    def order(key, customer="C1", day="2025-01-02", note=None, status="fulfilled"):
        return (key, customer, "W1", "E1", day, note, status)

    return {
        "suppliers": raw(spark, "suppliers", SUPPLIERS),
        "warehouses": raw(spark, "warehouses", [("W1", "w", "c", None, "10")]),
        "customers": raw(spark, "customers", [("C1", "n", "e", None, "c", "s", "2024-01-01", "x")]),
        "employees": raw(spark, "employees", [("E1", "n", "e", None, "r", "2020-01-01")]),
        "products": raw(spark, "products", [
            ("P1", "n", "s", "g", "home-goods", "S1", "1.50", None),
            ("P1", "n", "s", "g", "Tools", "S1", "1.50", "d"),
            ("P3", "n", "s", "g", "Tools", "S1", "-2", "d"),
        ]),
        "orders": raw(spark, "orders", [
            order(" ORD-1 ", note="  x"), order("ORD-2", day="nope"), order("ORD-3", customer="C9"),
            order("ORD-3"), order("ORD-4", status="  "),
        ]),
        "order_items": raw(spark, "order_items", [
            ("I1", "ORD-1", "P1", "2", "1.00", None), ("I2", "ORD-2", "P1", "2", "1.00", "D"),
            ("I3", "ORD-3", "P3", "2.5", "1.00", "D"), ("I4", "ORD-9", "P1", "0", "1.00", "D"),
            ("I1", "ORD-1", "P1", "-1", "x", "D"), ("I6", None, "P1", "1", "1", "D"),
        ]),
        "deliveries": raw(spark, "deliveries", [
            ("D1", "ORD-1", "S1", "W1", "2025-01-03", None, "2025-01-09", " True ", "x", None),
            ("D2", "ORD-1", "S1", "W1", "2025-01-03", "2025-01-02", "2025-01-09", "maybe", "x", "t"),
        ]),
    }


def test_quarantine_reasons(spark):
    done = clean.clean(bundle_tables(spark), stage=False)
    reasons = {n: [(r["source_row"], r["reject_reason"]) for r in df.orderBy("source_row").collect()]
               for n, df in done.rejected.items()}
    assert reasons["products"] == [(3, "duplicate_primary_key:product_id"), (4, "negative_value:unit_price")]
    assert reasons["orders"] == [
        (3, "invalid_type:order_date; null_required:order_date"),
        (4, "orphan_foreign_key:customer_id"),
        (5, "duplicate_primary_key:order_id"),
        (6, "null_required:order_status"),
    ]
    assert reasons["order_items"] == [
        (3, "cascade_parent_order_rejected"),
        (4, "invalid_type:quantity; null_required:quantity; cascade_parent_order_rejected; "
            "orphan_foreign_key:product_id"),
        (5, "orphan_foreign_key:order_id"),
        (6, "invalid_type:unit_price; null_required:unit_price; negative_value:quantity; "
            "duplicate_primary_key:order_item_id"),
        (7, "null_required:order_id"),
    ]
    assert reasons["deliveries"] == [
        (3, "invalid_type:supplier_late; null_required:supplier_late; delivered_before_shipped")]


def test_clean_values_and_summary(spark):
    done = clean.clean(bundle_tables(spark))
    order = done.clean["orders"].first()
    assert (order["order_id"], order["order_notes"], str(order["order_date"])) == ("ORD-1", "x", "2025-01-02")
    product = done.clean["products"].first()
    assert (product["category"], product["description"], product["unit_price"]) == ("Home-Goods", "Not provided", 1.5)
    assert done.clean["customers"].first()["phone"] == "Unknown"
    assert done.clean["order_items"].first()["discount_code"] == "NONE"
    assert done.clean["deliveries"].first()["supplier_late"] is True
    counts = {r["table"]: tuple(r)[1:] for r in done.summary.collect()}
    assert counts["products"] == (3, 1, 1, 2) and counts["orders"] == (5, 1, 1, 4)
    total = counts.pop("TOTAL")
    assert total == tuple(map(sum, zip(*counts.values()))) and total[0] == total[1] + total[3]
    clean.assert_clean(done.clean)
    rejected = done.rejected["orders"]
    assert rejected.columns[0] == "source_row" and rejected.columns[-1] == "reject_reason"


def test_gate_and_published_layer(spark):
    done = clean.clean(bundle_tables(spark), stage=False)
    broken = done.clean["orders"].withColumn("order_status", F.lit(None).cast("string"))
    with pytest.raises(RuntimeError):
        clean.assert_clean({"orders": broken})
    validate.assert_contract(done.clean)
    items = done.clean["order_items"].withColumn("quantity", F.lit(0).cast("bigint"))
    with pytest.raises(ValueError, match="positive"):
        validate.assert_contract({"order_items": items})


def test_extra_columns_survive(spark):
    df = raw(spark, "suppliers", SUPPLIERS).withColumn("source_system", F.lit("erp"))
    assert clean.clean({"suppliers": df}, stage=False).clean["suppliers"].first()["source_system"] == "erp"


def test_empty_tables(spark):
    done = clean.clean({"suppliers": raw(spark, "suppliers", SUPPLIERS).limit(0)}, stage=False)
    assert {r["table"]: tuple(r)[1:] for r in done.summary.collect()} == {
        "suppliers": (0, 0, 0, 0), "TOTAL": (0, 0, 0, 0)}


def test_csv_bundle(spark, tmp_path):
    folder = tmp_path / "bundle"
    os.makedirs(folder / "suppliers.csv")
    head = "supplier_id,supplier_name,contact_email,country,supplier_tier\n"
    (folder / "suppliers.csv" / "part-0.csv").write_text(head + 'S1,"say ""hi"", x",NA,DE,  gold\nS2,None,NONE,,t\n')
    (folder / "suppliers.csv" / "part-1.csv").write_text(head + "S3,n,e,DE,t\n")
    (folder / "employees.csv").write_text("employee_id,employee_name,email,phone,role,hire_date\n")
    tables = bundle.read_bundle(spark, str(folder))
    assert set(tables) == {"suppliers", "employees"}
    rows = [tuple(r) for r in tables["suppliers"].orderBy("source_row").collect()]
    assert rows == [
        (2, "S1", 'say "hi", x', None, "DE", "  gold"), (3, "S2", None, "NONE", None, "t"), (4, "S3", "n", "e", "DE", "t")]
    assert tables["employees"].count() == 0
    assert bundle.missing_files(spark, tables).count() == 8


def test_positions_over_many_splits(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    bundle.write_csv(spark.range(0, 5000, 1, 3).selectExpr("id", "concat('row ', id) AS t"), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = bundle.with_row_position(bundle.read_csv_text(spark, path))
        assert df.filter("CAST(id AS BIGINT) + 2 <> source_row").count() == 0
        assert df.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_publish_is_all_or_nothing(spark, frame, tmp_path):
    target = str(tmp_path / "published")
    tables = {"a": frame("x int", [(1,), (2,)]), "b": frame("y int", [])}
    assert sinks.publish(tables, target, {"a": 2, "b": 0}) == {"a": 2, "b": 0}
    with pytest.raises(RuntimeError, match="a has 2 instead of 3"):
        sinks.publish(tables, target, {"a": 3, "b": 0})
    with pytest.raises(ValueError):
        sinks.publish(tables, target, {"a": 2})
    current = sinks.read_published(spark, target)
    assert current["a"].count() == 2 and current["b"].columns == ["y"]


def test_replace_export_and_views(spark, frame, tmp_path):
    path = str(tmp_path / "derived")
    assert sinks.replace_derived(frame("x int", [(1,), (2,)]), path) == 2
    assert sinks.replace_derived(frame("x int", [(3,)]), path) == 1
    with pytest.raises(RuntimeError, match="vw_monthly_kpis"):
        sinks.export_star({"vw_orders_enriched": frame("x int", [])}, frame("x int", []), str(tmp_path / "star"))
    relations = {name: frame("x int", [(1,)]) for name in sinks.STAR}
    counts = sinks.export_star(relations, frame("kpi string", []), str(tmp_path / "star"))
    assert len(counts) == 16 and counts["dim_date"] == 1 and counts["root_cause"] == 0
    with pytest.raises(ValueError):
        sinks.result_sample(relations["dim_date"], -1)


def test_audit_log(spark, tmp_path):
    from datetime import datetime

    path = str(tmp_path / "audit")
    assert sinks.read_audit(spark, path).count() == 0
    t = [datetime(2026, 1, 1, 0, m) for m in range(4)]
    steps = ["validate", "clean", "load"]
    sinks.append_audit(sinks.audit_rows(spark, "r1", [("validate", "running", t[0], t[0], 0, "")], steps), path)
    sinks.append_audit(sinks.audit_rows(
        spark, "r1", [("validate", "completed", t[0], t[1], 5, "ok"), ("clean", "failed", t[1], t[2], 0, "no")], steps), path)
    last = {r["step"]: (r["status"], r["rows_processed"]) for r in sinks.latest_audit(sinks.read_audit(spark, path)).collect()}
    assert last == {"validate": ("completed", 5), "clean": ("failed", 0), "load": ("skipped", 0)}
    with pytest.raises(ValueError):
        sinks.audit_rows(spark, "r1", [("other", "failed", t[0], t[0], 0, "")], steps)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    """Columns are never taken by position from a file that names them in another order."""
    os.makedirs(tmp_path / "t.csv")
    (tmp_path / "t.csv" / "part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "t.csv" / "part-1.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        bundle.read_csv_text(spark, str(tmp_path / "t.csv")).collect()


def test_numbering_does_not_shuffle_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    bundle.write_csv(spark.range(0, 300, 1, 3).selectExpr("id"), path)
    df = bundle.with_row_position(bundle.read_csv_text(spark, path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def local(spark, shipped, delivered, promised):
    rows = [(f"D{i}", "O1", "S1", "W1", a, b, c, "true", "x", None) for i, (a, b, c) in enumerate(zip(shipped, delivered, promised))]
    return {"deliveries": raw(spark, "deliveries", rows)}


def test_date_formats_are_found_by_column(spark):
    tables = local(spark, ["13/02/2025", "01/03/2025", " 28/2/2025 ", "nope", None], ["02-13-2025", None, "3-1-2025", "x", "13-13-2025"],
                   ["2025-02-13", "2025-03-01T10:00:00", "2025-02-30", "", "20250101"])
    found = {r["column"]: tuple(r)[2:] for r in date_formats.date_format_report(tables).collect()}
    assert found == {"shipped_date": ("day/month/year", 4, 3, False), "delivered_date": ("month-day-year", 4, 2, False),
                     "promised_delivery_date": ("iso", 4, 2, False)}
    done = clean.clean(tables, stage=False, formats=date_formats.date_formats(tables))
    rows = {r["source_row"]: (r["value"], r["reasons"]) for r in done.judged["deliveries"].collect()}
    columns = ("shipped_date", "delivered_date", "promised_delivery_date")
    assert [str(rows[2][0][c]) for c in columns] == ["2025-02-13"] * 3 and rows[2][1] == []
    assert [str(rows[3][0][c]) for c in columns] == ["2025-03-01", "None", "2025-03-01"]
    assert rows[4][1] == ["invalid_type:promised_delivery_date", "null_required:promised_delivery_date"]
    assert "invalid_type:shipped_date" in rows[5][1] and "invalid_type:delivered_date" in rows[6][1]


def test_ambiguous_dates_are_reported(spark):
    tables = local(spark, ["01/02/2025", "03/04/2025"], ["05/05/2025", "06/06/2025"], ["bad", None])
    found = {r["column"]: (r["format"], r["ambiguous"]) for r in date_formats.date_format_report(tables).collect()}
    # Days equal to months read the same either way; a column without dates counts as ISO.
    assert found == {"shipped_date": ("month/day/year", True), "delivered_date": ("month/day/year", False),
                     "promised_delivery_date": ("iso", False)}


def test_findings_know_the_formats(spark):
    tables = {"deliveries": local(spark, ["13/02/2025"], ["11.02.2025"], ["20250301"])["deliveries"].withColumn(
        "data_row", F.col("source_row") - 1).drop("source_row")}
    plain = {(r["code"], r["column"]) for r in validate.findings(tables).collect()}
    assert ("invalid_type", "shipped_date") in plain
    known = {(r["code"], r["column"]) for r in validate.findings(tables, formats=date_formats.date_formats(tables)).collect()}
    assert known == {("null_optional", "tracking_number"), ("delivered_before_shipped", "delivered_date")}


def test_no_wide_row_meets_a_parent(spark):
    """Parents are compared with keys; the wide rows meet only the lines that got a reason."""
    tables = bundle_tables(spark)
    plain = clean.judge({n: tables[n] for n in ("suppliers", "warehouses", "customers", "employees")})
    parents = {c: clean.key_status(CONTRACT[p], plain[p]) for c, p in CONTRACT["orders"].parents.items()}
    orders = clean.normalise(CONTRACT["orders"], tables["orders"])
    for stage, joins in ((True, 1), (False, 2)):
        plan = clean._with_key_reasons(CONTRACT["orders"], orders, parents, stage)._jdf.queryExecution().optimizedPlan().toString()
        wide = [line for line in plan.split("\n") if "Join" in line and "LeftOuter" in line]
        assert len(wide) == 1 if stage else len(wide) >= joins
        assert "source_row" in wide[0]
