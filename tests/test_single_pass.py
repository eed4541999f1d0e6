"""What a filter looks at is computed once per row, by compiled code."""

from datetime import date

from pyspark.sql import functions as F

from harborline.contract import CONTRACT
from harborline.functions.dates import compact_day_sql
from harborline.operators import clean, keysets, validate
from harborline.operators.parsing import boolean_sql, integer_sql, number_sql
from harborline.session import TUNING


def raw_frame(spark, name, rows):
    table = CONTRACT[name]
    schema = "source_row bigint, " + ", ".join(f"{c} string" for c in table.columns)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, start=2)], schema)


def snapshots(spark):
    # Plain files, since filters behave differently over local rows.
    rows = [("s1", "2025-01-01", "p1", "w1", "u1", "3", "5", "true", None),
            ("s1", "2025-01-02", "p1", "w1", "u1", "-3", "5", "False", "x"),
            (" s2 ", "bad", "p2", "w1", "u1", "2.5", "+5", "maybe", " "),
            (None, None, None, None, None, "1e2", "007", "TRUE", None)]
    return raw_frame(spark, "inventory_snapshots", rows).repartition(2)


def filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if line.lstrip(" :+-").startswith("Filter")]


def test_a_filter_on_reasons_repeats_no_parser(spark):
    judged = clean.judge({"inventory_snapshots": snapshots(spark)})["inventory_snapshots"]
    for rows in (clean.clean_rows(CONTRACT["inventory_snapshots"], judged), clean.rejected_rows(judged)):
        assert filters(rows) and not any("RLIKE" in line or "btrim" in line for line in filters(rows))
    reasons = {r["source_row"]: r["reasons"] for r in judged.collect()}
    assert reasons == {
        2: [],
        3: ["negative_value:quantity_on_hand", "duplicate_primary_key:snapshot_id"],
        4: ["invalid_type:snapshot_date", "invalid_type:quantity_on_hand", "invalid_type:stockout_flag",
            "null_required:snapshot_date", "null_required:quantity_on_hand", "null_required:stockout_flag"],
        5: [f"null_required:{c}" for c in ("snapshot_id", "snapshot_date", "product_id", "warehouse_id", "supplier_id")]}
    assert [r["quantity_on_hand"] for r in clean.clean_rows(CONTRACT["inventory_snapshots"], judged).collect()] == [3]


def longest_method(df):
    """Bytes of the longest method of the compiled stages of a plan."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    found = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size()))


def test_the_code_of_a_judgement_is_cut(spark):
    """Joins and parsers are compiled apart: no stage of them is too long for the JIT."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("orders", "order_items", "deliveries", "inventory_snapshots"):
            tables = {n: raw_frame(spark, n, []) for n in (*CONTRACT[name].parents.values(), name)}
            judged = clean.judge(tables)[name]
            assert longest_method(clean.clean_rows(CONTRACT[name], judged)) < int(TUNING["spark.sql.codegen.hugeMethodLimit"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_violations_are_found_in_one_pass(spark):
    frame = snapshots(spark).withColumn("data_row", F.col("source_row") - 1).drop("source_row")
    parts = validate.table_violations(CONTRACT["inventory_snapshots"], frame, {}, tuple(validate.SEVERITY))
    assert not any("RLIKE" in line or "btrim" in line for line in filters(parts[0]))
    found = sorted((r["code"], r["column"], r["data_row"]) for r in parts[0].collect())
    assert [f for f in found if f[0] == "invalid_type"] == [
        ("invalid_type", "quantity_on_hand", 3), ("invalid_type", "snapshot_date", 3), ("invalid_type", "stockout_flag", 3)]
    assert ("negative_value", "quantity_on_hand", 2) in found


def test_keys_are_derived_once(spark):
    keys = snapshots(spark).selectExpr("source_row", f"{clean.key_sql('snapshot_id')} AS _own")
    assert not any("btrim" in line for line in filters(keysets.repeated(keys, "_own")))
    assert sorted(r["_own"] for r in keysets.repeated(keys, "_own").collect()) == ["s1", "s1"]


def test_cheap_parsers_read_the_same_values(spark):
    texts = ["0", "-0", "7", "-12", "+5", "007", "2.0", "2.5", "1e2", ".5", "x", "", "1 2", "\x001", "1\x00", "٣", "9007199254740993",
             "9007199254740992", "-9007199254740993", "999999999999999999", "9223372036854775807", "9223372036854775808", "1e400", None]
    plain = f"CASE WHEN {number_sql('t')} % 1 = 0 THEN try_cast(try_cast(t AS DOUBLE) AS BIGINT) END"
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    assert df.filter(f"NOT ({integer_sql('t')} <=> {plain})").count() == 0
    words = spark.createDataFrame([(t,) for t in ("true", "false", "TRUE", "False", "yes", "", None)], "t string")
    slow = "CASE lower(t) WHEN 'true' THEN true WHEN 'false' THEN false END"
    assert words.filter(f"NOT ({boolean_sql('t')} <=> {slow})").count() == 0
    days = spark.createDataFrame([(d,) for d in (date(1, 1, 1), date(987, 6, 5), date(2025, 2, 28), date(9999, 12, 31), None)], "d date")
    days = days.union(spark.sql("SELECT date_add(DATE'9999-12-31', 1)")).union(spark.sql("SELECT date_add(DATE'0001-01-01', -1)"))
    assert days.filter(f"NOT ({compact_day_sql('d')} <=> date_format(d, 'yyyyMMdd'))").count() == 0


def test_only_plain_numbers_become_bits(spark):
    texts = ["0", "-0", "12", "012", "+12", "12 ", "-3", "1.0", "999999999999999999", "1000000000000000000", "a", "١", None]
    keys = spark.createDataFrame([(t,) for t in texts], "k string")
    for t in texts[:-1]:
        own = keysets.key_set(keys.filter(F.col("k") == t), "k")
        members = keysets.with_members(keys, "k", own, "found").filter("found").collect()
        assert [r["k"] for r in members] == [t]
