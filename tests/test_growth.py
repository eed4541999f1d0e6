"""What judging, validating and exporting may shuffle or write, and rare inputs of the operators behind them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.catalog import storage
from harborline.contract import CONTRACT
from harborline.operators import clean, keysets, parsing, validate
from harborline.plans import kpi
from harborline.sources import sinks
from harborline.sources.raw import LINE_ORDER
from harborline.sources.tables import OpsTables


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def bundle(frame):
    suppliers = frame("source_row long, supplier_id string, supplier_name string, contact_email string, country string, "
                      "supplier_tier string",
                      [(2, "1", "a", None, "C", "t"), (3, " 1 ", "b", None, "C", "t"), (4, "x-9", "c", None, "C", "t"),
                       (5, "2", None, None, "C", "t"), (6, None, "d", None, "C", "t"), (7, "1", "e", None, "C", "t")])
    columns = "source_row long, " + ", ".join(f"{c} string" for c in CONTRACT["products"].columns)
    products = frame(columns, [
        (i, str(i), "n", "s", "g", "Cat", supplier, "1.0", None)
        for i, supplier in enumerate(["1", " 1", "x-9", "2", "7", None, "01"], start=2)])
    return {"suppliers": suppliers, "products": products}


@pytest.mark.parametrize("stage", [False, True])
def test_reasons_of_keys(bundle, stage):
    judged = clean.judge(bundle, stage)
    reasons = {n: {r["source_row"]: r["reasons"] for r in df.collect()} for n, df in judged.items()}
    assert reasons["suppliers"] == {
        2: [], 3: ["duplicate_primary_key:supplier_id"], 4: [], 5: ["null_required:supplier_name"],
        6: ["null_required:supplier_id"], 7: ["duplicate_primary_key:supplier_id"]}
    orphan = ["orphan_foreign_key:supplier_id"]
    assert reasons["products"] == {2: [], 3: [], 4: [], 5: orphan, 6: orphan, 7: ["null_required:supplier_id"], 8: orphan}


def test_judged_rows_are_not_shuffled(bundle):
    plan = clean.judge(bundle)["products"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_layers_keep_what_they_show(bundle):
    whole, layers = clean.Cleaned(clean.judge(bundle, True)), clean.clean(bundle)
    for side in ("clean", "rejected"):
        for name, df in getattr(whole, side).items():
            assert sorted(map(repr, df.collect())) == sorted(map(repr, getattr(layers, side)[name].collect()))
    judged = layers.judged["products"]
    assert judged.filter("raw IS NOT NULL AND value IS NOT NULL").isEmpty()


def test_repeated_keys(frame):
    rows = frame("k string, n int", [("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5)])
    assert sorted(r["n"] for r in keysets.repeated(rows, "k").collect()) == [1, 3]


def test_words_hold_sparse_and_negative_keys(frame):
    keys = [-65, -64, -1, 0, 63, 64, 10**17, 10**17 + 1]
    words = keysets.key_bitmaps(frame("k long", [(k,) for k in keys]), "k")
    assert words.selectExpr("sum(bit_count(bits))").first()[0] == len(keys)
    assert max(len(bytes(str(r["bits"]), "ascii")) for r in words.collect()) <= 20  # a word, not a page
    probes = frame("k long", [(k + d,) for k in keys for d in (-1, 0, 1)])
    found = keysets.with_membership(probes, "k", frame("k long", [(k,) for k in keys]), "k", "m").collect()
    assert all(r["m"] == (r["k"] in keys) for r in found)


def test_parents_of_findings_are_not_shuffled(bundle):
    tables = {n: df.withColumnRenamed("source_row", "data_row") for n, df in bundle.items()}
    parts = validate.table_violations(CONTRACT["products"], tables["products"], tables, ["foreign_key_not_found"])
    assert sorted(r["data_row"] for r in parts[0].collect()) == [3, 6, 8]
    assert "Exchange hashpartitioning" not in parts[0]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("form", [f for f in parsing.DATE_FORMATS if f not in (parsing.ISO, "day month-name year")])
def test_dates_as_the_formatter_reads_them(frame, form):
    shape, pattern = parsing.DATE_FORMATS[form]
    texts = [pattern.replace("yyyy", y).replace("MM", m.zfill(2)).replace("dd", d.zfill(2)).replace("M", m).replace("d", d)
             for y in ("2024", "2023", "0000", "0001", "9999") for m in ("1", "2", "12", "13", "0") for d in ("1", "29", "31", "0")]
    df = frame("t string", [(t,) for t in [*texts, "", None, "text", "1/2/3", "2024-01-01"]])
    by_formatter = f"CASE WHEN t RLIKE '^{shape}$' THEN CAST(try_to_timestamp(t, '{pattern}') AS DATE) END"
    different = df.selectExpr("t", f"{parsing.date_sql('t', form)} AS a", f"{by_formatter} AS b").filter("NOT a <=> b")
    assert different.collect() == []
    assert "gettimestamp" not in plan_of(df.selectExpr(parsing.date_sql("t", form))).lower()


def test_lines_are_ordered_by_what_they_show():
    assert "l_shipdate" not in LINE_ORDER and LINE_ORDER[:4] == ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def test_csv_layers_are_compressed(frame, tmp_path, spark):
    rows = [(i, "text, with \"quotes\"", dt.date(2024, 1, 1)) for i in range(100)]
    assert sinks.write_layer({"t": frame("a int, b string, c date", rows)}, str(tmp_path / "l"), csv=True) == {"t": 100}
    assert list((tmp_path / "l" / "t").glob("*.csv.gz")) and not list((tmp_path / "l" / "t").glob("*.csv"))
    from harborline.sources.bundle import read_csv_text
    assert read_csv_text(spark, str(tmp_path / "l" / "t")).agg(F.count("b")).first()[0] == 100


def test_rows_that_share_a_line_share_its_reasons(frame):
    columns = ("source_row long, supplier_id string, supplier_name string, contact_email string, country string, "
               "supplier_tier string")
    rows = [(2, "1"), (3, "1"), (3, "1"), (4, "2"), (4, "2"), (None, "1")]
    judged = clean.judge({"suppliers": frame(columns, [(n, k, "a", None, "C", "t") for n, k in rows])})["suppliers"]
    found = sorted((r["source_row"] or 0, len(r["reasons"])) for r in judged.collect())
    assert found == [(0, 0), (2, 0), (3, 1), (3, 1), (3, 1), (3, 1), (4, 0), (4, 0)]


def test_many_repeated_keys_do_not_shuffle_rows(spark):
    """Half of the rows repeat a key, so their lines take more room than the threshold allows."""
    suppliers = spark.range(2, 4002).selectExpr(
        "id AS source_row", "CAST(id DIV 2 AS STRING) AS supplier_id", "'a' AS supplier_name", "'b' AS contact_email",
        "'C' AS country", "'t' AS supplier_tier")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200")
    try:
        judged = clean.judge({"suppliers": suppliers})["suppliers"]
        plan = judged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert [r["source_row"] for r in judged.filter("size(reasons) > 0").collect()] == list(range(3, 4002, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_after_the_first_of_a_key(frame):
    rows = [("a", 5), ("a", 2), ("a", 2), ("b", 1), (None, 3), (None, 4), ("a", None), ("c", 7), ("c", 9)]
    found = keysets.after_first(frame("k string, n long", rows), "k", "n")
    assert sorted(r["n"] for r in found.collect()) == [5, 9]


def test_numbers_that_repeat(frame):
    assert keysets.repeated_numbers(frame("n long", [(1,), (2,), (64,), (-1,), (None,), (None,)]), "n") is None
    rows = [(1,), (2,), (1,), (-70,), (-70,), (-70,), (10**15,), (None,), (None,)]
    assert sorted(r["n"] for r in keysets.repeated_numbers(frame("n long", rows), "n").collect()) == [-70, 1]


def test_relations_of_the_star_share_what_is_derived_from_the_lines(spark):
    ops = OpsTables(spark, "/root/testdata/sf0.001")
    given = storage.with_derived(ops)
    for plan in (kpi.orders_enriched, kpi.warehouse_performance, kpi.inventory_status, kpi.customer_rfm_base):
        assert "l_orderkey" not in plan_of(plan(given)) and "l_partkey" not in plan_of(plan(given))
        assert sorted(map(repr, plan(given).collect())) == sorted(map(repr, plan(ops).collect()))


def test_last_snapshots(frame):
    rows = [("b", dt.date(2024, 1, 2), 1, 1, 5, 1), ("c", dt.date(2024, 1, 2), 1, 1, 6, 2), ("z", dt.date(2024, 1, 1), 1, 1, 7, 9),
            ("n", None, 1, 2, 1, 3), ("a", dt.date(2023, 1, 1), 1, 2, 2, 4)]
    snapshots = frame("snapshot_id string, snapshot_date date, product_id long, warehouse_id long, supplier_id long, "
                      "quantity_on_hand long", rows).selectExpr("*", "1L AS reorder_point", "false AS stockout_flag")
    found = kpi.latest_snapshots({"inventory_snapshots": snapshots})
    assert found.columns == ["product_id", "warehouse_id", "snapshot_id", "snapshot_date", "supplier_id", "quantity_on_hand",
                             "reorder_point", "stockout_flag"]
    assert sorted((r["warehouse_id"], r["snapshot_id"], r["supplier_id"]) for r in found.collect()) == [(1, "c", 6), (2, "a", 2)]
